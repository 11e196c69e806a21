"""Feature selection by variance, rank correlation and mutual information."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions.columns import column_aggregates, number, ref
from tallystone.operators.correlation import correlation
from tallystone.operators.quantiles import exact_quantiles
from tallystone.session import materialize


def variance_filter(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Population variance per column and whether it exceeds the threshold."""
    report = column_aggregates(df, columns, {"variance": "var_pop({v})"})
    return report.withColumn("kept", F.coalesce(F.col("variance") > threshold, F.lit(False)))


def correlation_filter(
    df: DataFrame,
    columns: Sequence[str],
    key: str | None = None,
    threshold: float = 0.95,
    method: str = "spearman",
) -> DataFrame:
    """A column is dropped when it correlates above the threshold with any column before it.

    The coefficient counts with its sign, and columns already dropped still count.
    """
    pairs = correlation(df, columns, method, key)
    highest = pairs.groupBy(F.col("y").alias("column")).agg(F.max("correlation").alias("max_correlation"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(highest, "column", "left").withColumn(
        "kept", F.coalesce(F.col("max_correlation") <= threshold, F.lit(True))
    )


def keep_selected(df: DataFrame, report: DataFrame) -> DataFrame:
    """``df`` without the columns that a fitted ``report`` (``column, kept``) drops; others stay as they are."""
    dropped = {r["column"] for r in report.where("NOT kept").collect()}  # one row per column
    return df.select(*[ref(c) for c in df.columns if c not in dropped])


def mutual_information(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each column, cut at its quantiles, with a class label."""
    cuts = exact_quantiles(df, columns, [i / bins for i in range(1, bins)])
    entries = []
    for c in columns:
        edges = sorted({e for e in cuts[c].values.values() if e is not None})
        v = number(df, c)
        bin_no = sum(((v > e).cast("int") for e in edges), F.lit(0))
        entries.append(F.struct(F.lit(c).alias("column"), F.when(v.isNotNull(), bin_no).alias("bin")))
    rows = df.where(ref(target).isNotNull()).select(
        ref(target).cast("string").alias("_target"), F.inline(F.array(*entries))
    )
    some = rows.where(F.col("bin").isNotNull()).groupBy("column", "bin", "_target")
    cells = materialize(some.agg(F.count("*").cast("double").alias("n")), "cells")

    def terms(keys: list[str], name: str) -> DataFrame:
        """Sum of x ln x over the margin that keeps ``keys`` besides the column."""
        margin = cells.groupBy("column", *keys).agg(F.sum("n").alias("x"))
        return margin.groupBy("column").agg(F.sum(F.col("x") * F.ln("x")).alias(name), F.sum("x").alias("n"))

    # I = (sum o ln o - sum r ln r - sum c ln c + n ln n) / n
    sums = terms(["bin", "_target"], "cells")
    for keys, name in ((["bin"], "rows"), (["_target"], "classes")):
        sums = sums.join(terms(keys, name).drop("n"), "column")
    info = (F.col("cells") - F.col("rows") - F.col("classes") + F.col("n") * F.ln("n")) / F.col("n")
    return sums.select("column", info.alias("mutual_information"))
