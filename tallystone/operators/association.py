"""Contingency tables and chi-square tests of independence."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions import tails
from tallystone.functions.columns import long_strings, ref
from tallystone.operators.compare import V_LIMITS, effect_label
from tallystone.session import materialize

CHI_SCHEMA = (
    "column string, chi2 double, p_value double, dof bigint, cramers_v double, effect string, "
    "significant boolean, low_expected boolean"
)


def crosstab(df: DataFrame, column: str, target: str) -> DataFrame:
    """Pair counts ``(value, target, n)``; pairs with a missing side are dropped, absent pairs are 0."""
    both = df.where(ref(column).isNotNull() & ref(target).isNotNull())
    pairs = both.select(ref(column).cast("string").alias("value"), ref(target).cast("string").alias("target"))
    cells = pairs.groupBy("value", "target").agg(F.count("*").alias("n"))
    classes = [r["target"] for r in cells.select("target").distinct().collect()]  # the width of the table
    every = cells.select("value").distinct().withColumn("target", F.explode(F.lit(sorted(classes))))
    return every.join(cells, ["value", "target"], "left").na.fill(0, ["n"])


def chi_square_parts(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """All that the test needs, one row per column.

    The rows are reduced once to counts of (column, value, class); margins come from those cells. The
    statistic adds up (O - E)^2 / E over the cells, and what absent cells add: a row's
    total times the totals of the classes it lacks, over n.
    """
    rows = df.where(ref(target).isNotNull()).withColumn("_target", ref(target).cast("string"))
    counted = long_strings(rows, columns, ["_target"]).groupBy("column", "value", "_target").agg(F.count("*").alias("o"))
    cells = materialize(counted, "cells")
    classes = cells.groupBy("column", "_target").agg(F.sum("o").alias("c"))
    whole = classes.groupBy("column").agg(
        F.sum("c").alias("n"), F.count("*").alias("n_cols"), F.min("c").alias("least_col"),
        F.sum(1.0 / F.col("c")).alias("inverse_cols"),
    )
    row_total = F.sum("o").over(Window.partitionBy("column", "value"))
    expected = F.col("r").cast("double") * F.col("c") / F.col("n")
    off = F.col("o") - F.col("expected")
    by_row = (
        cells.withColumn("r", row_total)
        .join(classes, ["column", "_target"])
        .join(F.broadcast(whole), "column")  # one row per column
        .withColumn("expected", expected)
        .groupBy("column", "value", "n", "n_cols", "least_col", "inverse_cols", "r")
        .agg(F.sum(off * off / F.col("expected")).alias("met"), F.sum("c").alias("c_met"))
    )
    absent = F.col("r").cast("double") * (F.col("n") - F.col("c_met")) / F.col("n")
    return by_row.groupBy("column", "n", "n_cols", "least_col", "inverse_cols").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("met") + absent).alias("chi2"),
        F.min("r").alias("least_row"),
        F.sum(1.0 / F.col("r")).alias("inverse_rows"),
    )


def chi_square_tests(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    alpha: float = 0.05,
    yates: bool | str = "auto",
) -> DataFrame:
    """Pearson chi-square with Cramér's V for every listed column against the target.

    ``yates='auto'`` applies the continuity correction when there is one degree
    of freedom; ``True`` does the same, ``False`` never does. A column without
    values has no row.
    """
    result = []
    for r in chi_square_parts(df, columns, target).collect():
        n, dof = r["n"], (r["n_rows"] - 1) * (r["n_cols"] - 1)
        chi2 = r["chi2"] if dof else 0.0
        if dof == 1 and yates:
            # in a 2x2 table every cell is off by the same amount
            inverse_expected = n * r["inverse_rows"] * r["inverse_cols"]
            off = math.sqrt(chi2 / inverse_expected)
            chi2 = max(0.0, off - 0.5) ** 2 * inverse_expected
        p = tails.chi2_sf(chi2, dof) if dof else 1.0
        smaller = min(r["n_rows"], r["n_cols"]) - 1
        v = math.sqrt(chi2 / (n * smaller)) if smaller > 0 else 0.0
        low = r["least_row"] * r["least_col"] / n < 5
        result.append((
            r["column"], round(chi2, 4), round(p, 6), dof, round(v, 4), effect_label(v, V_LIMITS),
            p < alpha, low,
        ))
    return df.sparkSession.createDataFrame(result, CHI_SCHEMA)


def fisher_exact(df: DataFrame, columns: Sequence[str], target: str, alpha: float = 0.05) -> DataFrame:
    """Fisher's exact test of every two-valued column against a two-valued target.

    The rows are reduced to counts of (column, value, class); missing values are left out. Values and classes are taken in
    sorted order, so the odds ratio is that of the first value for the first class. A column with other than two values, or a
    target with other than two classes, is refused.

    Returns ``(column, n, odds_ratio, p_value, significant)``; the ratio is NULL where a cell of the other diagonal is empty.
    """
    rows = df.where(ref(target).isNotNull()).withColumn("_target", ref(target).cast("string"))
    cells = materialize(long_strings(rows, columns, ["_target"]).groupBy("column", "value", "_target").agg(F.count("*").alias("n")), "cells")
    width = cells.groupBy("column").agg(F.countDistinct("value").alias("v"), F.countDistinct("_target").alias("t")).collect()
    wrong = sorted(r["column"] for r in width if (r["v"], r["t"]) != (2, 2))
    if wrong:
        raise ValueError(f"not a 2x2 table: {wrong}")
    found: dict[str, dict] = {}
    for r in cells.collect():  # four per column
        found.setdefault(r["column"], {})[r["value"], r["_target"]] = r["n"]
    result = []
    for c in (c for c in columns if c in found):
        values, classes = (sorted({k[i] for k in found[c]}) for i in (0, 1))
        a, b, x, y = (found[c].get((v, t), 0) for v in values for t in classes)
        p = tails.fisher_two_sided(a, b, x, y)
        ratio = round(a * y / (b * x), 4) if b * x else None
        result.append((c, a + b + x + y, ratio, round(p, 6), p < alpha))
    return df.sparkSession.createDataFrame(result, "column string, n bigint, odds_ratio double, p_value double, significant boolean")
