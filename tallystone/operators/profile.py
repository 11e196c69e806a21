"""Descriptive profiles of numeric and categorical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.columns import (
    categorical_columns,
    column_aggregates,
    long_strings,
    missing_sql,
    numeric_columns,
    quoted,
    ref,
)
from tallystone.operators.quantiles import exact_quantiles

PROFILE_SCHEMA = (
    "column string, count bigint, mean double, std double, min double, q25 double, q50 double, "
    "q75 double, max double, range double, cv double"
)


def basic_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.array_join(F.array(*[F.lit(c) for c in df.columns]), ",").alias("columns"),
    )


def numeric_profile(
    df: DataFrame, columns: Sequence[str] | None = None, id_column: str | None = None
) -> DataFrame:
    """Count, mean, std(n-1), min, quartiles, max, range and cv, one row per numeric column."""
    columns = list(columns or numeric_columns(df, [id_column] if id_column else []))
    found = exact_quantiles(
        df,
        columns,
        [0.25, 0.5, 0.75],
        extras={"mean": "avg({v})", "std": "stddev_samp({v})", "min": "min({v})", "max": "max({v})"},
    )
    rows = []
    for c, s in found.items():
        e, q = s.extras, s.values
        spread = e["max"] - e["min"] if s.n else None
        cv = round(e["std"] / e["mean"], 4) if e["std"] is not None and e["mean"] else None
        rows.append(
            (c, s.n, e["mean"], e["std"], e["min"], q[0.25], q[0.5], q[0.75], e["max"], spread, cv)
        )
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return column_aggregates(df, columns, {"min": "min({v})", "max": "max({v})"})


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, value_count)`` over all listed columns in one map-side combined group-by."""
    return long_strings(df, columns).groupBy("column", "value").agg(F.count("*").alias("value_count"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """The ``n`` most frequent values per column; ties go to the smaller value.

    The rank filter lets Spark keep only ``n`` rows per column and map task
    before the shuffle, so a column of distinct keys is not collected anywhere.
    """
    columns = list(columns or categorical_columns(df))
    w = Window.partitionBy("column").orderBy(F.desc("value_count"), "value")
    return (
        value_counts(df, columns)
        .withColumn("position", F.row_number().over(w))
        .where(F.col("position") <= n)
    )


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-missing count, distinct count, mode and its count, one row per categorical column."""
    columns = list(columns or categorical_columns(df))
    # the smallest (-count, value) is the most frequent value, ties to the smaller one
    mode = F.min(F.struct((-F.col("value_count")).alias("neg"), F.col("value").alias("value")))
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(
            F.sum("value_count").alias("count"),
            F.count("*").alias("unique_count"),
            mode.alias("_mode"),
        )
        .select(
            "column",
            "count",
            "unique_count",
            F.col("_mode.value").alias("most_frequent"),
            (-F.col("_mode.neg")).alias("most_frequent_count"),
        )
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-missing values per column; ``approximate`` trades exactness for no shuffle of values."""
    if approximate:
        fields = {"unique_count": lambda c: f"approx_count_distinct({quoted(c)})"}
        return column_aggregates(df, columns, fields, value=missing_sql)
    # a column without values still gets its row, from a literal list of names
    counted = (
        value_counts(df, columns).groupBy("column").agg(F.count("*").alias("unique_count"))
    )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(counted, "column", "left").select(
        "column", F.coalesce("unique_count", F.lit(0)).alias("unique_count")
    )


def unique_sample(df: DataFrame, columns: Sequence[str], n: int = 6) -> DataFrame:
    """The first ``n`` distinct values of each column in sorted order."""
    w = Window.partitionBy("column").orderBy("value")
    return (
        long_strings(df, columns)
        .distinct()
        .withColumn("position", F.row_number().over(w))
        .where(F.col("position") <= n)
    )


def class_distribution(df: DataFrame, target: str, split: str | None = None) -> DataFrame:
    """Rows and percent per class, and per split when one is given."""
    keys = ([split] if split else []) + [target]
    counts = df.groupBy(*[ref(k) for k in keys]).agg(F.count("*").alias("n"))
    # one row per class: the window sees as many rows as there are classes
    w = Window.partitionBy(*([ref(split)] if split else [F.lit(0)]))
    return counts.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(w))


# Bias-adjusted sample skewness; missing below three values, NaN from no spread becomes missing too.
SKEWNESS = (
    "CASE WHEN count({v}) >= 3 THEN nanvl(skewness({v}), CAST(NULL AS DOUBLE))"
    " * sqrt(count({v}) * (count({v}) - 1.0D)) / (count({v}) - 2) END"
)


def skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return column_aggregates(df, columns, {"skewness": SKEWNESS})


def log_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What a log transform needs to know: min, max, mean, skewness, zeros, negatives."""
    fields = {
        "min": "min({v})",
        "max": "max({v})",
        "mean": "avg({v})",
        "skewness": SKEWNESS,
        "has_zeros": "coalesce(bool_or({v} = 0), false)",
        "has_negatives": "coalesce(bool_or({v} < 0), false)",
    }
    return column_aggregates(df, columns, fields)


def group_means(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Mean of every column by group, 4 decimals."""
    rows = df.where(ref(group).isNotNull())
    return column_aggregates(rows, columns, {"mean": "round(avg({v}), 4)"}, by={"group": quoted(group)})
