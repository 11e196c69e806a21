"""Missing values, duplicates and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions.columns import column_aggregates, double_literal, missing_sql, present, ref
from tallystone.operators.quantiles import exact_quantiles


def severity(fraction: Column, warning: float, critical: float) -> Column:
    return (
        F.when(fraction >= critical, "CRITICAL").when(fraction >= warning, "WARNING").otherwise("INFO")
    )


def missing_report(
    df: DataFrame, columns: Sequence[str] | None = None, warning: float = 0.05, critical: float = 0.30
) -> DataFrame:
    """Columns with missing values, most affected first; NULL and NaN both count."""
    columns = list(columns or df.columns)
    fields = {"missing_count": "count_if({v})", "_rows": "count(*)"}
    report = column_aggregates(df, columns, fields, value=missing_sql)
    fraction = F.round(F.col("missing_count") / F.col("_rows"), 4)
    return (
        report.where(F.col("missing_count") > 0)
        .select("column", "missing_count", fraction.alias("missing_fraction"))
        .withColumn("severity", severity(F.col("missing_fraction"), warning, critical))
        .orderBy(F.desc("missing_count"), "column")
    )


EXACT_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """32 bytes that stand for the key columns, so that wide keys are not shuffled.

    NULL equals NULL, NaN equals NULL and -0.0 equals 0.0, as in a group-by. Times keep
    their microseconds and their offset.
    """
    cells = []
    for c in columns:
        v = present(df, c)
        numeric = df.schema[c].dataType.typeName() in ("double", "float")
        cells.append((v + F.lit(0.0) if numeric else v).alias(c))
    text = F.to_json(F.struct(*cells), EXACT_JSON)
    return F.unhex(F.sha2(text, 256))


def duplicate_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key, as count and percent of all rows."""
    keys = df.select(row_digest(df, subset or df.columns).alias("_key"))
    groups = keys.groupBy("_key").agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"),
    ).select(
        "row_count",
        "duplicate_count",
        F.coalesce(F.try_divide(F.col("duplicate_count") * 100.0, "row_count"), F.lit(0.0)).alias(
            "duplicate_percent"
        ),
        (F.col("duplicate_count") > 0).alias("has_duplicates"),
    )


def duplicate_rows(df: DataFrame, key: str, subset: Sequence[str] | None = None) -> DataFrame:
    """All rows but the first of each group of copies, first meaning lowest ``key``.

    The first rows are found by a map-side combined minimum, and removed by an
    anti join on row key and digest: a group of copies of any size is never
    brought together. A NULL key comes after all others of its group.
    """
    subset = list(subset or [c for c in df.columns if c != key])
    keyed = df.withColumn("_digest", row_digest(df, subset))
    firsts = keyed.groupBy(F.col("_digest").alias("_first")).agg(F.min(ref(key)).alias("_first_key"))
    same = (F.col("_digest") == F.col("_first")) & ref(key).eqNullSafe(F.col("_first_key"))
    return keyed.join(firsts, same, "left_anti").drop("_digest")


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], multiplier: float = 1.5
) -> dict[str, tuple[float, float, float, float]]:
    """Per column ``(lower, upper, q1, q3)``; columns without values are left out."""
    found = exact_quantiles(df, columns, [0.25, 0.75])
    bounds = {}
    for c, s in found.items():
        if s.n:
            q1, q3 = s.values[0.25], s.values[0.75]
            spread = multiplier * (q3 - q1)
            bounds[c] = (q1 - spread, q3 + spread, q1, q3)
    return bounds


def zscore_bounds(
    df: DataFrame, columns: Sequence[str], threshold: float = 3.0
) -> dict[str, tuple[float, float, float, float]]:
    """Per column ``(lower, upper, mean, std)`` from one aggregate."""
    stats = column_aggregates(df, columns, {"m": "avg({v})", "s": "stddev_samp({v})"})
    return {
        r["column"]: (r["m"] - threshold * r["s"], r["m"] + threshold * r["s"], r["m"], r["s"])
        for r in stats.collect()  # one row per column
        if r["m"] is not None and r["s"] is not None
    }


def _outside(df: DataFrame, bounds: dict, names: tuple[str, str]) -> DataFrame:
    def constant(i: int):
        return lambda c: f"round(any_value({double_literal(bounds[c][i])}), 2)"

    def beyond(c: str) -> str:
        low, high = (double_literal(b) for b in bounds[c][:2])
        return f"count_if({{v}} < {low} OR {{v}} > {high})"

    fields = {
        "outlier_count": beyond,
        "outlier_percent": lambda c: f"round({beyond(c)} * 100.0D / count(*), 2)",
        "lower_bound": constant(0),
        "upper_bound": constant(1),
        names[0]: constant(2),
        names[1]: constant(3),
    }
    return column_aggregates(df, list(bounds), fields)


def iqr_outliers(
    df: DataFrame, columns: Sequence[str], multiplier: float = 1.5, id_column: str | None = None
) -> DataFrame:
    """Values strictly outside Q1 - k·IQR … Q3 + k·IQR, per column; percent of all rows."""
    columns = [c for c in columns if c != id_column]
    report = _outside(df, iqr_bounds(df, columns, multiplier), ("q1", "q3"))
    return report.withColumn("iqr", F.round(F.col("q3") - F.col("q1"), 2))


def zscore_outliers(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    return _outside(df, zscore_bounds(df, columns, threshold), ("mean", "std"))
