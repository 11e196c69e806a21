"""The text report of an analysis: overview, data quality and the significant tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def significant_findings(group_tests: DataFrame, chi_square: DataFrame) -> DataFrame:
    """``(test, column, p_value, effect_size, effect)`` of the significant tests only."""
    a = group_tests.where("significant").select(
        F.col("test_type").alias("test"), "column", "p_value", F.col("cohens_d").alias("effect_size"), "effect"
    )
    b = chi_square.where("significant").select(
        F.lit("Chi-square").alias("test"), "column", "p_value", F.col("cramers_v").alias("effect_size"), "effect"
    )
    return a.unionByName(b)


def summary_lines(
    basic: DataFrame, missing: DataFrame, duplicates: DataFrame, group_tests: DataFrame, chi_square: DataFrame
) -> DataFrame:
    """The report as ``(section, position, line)``; every input is a result table."""

    def lines(section: int, df: DataFrame, text, position=F.lit(0)) -> DataFrame:
        return df.select(F.lit(section).alias("section"), position.cast("int").alias("position"), text.alias("line"))

    def tests(section: int, title: str, df: DataFrame, effect: str, symbol: str) -> DataFrame:
        head = df.agg(F.count_if("significant").alias("s"), F.count("*").alias("n"))
        body = F.format_string(
            f"  - %s: p=%.4f, {symbol}=%.3f (%s)", "column", "p_value", effect, "effect"
        )
        return lines(section, head, F.format_string(f"{title}: %d/%d significant", "s", "n")).unionByName(
            lines(section, df.where("significant"), body, F.lit(1))
        )

    affected = missing.agg(F.count("*").alias("n"))
    missing_text = F.when(F.col("n") > 0, F.format_string("Missing values: %d columns affected", "n")).otherwise(
        "Missing values: None"
    )
    duplicate_text = F.when(
        F.col("has_duplicates"),
        F.format_string("Duplicates: %d rows (%.2f%%)", "duplicate_count", "duplicate_percent"),
    ).otherwise("Duplicates: None")
    return (
        lines(1, basic, F.format_string("Rows: %d, columns: %d", "n_rows", "n_columns"))
        .unionByName(lines(2, affected, missing_text))
        .unionByName(lines(3, duplicates, duplicate_text))
        .unionByName(tests(4, "Group comparisons", group_tests, "cohens_d", "d"))
        .unionByName(tests(5, "Chi-square tests", chi_square, "cramers_v", "V"))
        .orderBy("section", "position", "line")
    )


def write_report(lines: DataFrame, path: str) -> None:
    """One text file: a report has as many lines as there are tested columns."""
    lines.orderBy("section", "position", "line").select("line").coalesce(1).write.mode("overwrite").text(path)
