"""Exploratory analysis of one table: quality, description, tests, plot data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallystone.functions.columns import categorical_columns, numeric_columns
from tallystone.operators import association, compare, correlation, plotdata, profile, quality
from tallystone.sources.report import summary_lines


@dataclass(frozen=True)
class AnalysisSettings:
    target: str
    positive: str
    negative: str
    key: str
    confidence: float = 0.95
    alpha: float = 0.05
    iqr_multiplier: float = 1.5
    missing_warning: float = 0.05
    missing_critical: float = 0.30
    min_group_size: int = 3
    correction: str = "none"
    plots: bool = True


def analyze(df: DataFrame, s: AnalysisSettings) -> dict[str, DataFrame]:
    """All result tables by name. Each is a handful of jobs whatever the number of columns."""
    nums = numeric_columns(df, [s.key])
    cats = categorical_columns(df, [s.key])
    tested = [c for c in cats if c != s.target]
    out = {
        "missing": quality.missing_report(df, warning=s.missing_warning, critical=s.missing_critical),
        "duplicates": quality.duplicate_report(df),
        "outliers": quality.iqr_outliers(df, nums, s.iqr_multiplier),
        "basic": profile.basic_stats(df),
        "numeric": profile.numeric_profile(df, nums),
        "categorical": profile.categorical_profile(df, cats),
        "top_values": profile.top_values(df, cats),
        "target": profile.class_distribution(df, s.target),
        "confidence_intervals": compare.confidence_intervals(df, nums, s.confidence),
        "group_tests": compare.adjust_p_values(
            compare.two_group_compare(
                df, nums, s.target, s.positive, s.negative, s.key, "auto", s.alpha, s.min_group_size
            ),
            s.correction,
            alpha=s.alpha,
        ),
        "chi_square": compare.adjust_p_values(
            association.chi_square_tests(df, tested, s.target, s.alpha), s.correction, alpha=s.alpha
        ),
    }
    if s.plots:
        out |= {
            "histogram": plotdata.histogram(df, nums),
            "density": plotdata.density(df, nums),
            "box": plotdata.box_stats(df, nums),
            "category_counts": profile.value_counts(df, cats),
        }
        if len(nums) > 1:
            out["correlation"] = correlation.heatmap_cells(df, nums, "spearman", s.key)
    out["summary"] = summary_lines(
        out["basic"], out["missing"], out["duplicates"], out["group_tests"], out["chi_square"]
    )
    return out
