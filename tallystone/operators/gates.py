"""Promotion gates over metric rows: thresholds, overfitting, business rules, incumbents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions.columns import ref
from tallystone.operators.metrics import ratio


@dataclass(frozen=True)
class Threshold:
    minimum: float = 0.0
    warning: float = 0.0
    target: float = 1.0


# fixed values: the thresholds the gates start from
THRESHOLDS = {"f1_score": Threshold(0.70, 0.75, 0.85), "roc_auc": Threshold(0.75, 0.80, 0.90)}
MAX_GAP, WARN_GAP = 0.15, 0.10
MIN_RECALL, MAX_FPR = 0.80, 0.30
MIN_IMPROVEMENT = 0.01
REGISTRY_MINIMUM = {"f1_score": 0.70, "roc_auc": 0.75}
COMPARED = ("f1_score", "precision", "recall", "roc_auc", "train_val_gap", "training_time")


def performance_gate(metrics: DataFrame, thresholds: Mapping[str, Threshold] = THRESHOLDS) -> DataFrame:
    """FAIL below the minimum, WARNING below the warning level, EXCELLENT from the target, else PASS."""
    limits = metrics.sparkSession.createDataFrame(
        [(m, t.minimum, t.warning, t.target) for m, t in thresholds.items()],
        "metric string, minimum double, warning double, target double",
    )
    v = F.col("value")
    status = (
        F.when(v < F.col("minimum"), "FAIL")
        .when(v < F.col("warning"), "WARNING")
        .when(v >= F.col("target"), "EXCELLENT")
        .otherwise("PASS")
    )
    joined = metrics.join(F.broadcast(limits), "metric")  # one row per threshold
    return joined.withColumn("status", status).withColumn("passed", F.col("status") != "FAIL")


def registry_gate(metrics: DataFrame, minimum: Mapping[str, float] = REGISTRY_MINIMUM) -> DataFrame:
    """The same ladder with minimums only."""
    return performance_gate(metrics, {m: Threshold(v, v, 1.0) for m, v in minimum.items()})


def overfitting_gate(gaps: DataFrame, max_gap: float = MAX_GAP, warning: float = WARN_GAP) -> DataFrame:
    """FAIL above the largest allowed gap, WARNING above the warning level. Input: gap rows."""
    gap = F.col("gap")
    status = F.when(gap > max_gap, "FAIL").when(gap > warning, "WARNING").otherwise("PASS")
    return gaps.withColumn("status", status).withColumn("passed", gap <= max_gap)


def business_gate(confusion: DataFrame, min_recall: float = MIN_RECALL, max_fpr: float = MAX_FPR) -> DataFrame:
    """Recall and false-positive rate, from confusion cells ``(y, pred, n)``."""

    def cell(y: int, pred: int) -> Column:
        return F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("pred") == pred), F.col("n"))), F.lit(0))

    row = confusion.agg(
        cell(1, 1).alias("tp"), cell(1, 0).alias("fn"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn")
    )
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    fpr = ratio(F.col("fp"), F.col("fp") + F.col("tn"))
    checks = row.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("recall").alias("rule"), recall.alias("value"), F.lit(min_recall).alias("bound"),
                    (recall >= min_recall).alias("passed"),
                ),
                F.struct(
                    F.lit("false_positive_rate").alias("rule"), fpr.alias("value"), F.lit(max_fpr).alias("bound"),
                    (fpr <= max_fpr).alias("passed"),
                ),
            )
        )
    )
    return checks.withColumn("status", F.when(F.col("passed"), "PASS").otherwise("FAIL"))


def combined_verdict(*checks: DataFrame) -> DataFrame:
    """True only if every check row of every gate passed."""
    rows = None
    for c in checks:
        part = c.select("passed")
        rows = part if rows is None else rows.unionByName(part)
    return rows.agg(
        F.count("*").alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("overall_passed"),
    )


def production_comparison(
    candidate: DataFrame,
    incumbent: DataFrame | None,
    metric: str = "f1_score",
    min_improvement: float = MIN_IMPROVEMENT,
) -> DataFrame:
    """Should the candidate replace the incumbent? Reported, never part of the verdict.

    Both sides are metric rows ``(metric, value)``; without an incumbent the candidate wins.
    """
    rows = candidate.select("metric", "value", F.lit(True).alias("new"))
    if incumbent is not None:
        rows = rows.unionByName(incumbent.select("metric", "value", F.lit(False).alias("new")))

    def best(side: Column) -> Column:
        return F.coalesce(F.max(F.when(side & (F.col("metric") == metric), F.col("value"))), F.lit(0.0))

    both = rows.agg(
        best(F.col("new")).alias("new_score"),
        best(~F.col("new")).alias("production_score"),
        F.count_if(~F.col("new")).alias("n"),
    )
    gain = F.col("new_score") - F.col("production_score")
    none = F.col("n") == 0
    return both.select(
        "production_score",
        "new_score",
        gain.alias("improvement"),
        F.when(F.col("production_score") > 0, gain / F.col("production_score") * 100.0)
        .otherwise(0.0)
        .alias("improvement_percent"),
        (none | (gain >= min_improvement)).alias("should_replace"),
        F.when(none, "no_production_model")
        .when(gain >= min_improvement, "better_performance")
        .otherwise("insufficient_improvement")
        .alias("reason"),
    )


def compare_runs(staging: DataFrame, production: DataFrame, metrics: Sequence[str] = COMPARED) -> DataFrame:
    """Metric by metric: both values (missing counts as 0), absolute and percent difference."""
    names = staging.sparkSession.createDataFrame([(m,) for m in metrics], "metric string")
    s = staging.select("metric", F.col("value").alias("s"))
    p = production.select("metric", F.col("value").alias("p"))
    both = names.join(s, "metric", "left").join(p, "metric", "left").select(
        "metric",
        F.coalesce("s", F.lit(0.0)).alias("staging"),
        F.coalesce("p", F.lit(0.0)).alias("production"),
    )
    diff = F.col("staging") - F.col("production")
    percent = F.when(F.col("production") != 0, diff / F.col("production") * 100.0).otherwise(0.0)
    return both.withColumns({
        "difference": diff,
        "difference_percent": percent,
        "direction": F.when(diff > 0, "up").when(diff < 0, "down").otherwise("same"),
    })


def recommendation(comparison: DataFrame, metric: str = "f1_score", gain: float = 0.01) -> DataFrame:
    """PROMOTE above the gain, MARGINAL above zero, else REJECT."""
    diff = F.col("difference")
    verdict = F.when(diff > gain, "PROMOTE").when(diff > 0, "MARGINAL").otherwise("REJECT")
    return comparison.where(F.col("metric") == metric).select("metric", "difference", verdict.alias("recommendation"))


def leaderboard(results: DataFrame, metric: str = "f1_score", n: int | None = None) -> DataFrame:
    """Models by the metric, best first; ties by model name. Input: ``(model, is_tuned, metric, value)``."""
    rows = (
        results.where(F.col("metric") == metric)
        .select("model", "is_tuned", F.col("value").alias("score"))
        .orderBy(F.desc("score"), "model", "is_tuned")
    )
    return rows.limit(n) if n else rows


# fixed values: weights, preference order and limits of the balanced score
BALANCED_WEIGHTS = {"primary_metric": 0.5, "training_time": 0.15, "interpretability": 0.15, "generalization": 0.20}
PREFERENCE = ("LogisticRegression", "RandomForest", "XGBoost", "LightGBM")
MAX_TRAINING_SECONDS, MAX_GENERALIZATION_GAP = 300.0, 0.10


def balanced_score(models: DataFrame, weights: Mapping[str, float] = BALANCED_WEIGHTS) -> DataFrame:
    """Weighted score from ``(model, score, training_time, gap)`` rows, best first.

    Time and gap count in full at 0 and not at all at their limit; the preference
    order gives equal steps from 1 down.
    """
    place = F.lit(0.0)
    for i, name in enumerate(PREFERENCE):
        place = F.when(F.col("model") == name, 1.0 - i / len(PREFERENCE)).otherwise(place)

    def room(c: Column, limit: float) -> Column:
        return F.greatest(F.lit(0.0), 1.0 - c / limit)

    total = (
        weights["primary_metric"] * F.col("score")
        + weights["training_time"] * room(F.col("training_time"), MAX_TRAINING_SECONDS)
        + weights["interpretability"] * place
        + weights["generalization"] * room(F.abs(F.col("gap")), MAX_GENERALIZATION_GAP)
    )
    return models.withColumn("balanced_score", total).orderBy(F.desc("balanced_score"), ref("model"))
