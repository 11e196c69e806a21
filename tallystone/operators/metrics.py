"""Exact binary-classification metrics from scored rows ``(y, p, pred)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.columns import ref
from tallystone.operators.ranks import running

METRICS = (
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "roc_auc",
    "average_precision",
    "brier_score",
    "log_loss",
)
RANKED = ("roc_auc", "average_precision")
CLIP = 2.220446049250313e-16  # fixed value: probabilities are kept this far from 0 and 1


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def counts(y: Column, pred: Column) -> list[Column]:
    return [
        F.count_if((y == 1) & (pred == 1)).alias("tp"),
        F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"),
        F.count_if((y == 0) & (pred == 0)).alias("tn"),
    ]


def log_loss_term(y: Column, p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1.0 - CLIP)), F.lit(CLIP))
    return -F.when(y == 1, F.ln(q)).otherwise(F.ln(1.0 - q))


def threshold_metrics(
    scored: DataFrame, y: str = "y", p: str = "p", pred: str = "pred", by: Sequence[str] = ()
) -> DataFrame:
    """Counts, accuracy, precision, recall, f1, Brier score and log loss in one aggregate."""
    yc, pc = ref(y), ref(p).cast("double")
    keys = [ref(b) for b in by]
    agg = scored.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *counts(yc, ref(pred)),
        F.avg(F.pow(pc - yc, 2.0)).alias("brier_score"),
        F.avg(log_loss_term(yc, pc)).alias("log_loss"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return agg.select(
        *keys,
        "n",
        "tp",
        "fp",
        "fn",
        "tn",
        ratio(tp + tn, F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "brier_score",
        "log_loss",
    )


def score_cells(scored: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with running counts from the highest score down."""
    keys = [ref(b) for b in by]
    cells = (
        scored.groupBy(*keys, ref(p).cast("double").alias("score"))
        .agg(F.count_if(ref(y) == 1).alias("pos"), F.count_if(ref(y) == 0).alias("neg"))
        .withColumn("all", F.lit(0))
    )
    part = [*by] or ["all"]
    return running(cells, part, [F.desc("score")], ["pos", "neg"])


def ranking_metrics(scored: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC (ties count half) and step-wise average precision, both exact.

    With a single class the AUC is undefined and comes back missing.
    """
    cells = score_cells(scored, y, p, by)
    tp, fp = F.col("pos_upto").cast("double"), F.col("neg_upto").cast("double")
    # pairs won: positives of this score against the negatives scored lower, ties half
    above = fp - F.col("neg") / 2.0
    agg = cells.groupBy(*[ref(b) for b in by]).agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(F.col("pos") * above).alias("lost"),
        F.sum(F.col("pos") * tp / (tp + fp)).alias("ap"),
    )
    n_pos, n_neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    auc = F.when((n_pos > 0) & (n_neg > 0), 1.0 - F.col("lost") / (n_pos * n_neg))
    return agg.select(
        *[ref(b) for b in by], auc.alias("roc_auc"), ratio(F.col("ap"), n_pos).alias("average_precision")
    )


def evaluate(
    scored: DataFrame,
    y: str = "y",
    p: str = "p",
    pred: str = "pred",
    metrics: Sequence[str] = METRICS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Tidy ``(by…, metric, value)`` for the chosen metrics; unknown names are ignored."""
    keys = [ref(b) for b in by]
    ranked = [m for m in metrics if m in RANKED]
    plain = [m for m in metrics if m in METRICS and m not in RANKED]
    parts = []
    if plain:
        parts.append(threshold_metrics(scored, y, p, pred, by).unpivot(keys, plain, "metric", "value"))
    if ranked:
        parts.append(ranking_metrics(scored, y, p, by).unpivot(keys, ranked, "metric", "value"))
    if not parts:
        raise ValueError(f"no known metric among {list(metrics)}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def confusion_matrix(
    scored: DataFrame, y: str = "y", pred: str = "pred", normalize: str | None = "true"
) -> DataFrame:
    """All four cells ``(y, pred, n, share)``; ``normalize`` is true, pred, all or None."""
    if normalize not in ("true", "pred", "all", None):
        raise ValueError(f"unknown normalisation: {normalize}")
    row = scored.agg(*counts(ref(y), ref(pred)))
    cells = row.select(
        F.inline(
            F.array(*[
                F.struct(F.lit(a).alias("y"), F.lit(b).alias("pred"), F.col(c).alias("n"))
                for a, b, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
            ])
        )
    )
    if normalize is None:
        return cells.withColumn("share", F.col("n").cast("double"))
    part = {"true": ["y"], "pred": ["pred"], "all": [F.lit(0)]}[normalize]
    w = Window.partitionBy(*part)  # four rows
    return cells.withColumn("share", ratio(F.col("n"), F.sum("n").over(w)))


def classification_report(scored: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Precision, recall, f1 and support per class, with macro and weighted averages."""
    row = scored.agg(*counts(ref(y), ref(pred)))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    per = row.select(
        F.inline(
            F.array(*[
                F.struct(
                    F.lit(label).alias("label"),
                    ratio(hit, hit + wrong).alias("precision"),
                    ratio(hit, hit + lost).alias("recall"),
                    ratio(2 * hit, 2 * hit + wrong + lost).alias("f1_score"),
                    (hit + lost).alias("support"),
                )
                for label, hit, wrong, lost in (("0", tn, fn, fp), ("1", tp, fp, fn))
            ])
        )
    )
    names = ("precision", "recall", "f1_score")
    # two rows in: one per class
    macro = per.agg(*[F.avg(m).alias(m) for m in names], F.sum("support").alias("support"))
    weighted = per.agg(
        *[ratio(F.sum(ref(m) * F.col("support")), F.sum("support")).alias(m) for m in names],
        F.sum("support").alias("support"),
    )
    order = ["label", *names, "support"]
    return (
        per.select(*order)
        .unionByName(macro.withColumn("label", F.lit("macro avg")).select(*order))
        .unionByName(weighted.withColumn("label", F.lit("weighted avg")).select(*order))
    )


def generalization_gap(
    metrics: DataFrame, dataset: str = "dataset", train: str = "train", val: str = "val", limit: float = 0.10
) -> DataFrame:
    """``(keys…, metric, train, val, gap, gap_percent, status)`` from tidy metric rows."""
    keys = [c for c in metrics.columns if c not in (dataset, "value")]
    sides = metrics.groupBy(*[ref(k) for k in keys]).agg(
        F.max(F.when(ref(dataset) == train, F.col("value"))).alias("train_score"),
        F.max(F.when(ref(dataset) == val, F.col("value"))).alias("val_score"),
    )
    t, v = F.coalesce("train_score", F.lit(0.0)), F.coalesce("val_score", F.lit(0.0))
    gap = t - v
    return sides.select(
        *[ref(k) for k in keys],
        t.alias("train_score"),
        v.alias("val_score"),
        gap.alias("gap"),
        F.when(t > 0, gap / t * 100.0).otherwise(0.0).alias("gap_percent"),
        F.when(F.abs(gap) <= limit, "good").otherwise("poor").alias("generalization_status"),
    )
