"""Classification metrics, curves and promotion gates on scored documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.operators import gates, metrics, models, plotdata
from tallystone.plans.catalog.registry import RIVAL, SCORED, query, rival, rounded, scored

COUNTS = """count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn"""
CLIPPED = "greatest(least(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16)"
LOSSES = f"""avg((p - y) * (p - y)) AS brier_score,
  avg(CASE WHEN y = 1 THEN -ln({CLIPPED}) ELSE -ln(1 - {CLIPPED}) END) AS log_loss"""
RATES = """coalesce((tp + tn) / nullif(n, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_score"""
RANKING = """
cum AS (SELECT {k} g, p, sum(y) AS pos, sum(1 - y) AS neg FROM src GROUP BY ALL),
run AS (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, sum(pos) OVER (PARTITION BY g) AS np,
        sum(neg) OVER (PARTITION BY g) AS nn FROM cum WINDOW w AS (PARTITION BY g ORDER BY p DESC)),
ranked AS (SELECT g, 1 - sum(pos * (fps - neg / 2)) / nullif(any_value(CAST(np AS DOUBLE) * nn), 0) AS roc_auc,
        coalesce(sum(pos * tps / (tps + fps)) / nullif(any_value(np), 0), 0) AS average_precision FROM run GROUP BY 1)
"""
NAMES = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "average_precision", "brier_score", "log_loss")


def tidy(source: str, g: str = "0") -> str:
    """CTEs ending in ``tidy(g, metric, value)`` for a scored source."""
    return (
        f"src AS ({source}), base AS (SELECT {g} AS g, count(*) AS n, {COUNTS}, {LOSSES} FROM src GROUP BY 1), "
        f"rates AS (SELECT *, {RATES} FROM base), "
        + RANKING.format(k=f"{g} AS")
        + ", tidy AS ("
        + " UNION ALL ".join(
            f"SELECT g, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value FROM rates JOIN ranked USING (g)" for m in NAMES
        )
        + ")"
    )


@query(
    "threshold_metrics",
    f"""WITH b AS (SELECT count(*) AS n, {COUNTS}, {LOSSES} FROM ({SCORED})), r AS (SELECT *, {RATES} FROM b)
    SELECT n, tp, fp, fn, tn, {", ".join(f'round("{m}", 6) AS "{m}"' for m in NAMES if m not in ("roc_auc", "average_precision"))} FROM r""",
)
def threshold_metrics(spark, sf):
    return rounded(metrics.threshold_metrics(scored(spark, sf)), 6)


@query(
    "ranking_metrics",
    f"WITH {tidy(SCORED)} SELECT round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM ranked",
)
def ranking_metrics(spark, sf):
    return rounded(metrics.ranking_metrics(scored(spark, sf)), 6)


@query("evaluate", f"WITH {tidy(SCORED)} SELECT metric, round(value, 6) AS value FROM tidy")
def evaluate(spark, sf):
    return rounded(metrics.evaluate(scored(spark, sf)), 6)


@query(
    "evaluate_by_language",
    f"WITH {tidy(SCORED, 'lang')} SELECT g AS lang, metric, round(value, 6) AS value FROM tidy",
)
def evaluate_by_language(spark, sf):
    return rounded(metrics.evaluate(scored(spark, sf), by=["lang"]), 6)


CELLS = f"""WITH src AS ({SCORED}),
grid AS (SELECT CAST(a AS INT) AS y, CAST(b AS INT) AS pred FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b)),
cells AS (SELECT g.y, g.pred, count(s.y) AS n FROM grid g LEFT JOIN src s ON s.y = g.y AND s.pred = g.pred GROUP BY 1, 2)
"""


def confusion_sql(part: str) -> str:
    return CELLS + f"SELECT y, pred, n, round(coalesce(n / nullif(sum(n) OVER ({part}), 0), 0), 6) AS share FROM cells"


@query("confusion_by_truth", confusion_sql("PARTITION BY y"))
def confusion_by_truth(spark, sf):
    return rounded(metrics.confusion_matrix(scored(spark, sf)), 6)


@query("confusion_by_prediction", confusion_sql("PARTITION BY pred"))
def confusion_by_prediction(spark, sf):
    return rounded(metrics.confusion_matrix(scored(spark, sf), normalize="pred"), 6)


@query("confusion_overall", confusion_sql(""))
def confusion_overall(spark, sf):
    return rounded(metrics.confusion_matrix(scored(spark, sf), normalize="all"), 6)


PER_CLASS = f"""WITH b AS (SELECT {COUNTS} FROM ({SCORED})),
per AS (
  SELECT '0' AS label, tn AS hit, fn AS wrong, fp AS lost FROM b UNION ALL SELECT '1', tp, fp, fn FROM b),
rep AS (SELECT label, coalesce(hit / nullif(hit + wrong, 0), 0) AS p, coalesce(hit / nullif(hit + lost, 0), 0) AS r,
  coalesce(2 * hit / nullif(2 * hit + wrong + lost, 0), 0) AS f, hit + lost AS support FROM per),
avgs AS (SELECT * FROM rep UNION ALL
  SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM rep UNION ALL
  SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM rep)
"""


@query(
    "classification_report",
    PER_CLASS
    + 'SELECT label, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM avgs',
)
def classification_report(spark, sf):
    return rounded(metrics.classification_report(scored(spark, sf)), 6)


# English documents stand for the training set, the other languages for the held-out set.
SIDE = "CASE WHEN lang = 'en' THEN 'train' ELSE 'val' END"


def _by_side(df):
    side = F.when(F.col("lang") == "en", "train").otherwise("val")
    return metrics.evaluate(df.withColumn("dataset", side), by=["dataset"])


GAPS = f"""WITH {tidy(SCORED, SIDE)},
gaps AS (SELECT metric, max(value) FILTER (WHERE g = 'train') AS t, max(value) FILTER (WHERE g = 'val') AS v FROM tidy GROUP BY 1)
"""
GAP_COLUMNS = """metric, round(t, 6) AS train_score, round(v, 6) AS val_score, round(t - v, 6) AS gap,
  round(CASE WHEN t > 0 THEN (t - v) / t * 100 ELSE 0 END, 4) AS gap_percent,
  CASE WHEN abs(t - v) <= 0.10 THEN 'good' ELSE 'poor' END AS generalization_status"""


def _gaps(spark, sf):
    return metrics.generalization_gap(_by_side(scored(spark, sf)))


def _round_gaps(df):
    return rounded(rounded(df, 4, ["gap_percent"]), 6, ["train_score", "val_score", "gap"])


@query("generalization_gap", GAPS + f"SELECT {GAP_COLUMNS} FROM gaps")
def generalization_gap(spark, sf):
    return _round_gaps(_gaps(spark, sf))


@query(
    "overfitting_gate",
    GAPS
    + f"""SELECT {GAP_COLUMNS}, CASE WHEN t - v > 0.15 THEN 'FAIL' WHEN t - v > 0.10 THEN 'WARNING' ELSE 'PASS' END AS status,
    t - v <= 0.15 AS passed FROM gaps""",
)
def overfitting_gate(spark, sf):
    return _round_gaps(gates.overfitting_gate(_gaps(spark, sf)))


PERFORMANCE = """perf AS (SELECT metric, value, minimum, warning, target,
  CASE WHEN value < minimum THEN 'FAIL' WHEN value < warning THEN 'WARNING' WHEN value >= target THEN 'EXCELLENT' ELSE 'PASS' END AS status
  FROM tidy JOIN (VALUES ('f1_score', 0.70, 0.75, 0.85), ('roc_auc', 0.75, 0.80, 0.90)) t(metric, minimum, warning, target) USING (metric))
"""
LIMITS = "CAST(minimum AS DOUBLE) AS minimum, CAST(warning AS DOUBLE) AS warning, CAST(target AS DOUBLE) AS target"


@query(
    "performance_gate",
    f"WITH {tidy(SCORED)}, {PERFORMANCE} SELECT metric, round(value, 6) AS value, {LIMITS}, status, status <> 'FAIL' AS passed FROM perf",
)
def performance_gate(spark, sf):
    return rounded(gates.performance_gate(metrics.evaluate(scored(spark, sf))), 6)


@query(
    "registry_gate",
    f"WITH {tidy(SCORED)}, "
    + PERFORMANCE.replace("0.70, 0.75, 0.85", "0.70, 0.70, 1.0").replace("0.75, 0.80, 0.90", "0.75, 0.75, 1.0")
    + f"SELECT metric, round(value, 6) AS value, {LIMITS}, status, status <> 'FAIL' AS passed FROM perf",
)
def registry_gate(spark, sf):
    return rounded(gates.registry_gate(metrics.evaluate(scored(spark, sf))), 6)


BUSINESS = f"""b AS (SELECT {COUNTS} FROM ({SCORED})),
rules AS (SELECT 'recall' AS rule, coalesce(tp / nullif(tp + fn, 0), 0) AS value, 0.80 AS bound, coalesce(tp / nullif(tp + fn, 0), 0) >= 0.80 AS passed FROM b
  UNION ALL SELECT 'false_positive_rate', coalesce(fp / nullif(fp + tn, 0), 0), 0.30, coalesce(fp / nullif(fp + tn, 0), 0) <= 0.30 FROM b)
"""


@query(
    "business_gate",
    f"WITH {BUSINESS} SELECT rule, round(value, 6) AS value, CAST(bound AS DOUBLE) AS bound, passed,"
    " CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status FROM rules",
)
def business_gate(spark, sf):
    return rounded(gates.business_gate(metrics.confusion_matrix(scored(spark, sf))), 6)


@query(
    "combined_verdict",
    GAPS.rstrip()
    + f""", {BUSINESS.replace("b AS (", "bb AS (").replace("FROM b", "FROM bb")},
    p AS (SELECT value >= CASE metric WHEN 'f1_score' THEN 0.70 ELSE 0.75 END AS passed FROM ({{}}) WHERE metric IN ('f1_score', 'roc_auc')),
    checks AS (SELECT passed FROM p UNION ALL SELECT passed FROM rules
      UNION ALL SELECT t - v <= 0.15 FROM gaps WHERE metric = 'f1_score')
    SELECT count(*) AS n_checks, count(*) FILTER (WHERE NOT passed) AS n_failed, bool_and(passed) AS overall_passed FROM checks""".format(
        f"WITH {tidy(SCORED)} SELECT metric, value FROM tidy"
    ),
)
def combined_verdict(spark, sf):
    df = scored(spark, sf)
    overfit = gates.overfitting_gate(_gaps(spark, sf).where("metric = 'f1_score'"))
    return gates.combined_verdict(
        gates.performance_gate(metrics.evaluate(df)), overfit, gates.business_gate(metrics.confusion_matrix(df))
    )


TWO_MODELS = f"""
a AS (SELECT metric, value FROM (WITH {tidy(RIVAL)} SELECT metric, value FROM tidy)),
b AS (SELECT metric, value FROM (WITH {tidy(SCORED)} SELECT metric, value FROM tidy))
"""


@query(
    "production_comparison",
    f"""WITH {TWO_MODELS},
    c AS (SELECT a.value AS n, b.value AS p FROM a JOIN b USING (metric) WHERE metric = 'f1_score')
    SELECT round(p, 6) AS production_score, round(n, 6) AS new_score, round(n - p, 6) AS improvement,
      round(CASE WHEN p > 0 THEN (n - p) / p * 100 ELSE 0 END, 6) AS improvement_percent, n - p >= 0.01 AS should_replace,
      CASE WHEN n - p >= 0.01 THEN 'better_performance' ELSE 'insufficient_improvement' END AS reason FROM c""",
)
def production_comparison(spark, sf):
    new, old = metrics.evaluate(rival(spark, sf)), metrics.evaluate(scored(spark, sf))
    return rounded(gates.production_comparison(new, old), 6)


COMPARISON = f"""{TWO_MODELS},
names AS (SELECT * FROM (VALUES ('f1_score'), ('precision'), ('recall'), ('roc_auc'), ('train_val_gap'), ('training_time')) t(metric)),
cmp AS (SELECT metric, coalesce(a.value, 0) AS s, coalesce(b.value, 0) AS p FROM names LEFT JOIN a USING (metric) LEFT JOIN b USING (metric))
"""


@query(
    "compare_runs",
    f"""WITH {COMPARISON} SELECT metric, round(s, 6) AS staging, round(p, 6) AS production, round(s - p, 6) AS difference,
      round(CASE WHEN p <> 0 THEN (s - p) / p * 100 ELSE 0 END, 6) AS difference_percent,
      CASE WHEN s > p THEN 'up' WHEN s < p THEN 'down' ELSE 'same' END AS direction FROM cmp""",
)
def compare_runs(spark, sf):
    both = gates.compare_runs(metrics.evaluate(rival(spark, sf)), metrics.evaluate(scored(spark, sf)))
    return rounded(both, 6)


@query(
    "recommendation",
    f"""WITH {COMPARISON} SELECT metric, round(s - p, 6) AS difference,
      CASE WHEN s - p > 0.01 THEN 'PROMOTE' WHEN s - p > 0 THEN 'MARGINAL' ELSE 'REJECT' END AS recommendation
    FROM cmp WHERE metric = 'f1_score'""",
)
def recommendation(spark, sf):
    both = gates.compare_runs(metrics.evaluate(rival(spark, sf)), metrics.evaluate(scored(spark, sf)))
    return rounded(gates.recommendation(both), 6)


def _results(spark, sf):
    """Two models, one called tuned, as the bag union of their metric rows."""
    base = metrics.evaluate(scored(spark, sf)).select(
        F.lit("RandomForest").alias("model"), F.lit(False).alias("is_tuned"), "metric", "value"
    )
    tuned = metrics.evaluate(rival(spark, sf)).select(
        F.lit("LogisticRegression").alias("model"), F.lit(True).alias("is_tuned"), "metric", "value"
    )
    return base.unionByName(tuned)


@query(
    "leaderboard",
    f"""WITH {TWO_MODELS} SELECT 'LogisticRegression' AS model, true AS is_tuned, round(value, 6) AS score FROM a WHERE metric = 'f1_score'
    UNION ALL SELECT 'RandomForest', false, round(value, 6) FROM b WHERE metric = 'f1_score'""",
)
def leaderboard(spark, sf):
    return rounded(gates.leaderboard(_results(spark, sf)), 6)


@query(
    "balanced_score",
    f"""WITH {TWO_MODELS},
    m AS (SELECT 'LogisticRegression' AS model, 1.0 AS place, max(value) FILTER (WHERE metric = 'f1_score') AS score,
            max(value) FILTER (WHERE metric = 'log_loss') AS training_time, max(value) FILTER (WHERE metric = 'brier_score') AS gap FROM a
          UNION ALL SELECT 'RandomForest', 0.75, max(value) FILTER (WHERE metric = 'f1_score'),
            max(value) FILTER (WHERE metric = 'log_loss'), max(value) FILTER (WHERE metric = 'brier_score') FROM b)
    SELECT model, round(score, 6) AS score, round(training_time, 6) AS training_time, round(gap, 6) AS gap,
      round(0.5 * score + 0.15 * greatest(0, 1 - training_time / 300) + 0.15 * place + 0.20 * greatest(0, 1 - gap / 0.10), 6) AS balanced_score
    FROM m""",
)
def balanced_score(spark, sf):
    # log loss and Brier score stand in for the time and the gap of a training run
    wide = _results(spark, sf).groupBy("model").pivot("metric", ["f1_score", "log_loss", "brier_score"]).max("value")
    rows = wide.select(
        "model",
        F.col("f1_score").alias("score"),
        F.col("log_loss").alias("training_time"),
        F.col("brier_score").alias("gap"),
    )
    return rounded(gates.balanced_score(rows), 6)


# ---- curves ---------------------------------------------------------------------------------

RUN = f"""WITH src AS ({SCORED}), c AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM src GROUP BY 1),
run AS (SELECT p, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM c
        WINDOW w AS (ORDER BY p DESC))
"""


@query(
    "roc_points",
    RUN
    + """SELECT round(p, 6) AS threshold, round(fps / nn, 6) AS fpr, round(tps / np, 6) AS tpr FROM run
    UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0""",
)
def roc_points(spark, sf):
    return rounded(plotdata.roc_points(scored(spark, sf)), 6)


@query(
    "precision_recall_points",
    RUN
    + """SELECT round(p, 6) AS threshold, round(tps / (tps + fps), 6) AS "precision", round(tps / np, 6) AS recall FROM run
    UNION ALL SELECT CAST('inf' AS DOUBLE), 1, 0""",
)
def precision_recall_points(spark, sf):
    return rounded(plotdata.precision_recall_points(scored(spark, sf)), 6)


@query(
    "calibration_curve",
    f"""WITH src AS ({SCORED}), b AS (SELECT *, (SELECT count(*) FROM generate_series(1, 9) t(i) WHERE p > i / 10) AS bin FROM src)
    SELECT CAST(bin AS INT) AS bin, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(y), 6) AS positive_share
    FROM b GROUP BY 1""",
)
def calibration_curve(spark, sf):
    return rounded(plotdata.calibration_curve(scored(spark, sf)), 6)


@query(
    "cv_median",
    f"""WITH s AS (SELECT *, doc_id % 5 AS fold FROM ({SCORED})),
    f AS (SELECT fold, coalesce(2.0 * count(*) FILTER (y = 1 AND pred = 1) / nullif(count(*) FILTER (y = 1 OR pred = 1) + count(*) FILTER (y = 1 AND pred = 1), 0), 0) AS f1 FROM s GROUP BY 1)
    SELECT 'text_length' AS model, count(*) AS n_folds, round(median(f1), 6) AS cv_median, round(stddev_pop(f1), 6) AS cv_std,
      round(min(f1), 6) AS cv_min, round(max(f1), 6) AS cv_max FROM f""",
)
def cv_median(spark, sf):
    folded = scored(spark, sf).withColumn("fold", F.col("doc_id") % 5)
    scores = metrics.threshold_metrics(folded, by=["fold"]).select(F.lit("text_length").alias("model"), "fold", "f1_score")
    return rounded(models.cv_summary(scores, "median"), 6)
