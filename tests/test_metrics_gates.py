import math

import numpy as np
import pytest
from row_helpers import by

from tallystone.operators import gates, metrics, plotdata

# counts: TP 79, FP 16, FN 6, TN 22
COUNTS = {(1, 1): 79, (0, 1): 16, (1, 0): 6, (0, 0): 22}


@pytest.fixture
def worked(frame):
    rows = [(y, 0.9 if pred else 0.1, pred) for (y, pred), n in COUNTS.items() for _ in range(n)]
    return frame(rows, "y int, p double, pred int")


def test_worked_confusion_example(worked):
    r = metrics.threshold_metrics(worked).first()
    assert [round(r[m], 4) for m in ("accuracy", "precision", "recall", "f1_score")] == [0.8211, 0.8316, 0.9294, 0.8778]
    b = by(gates.business_gate(metrics.confusion_matrix(worked)), "rule")
    assert b["recall"]["passed"] and not b["false_positive_rate"]["passed"]
    assert round(b["false_positive_rate"]["value"], 4) == 0.4211


@pytest.mark.parametrize("normalize", ["true", "pred", "all", None])
def test_confusion_cells_add_up(worked, normalize):
    cells = metrics.confusion_matrix(worked, normalize=normalize).collect()
    assert sum(r["n"] for r in cells) == 123
    assert sum(r["share"] for r in cells) == pytest.approx({"true": 2, "pred": 2, "all": 1, None: 123}[normalize])
    with pytest.raises(ValueError):
        metrics.confusion_matrix(worked, normalize="magic")


def test_single_class_predictions_give_zero_not_an_error(frame):
    df = frame([(1, 0.2, 0), (0, 0.1, 0)], "y int, p double, pred int")
    r = metrics.threshold_metrics(df).first()
    assert (r["precision"], r["recall"], r["f1_score"]) == (0.0, 0.0, 0.0)
    report = by(metrics.classification_report(df), "label")
    assert report["1"]["precision"] == 0.0 and report["0"]["recall"] == 1.0


def test_single_class_truth_has_no_auc(frame):
    r = metrics.ranking_metrics(frame([(1, 0.2), (1, 0.3)], "y int, p double")).first()
    assert r["roc_auc"] is None and r["average_precision"] == 1.0


def test_ranking_metrics_by_definition(spark):
    df = spark.range(600).selectExpr(
        "CAST(id % 4 = 0 OR id % 7 = 0 AS INT) AS y", "CASE WHEN id % 3 = 0 THEN 0.5D ELSE id * 13 % 37 / 37.0D END AS p"
    )
    pdf = df.toPandas()
    pos, neg = pdf.p[pdf.y == 1].to_numpy(), pdf.p[pdf.y == 0].to_numpy()
    auc = np.mean([(a > neg).mean() + (a == neg).mean() / 2 for a in pos])
    ap, last = 0.0, 0.0
    for t in sorted(pdf.p.unique(), reverse=True):
        chosen = pdf[pdf.p >= t]
        recall = chosen.y.sum() / len(pos)
        ap += (recall - last) * chosen.y.mean()
        last = recall
    r = metrics.ranking_metrics(df).first()
    assert r["roc_auc"] == pytest.approx(auc) and r["average_precision"] == pytest.approx(ap)


def test_log_loss_clips_certain_mistakes(frame):
    df = frame([(1, 0.0, 0), (0, 0.0, 0)], "y int, p double, pred int")
    loss = metrics.threshold_metrics(df).first()["log_loss"]
    assert loss == pytest.approx(-math.log(metrics.CLIP) / 2, rel=1e-6)


def test_curves_start_and_end_where_they_should(worked):
    roc = by(plotdata.roc_points(worked), "threshold")
    assert roc[math.inf]["tpr"] == 0.0 and roc[0.1]["fpr"] == 1.0
    pr = by(plotdata.precision_recall_points(worked), "threshold")
    assert pr[math.inf]["precision"] == 1.0 and pr[0.1]["recall"] == 1.0


def test_calibration_bins_close_on_the_right(frame):
    df = frame([(0, 0.0), (1, 0.1), (1, 0.10001), (1, 1.0)], "y int, p double")
    assert {r["bin"]: r["n"] for r in plotdata.calibration_curve(df).collect()} == {0: 2, 1: 1, 9: 1}


def rows(frame, **values):
    return frame([(k, float(v)) for k, v in values.items()], "metric string, value double")


@pytest.mark.parametrize("value,status", [(0.699, "FAIL"), (0.70, "WARNING"), (0.75, "PASS"), (0.85, "EXCELLENT")])
def test_performance_ladder(frame, value, status):
    r = gates.performance_gate(rows(frame, f1_score=value, recall=0.1)).collect()
    assert len(r) == 1 and r[0]["status"] == status and r[0]["passed"] == (status != "FAIL")


@pytest.mark.parametrize("gap,status", [(0.05, "PASS"), (0.12, "WARNING"), (0.2, "FAIL"), (-0.3, "PASS")])
def test_overfitting_ladder(frame, gap, status):
    tidy = frame([("f1_score", "train", 0.5 + gap), ("f1_score", "val", 0.5)], "metric string, dataset string, value double")
    gaps = metrics.generalization_gap(tidy)
    assert gates.overfitting_gate(gaps).first()["status"] == status
    assert gaps.first()["generalization_status"] == ("good" if abs(gap) <= 0.10 else "poor")


@pytest.mark.parametrize(
    "new,old,replace,reason",
    [
        (0.8, None, True, "no_production_model"),
        (0.8, 0.7, True, "better_performance"),
        (0.8, 0.795, False, "insufficient_improvement"),
    ],
)
def test_incumbent(frame, new, old, replace, reason):
    other = rows(frame, f1_score=old) if old is not None else None
    r = gates.production_comparison(rows(frame, f1_score=new), other).first()
    assert (r["should_replace"], r["reason"]) == (replace, reason)
    empty = gates.production_comparison(rows(frame, f1_score=new), rows(frame, f1_score=new).limit(0)).first()
    assert empty["reason"] == "no_production_model"


@pytest.mark.parametrize("gain,verdict", [(0.05, "PROMOTE"), (0.005, "MARGINAL"), (-0.1, "REJECT")])
def test_recommendation(frame, gain, verdict):
    both = gates.compare_runs(rows(frame, f1_score=0.7 + gain, recall=0.5), rows(frame, f1_score=0.7))
    assert gates.recommendation(both).first()["recommendation"] == verdict
    r = by(both, "metric")
    assert len(r) == 6 and r["recall"]["production"] == 0.0 and r["recall"]["difference_percent"] == 0.0


def test_verdict_needs_every_check(frame):
    ok, bad = frame([(True,)], "passed boolean"), frame([(False,)], "passed boolean")
    assert gates.combined_verdict(ok, ok).first()["overall_passed"]
    r = gates.combined_verdict(ok, bad).first()
    assert not r["overall_passed"] and (r["n_checks"], r["n_failed"]) == (2, 1)


def test_leaderboard_breaks_ties_by_name(frame):
    df = frame(
        [("b", False, "f1_score", 0.5), ("a", False, "f1_score", 0.5), ("c", True, "f1_score", 0.9), ("c", True, "recall", 1.0)],
        "model string, is_tuned boolean, metric string, value double",
    )
    assert [r["model"] for r in gates.leaderboard(df).collect()] == ["c", "a", "b"]
    assert gates.leaderboard(df, n=1).count() == 1


def test_density_integrates_to_one_and_histogram_keeps_every_row(spark):
    df = spark.range(5000).selectExpr("sin(id) * 3 + id % 5 AS x", "5.0D AS same")
    d = plotdata.density(df, ["x", "same"]).orderBy("x").collect()
    area = np.trapezoid([r["density"] for r in d], [r["x"] for r in d])
    assert len(d) == 200 and 0.9 < area < 1.0
    h = plotdata.histogram(df, ["x", "same"]).groupBy("column").sum("n").collect()
    assert {r[0]: r[1] for r in h} == {"x": 5000, "same": 5000}
