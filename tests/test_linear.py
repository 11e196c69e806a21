import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tallystone.operators import linear, models
from tallystone.session import materialize


@pytest.fixture(scope="module")
def folded(spark):
    """Three columns of unlike size, one of them a multiple of another, and unlike weights."""
    h = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000.0
    rows = spark.range(1200).select("id", h(1).alias("a"), (h(2) * 5).alias("b"), h(3).alias("noise"))
    rows = rows.withColumn("y", ((F.col("a") + F.col("b") / 10 + h(4)) > 1.1).cast("int")).withColumn("twice", F.col("a") * 2)
    rows = models.assemble(rows, ["a", "b", "twice", "noise"], "y", keep=["id"])
    return materialize(rows.coalesce(1).withColumn("fold", F.pmod("id", F.lit(3)).cast("int")))


def test_fits_together_are_sparks_fits_alone(folded):
    fits = [linear.Fit(f, ridge, lasso) for f in range(3) for ridge, lasso in ((1e-4, 0.0), (0.3, 0.0), (0.0, 1e-3), (0.0, 0.05))]
    rows = linear.rows_of(folded, "fold", models.LABEL, models.WEIGHT, models.FEATURES)
    beta = linear.fit_together(rows, fits)
    f1 = linear.held_out_f1(rows, fits, beta)
    for fit, mine, scored in list(zip(fits, beta, f1))[3:8]:  # all penalties
        total = fit.ridge + fit.lasso
        alone = LogisticRegression(weightCol=models.WEIGHT, regParam=total, elasticNetParam=fit.lasso / total, tol=1e-9, maxIter=200, standardization=False)
        model = alone.fit(folded.where(F.col("fold") != fit.held))
        theirs = np.append(model.coefficients.toArray(), model.intercept)
        n, loss = linear._sums(rows, [fit] * 2, np.array([mine, theirs]))[:, :2].T
        cost = lambda b: fit.ridge / 2 * (b[:-1] ** 2).sum() + fit.lasso * np.abs(b[:-1]).sum()
        assert loss[0] / n[0] + cost(mine) <= loss[1] / n[1] + cost(theirs) + 1e-8
        assert mine[[1, 3]] == pytest.approx(theirs[[1, 3]], abs=2e-3)
        held = models.score(model, folded.where(F.col("fold") == fit.held)).select("y", "pred").collect()
        tp, wrong = sum(r["y"] * r["pred"] for r in held), sum(r["y"] != r["pred"] for r in held)
        assert scored == pytest.approx(2 * tp / (2 * tp + wrong), abs=0.01)


def test_one_class_and_no_spread(spark):
    rows = spark.createDataFrame([(i % 2, 1.0, 1.0, [3.0, float(i)]) for i in range(20)], "fold int, y double, w double, x array<double>")
    fits = [linear.Fit(0, 0.1, 0.0), linear.Fit(1, 0.0, 0.1)]
    beta = linear.fit_together(rows, fits)
    assert np.isfinite(beta).all() and linear.held_out_f1(rows, fits, beta) == [1.0, 1.0]


def test_jobs_of_a_search_do_not_grow_with_its_trials(spark, folded):
    def jobs(trials):
        group = f"search-{trials}"
        spark.sparkContext.setJobGroup(group, group)
        found = models.random_search("LogisticRegression", folded, trials=trials)[1]
        assert found.count() == trials
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(16) <= 1.5 * jobs(4)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
