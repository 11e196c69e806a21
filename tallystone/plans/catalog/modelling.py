"""Model training, scoring, the flows and the streaming forms."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tallystone.operators import metrics, models, plotdata
from tallystone.operators.split import stratified_folds
from tallystone.plans.analysis import AnalysisSettings, analyze
from tallystone.plans.catalog.preparation import ALL_FEATURES
from tallystone.plans.catalog.registry import LOAN, loan, query, rounded, table
from tallystone.plans.prepare import FittedPreparation, fit_preparation, loan_settings, prepare
from tallystone.plans.training import PRIMARY, TrainingSettings, run_training
from tallystone.session import materialize, scratch_path
from tallystone.sources.tables import (
    LOAN_SCHEMA,
    append_run_metadata,
    load_run_metadata,
    load_split,
    publish_run,
    read_published,
    read_table,
    save_split,
    training_metadata,
    write_table,
)
from tallystone.streaming.score import prepare_stream, read_stream, score_stream, write_stream

KEY, TARGET = "Customer_ID", "Loan_Status"
LOAN_TRAINING = TrainingSettings(KEY, TARGET)


def _prepared(spark, sf):
    """Train and test rows of the prepared loans, with their key. The shift step is a query of its own."""
    ready, _ = prepare(loan(spark, sf), replace(loan_settings(), keep_key=True), check_shift=False)
    return tuple(ready.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def _ready(spark, sf):
    """Prepared loans with their key, as ``(train, test, feature names)`` of assembled rows.

    Class weights of train come from train alone.
    """
    parts = _prepared(spark, sf)
    names = [c for c in parts[0].columns if c not in (KEY, TARGET)]
    train, test = (models.sized(models.assemble(part, names, TARGET, keep=[KEY]), KEY) for part in parts)
    return train, test, names


def _trained_metrics(spark, sf, name, params=None):
    train, test, names = _ready(spark, sf)
    trained = models.train(name, train, params, features=names)
    rows = metrics.evaluate(models.score(trained.model, test))
    return rows.select(F.lit(name).alias("model"), "metric", "value")


@query("train_logistic_regression")
def train_logistic_regression(spark, sf):
    return _trained_metrics(spark, sf, "LogisticRegression")


@query("train_random_forest")
def train_random_forest(spark, sf):
    return _trained_metrics(spark, sf, "RandomForest")


@query("train_boosted_trees")
def train_boosted_trees(spark, sf):
    return _trained_metrics(spark, sf, "XGBoost")


@query("train_boosted_trees_second_preset")
def train_boosted_trees_second_preset(spark, sf):
    return _trained_metrics(spark, sf, "LightGBM")


@query("cross_validation")
def cross_validation(spark, sf):
    train, _, _ = _ready(spark, sf)
    folded = materialize(stratified_folds(train, KEY, models.LABEL, 10), "folds")
    return models.cross_validate("LogisticRegression", folded)


@query("cross_validation_summary")
def cross_validation_summary(spark, sf):
    return models.cv_summary(cross_validation(spark, sf))


@query("random_search")
def random_search(spark, sf):
    train, _, _ = _ready(spark, sf)
    folded = materialize(stratified_folds(train, KEY, models.LABEL, 5), "folds")
    _, trials = models.random_search("RandomForest", folded)
    return trials


@query("search_logistic_regression")
def search_logistic_regression(spark, sf):
    train, _, _ = _ready(spark, sf)
    folded = materialize(stratified_folds(train, KEY, models.LABEL, 5), "folds")
    _, trials = models.random_search("LogisticRegression", folded)
    return trials


def _run_rows(result):
    """Leaderboard, gates and verdict of a training run as ``(step, model, is_tuned, fact, value, passed)``."""
    model, tuned = F.lit(result.best.name).alias("model"), F.lit(result.best.is_tuned).alias("is_tuned")
    row = lambda df, step, fact, value, passed="passed": df.select(
        F.lit(step).alias("step"), model, tuned, fact.alias("fact"), value.cast("double").alias("value"), F.col(passed).alias("passed")
    )
    out = result.board.select(F.lit("board").alias("step"), "model", "is_tuned", F.lit(PRIMARY).alias("fact"), F.col("score").alias("value"), F.lit(None).cast("boolean").alias("passed"))
    out = out.unionByName(row(result.checks["performance"], "performance", F.col("metric"), F.col("value")))
    out = out.unionByName(row(result.checks["overfitting"], "overfitting", F.col("metric"), F.col("gap")))
    out = out.unionByName(row(result.checks["business"], "business", F.col("rule"), F.col("value")))
    return out.unionByName(row(result.verdict, "verdict", F.lit("n_failed"), F.col("n_failed"), "overall_passed"))


@query("training_run")
def training_run(spark, sf):
    """The linear model from baseline to gates: ten folds, 50 trials of five folds, the tuned model with its ten folds."""
    return _run_rows(run_training(*_prepared(spark, sf), replace(LOAN_TRAINING, models={"LogisticRegression": {}}, tune_top=1)))


@query("training_run_baselines")
def training_run_baselines(spark, sf):
    """The linear model and the forest as they start, each with ten folds. The boosted presets have queries of their own."""
    starting = {name: {} for name in ("LogisticRegression", "RandomForest")}
    return _run_rows(run_training(*_prepared(spark, sf), replace(LOAN_TRAINING, models=starting, tune_top=0)))


@query("native_importance")
def native_importance(spark, sf):
    train, _, names = _ready(spark, sf)
    trained = models.train("RandomForest", train, features=names)
    return plotdata.importance_bars(models.native_importance(trained))


@query("permutation_importance")
def permutation_importance(spark, sf):
    train, test, names = _ready(spark, sf)
    trained = models.train("LogisticRegression", train, features=names)
    return models.permutation_importance(trained.model, test, KEY, names, repeats=10)


@query("batch_scoring")
def batch_scoring(spark, sf):
    train, test, _ = _ready(spark, sf)
    trained = models.train("LogisticRegression", train)
    return models.score(trained.model, test, keep=[KEY])


# ---- flows ----------------------------------------------------------------------------------

LOAN_ANALYSIS = AnalysisSettings(TARGET, "Y", "N", KEY, plots=False)


@query("analysis_report")
def analysis_report(spark, sf):
    df = materialize(loan(spark, sf), "loan")
    return analyze(df, LOAN_ANALYSIS)["summary"]


@query("preparation_shift")
def preparation_shift(spark, sf):
    return prepare(loan(spark, sf), loan_settings())[1].shift


# ---- sources --------------------------------------------------------------------------------


@query("csv_round_trip", LOAN)
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    write_table(loan(spark, sf), path, "csv")
    return read_table(spark, path, "csv", LOAN_SCHEMA, categorical=["Gender", TARGET])


@query(
    "training_metadata",
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS split,
      o_orderstatus AS class, count(*) AS n, CAST(2 AS BIGINT) AS n_features FROM orders GROUP BY 1, 2""",
)
def metadata(spark, sf):
    path = scratch_path(spark, "split")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_custkey", "o_totalprice", "o_orderstatus", F.when(early, "train").otherwise("test").alias("split")
    )
    save_split(orders, path)
    return training_metadata(*load_split(spark, path, "o_orderstatus"), "o_orderstatus")


@query(
    "run_metadata",
    """SELECT 'r1' AS run_id, 'rows' AS fact, CAST(count(*) AS VARCHAR) AS value FROM orders
    UNION ALL SELECT 'r1', 'status', string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) FROM orders
    UNION ALL SELECT 'r2', 'rows', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'""",
)
def run_metadata(spark, sf):
    """Two runs, the first of them tried again: its facts stand once."""
    path = scratch_path(spark, "metadata")
    orders = table(spark, sf, "orders")
    status = ",".join(r[0] for r in orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect())
    append_run_metadata(spark, path, "r1", {"rows": "unfinished"})
    append_run_metadata(spark, path, "r1", {"rows": orders.count(), "status": status})
    append_run_metadata(spark, path, "r2", {"rows": orders.where("o_orderstatus = 'F'").count()})
    return load_run_metadata(spark, path).select("run_id", "fact", "value")


@query(
    "analysis_results",
    f"""WITH loan AS ({LOAN})
    SELECT '2024-01-01' AS run_id, Loan_Status AS class, count(*) AS n FROM loan GROUP BY 2
    UNION ALL SELECT 'r2', Loan_Status, count(*) FROM loan WHERE Gender = 'Male' GROUP BY 2""",
)
def analysis_results(spark, sf):
    """Published, published again in place of the first attempt, and read back beside another run."""
    path = scratch_path(spark, "results")
    df = materialize(loan(spark, sf), "loan")
    counts = lambda rows: {"classes": rows.groupBy(F.col(TARGET).alias("class")).agg(F.count("*").alias("n")), "sizes": rows.agg(F.count("*").alias("n"))}
    publish_run(counts(df.where("Gender = 'Female'")), path, "2024-01-01")
    publish_run(counts(df), path, "2024-01-01", replace=True)
    publish_run(counts(df.where("Gender = 'Male'")), path, "r2")
    return read_published(spark, path, "classes").select("run_id", "class", "n")


# ---- streams --------------------------------------------------------------------------------


def _fitted(spark, sf):
    """Parameters learned from the whole loan table, written and read back."""
    settings = replace(loan_settings(), keep_key=True)
    path = scratch_path(spark, "params")
    fit_preparation(loan(spark, sf), settings).save(path)
    return FittedPreparation.load(spark, path, settings)


def _loan_folder(spark, sf):
    path = scratch_path(spark, "arrivals")
    loan(spark, sf).write.parquet(path)
    return path


STREAMED = ["Applicant_Income", "Loan_Amount"]
PREPARED = f"""WITH loan AS ({LOAN}),
    s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in STREAMED)} FROM loan)
    SELECT Customer_ID, {", ".join(f"round(({c} - m_{c}) / s_{c}, 4) + 0.0 AS {c}" for c in STREAMED)},
      {ALL_FEATURES["Income_Ratio"]} AS Income_Ratio, CAST(Property_Area = 'Urban' AS INT) AS Property_Area_Urban,
      CASE Loan_Status WHEN 'Y' THEN 1 ELSE 0 END AS Loan_Status
    FROM loan, s"""


@query("prepared_from_folder", PREPARED)
def prepared_from_folder(spark, sf):
    """Everything that a fitted preparation needs lies in its folder."""
    path = scratch_path(spark, "fitted")
    fit_preparation(loan(spark, sf), replace(loan_settings(), keep_key=True)).save(path)
    ready = FittedPreparation.load(spark, path).apply(loan(spark, sf))
    return rounded(ready.select(KEY, *STREAMED, "Income_Ratio", "Property_Area_Urban", TARGET), 4, STREAMED)


@query("stream_preparation", PREPARED)
def stream_preparation(spark, sf):
    fitted = _fitted(spark, sf)
    stream = read_stream(spark, _loan_folder(spark, sf), LOAN_SCHEMA)
    out = scratch_path(spark, "prepared")
    write_stream(prepare_stream(stream, fitted), out).awaitTermination()
    picked = spark.read.parquet(out).select(KEY, *STREAMED, "Income_Ratio", "Property_Area_Urban", TARGET)
    return rounded(picked, 4, STREAMED)


@query("stream_scoring")
def stream_scoring(spark, sf):
    fitted = _fitted(spark, sf)
    ready = fitted.apply(loan(spark, sf))
    names = [c for c in ready.columns if c not in (KEY, TARGET)]
    trained = models.train("LogisticRegression", models.assemble(ready, names, TARGET), features=names)
    scorer = models.scoring_pipeline(names, trained.model)
    stream = prepare_stream(read_stream(spark, _loan_folder(spark, sf), LOAN_SCHEMA), fitted)
    out = scratch_path(spark, "scored")
    scores = score_stream(stream, scorer).select(KEY, models.probability("probability").alias("p"), "prediction")
    write_stream(scores, out).awaitTermination()
    return spark.read.parquet(out)
