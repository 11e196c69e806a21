"""Binary classifiers: factory, cross-validation, search, importance, scoring."""

from __future__ import annotations

import random
import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from math import exp, inf, log, log2
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tallystone.functions.columns import number, ref
from tallystone.operators import linear
from tallystone.operators.metrics import threshold_metrics
from tallystone.operators.split import with_class_weight
from tallystone.session import materialize, scratch_path
from tallystone.sources.tables import read_or_empty

DEEPEST = 30  # of Spark's trees
#: Rows that a part of a training table should hold while there are no more parts than cores: iterative fits run one job a step, small
#: parts only add to its cost. Beyond that each core gets the same number of parts, of at most so many rows.
ROWS_PER_PART, MOST_ROWS = 50_000, 250_000

#: Fits of the linear model that share their passes over the rows.
JOINT = 256

FEATURES, WEIGHT, LABEL = "features", "weight", "label"
SEED = 42

# fixed values: the parameters each model starts from
DEFAULTS: dict[str, dict] = {
    "LogisticRegression": {"C": 1.0, "penalty": "l2", "max_iter": 1000, "tol": 1e-4},
    "RandomForest": {"n_estimators": 100},
    "XGBoost": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6},
    "LightGBM": {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31, "min_child_samples": 20},
}

# fixed values: search spaces as (kind, low, high) or (kind, choices)
SEARCH_SPACES: dict[str, dict[str, tuple]] = {
    "LogisticRegression": {
        "C": ("log_uniform", 0.001, 100),
        "penalty": ("categorical", ["l1", "l2"]),
        "solver": ("categorical", ["liblinear", "saga"]),
    },
    "RandomForest": {
        "n_estimators": ("int", 50, 500),
        "max_depth": ("int", 3, 30),
        "min_samples_split": ("int", 2, 20),
        "min_samples_leaf": ("int", 1, 10),
        "max_features": ("categorical", ["sqrt", "log2"]),
    },
    "XGBoost": {
        "n_estimators": ("int", 50, 500),
        "max_depth": ("int", 3, 15),
        "learning_rate": ("log_uniform", 0.001, 0.3),
        "subsample": ("uniform", 0.6, 1.0),
        "colsample_bytree": ("uniform", 0.6, 1.0),
        "gamma": ("uniform", 0, 5),
        "min_child_weight": ("int", 1, 10),
    },
    "LightGBM": {
        "n_estimators": ("int", 50, 500),
        "max_depth": ("int", 3, 15),
        "learning_rate": ("log_uniform", 0.001, 0.3),
        "num_leaves": ("int", 20, 150),
        "min_child_samples": ("int", 5, 100),
        "subsample": ("uniform", 0.6, 1.0),
        "colsample_bytree": ("uniform", 0.6, 1.0),
    },
}

# how the parameter names above read in Spark ML
_TREE_NAMES = {
    "max_depth": "maxDepth",
    "max_features": "featureSubsetStrategy",
    "min_samples_leaf": "minInstancesPerNode",
    "min_child_weight": "minInstancesPerNode",
    "min_child_samples": "minInstancesPerNode",
    "subsample": "subsamplingRate",
    "learning_rate": "stepSize",
    "gamma": "minInfoGain",
    "colsample_bytree": "featureSubsetStrategy",
}


def make_estimator(name: str, params: Mapping | None = None, rows: int = 1, seed: int = SEED) -> Estimator:
    """A Spark estimator for a model name; ``rows`` turns C into a per-row penalty.

    Three parameters have no exact counterpart. ``solver`` changes nothing: Spark has one for each penalty. ``num_leaves`` bounds the
    depth so that no tree can have more leaves. ``min_samples_split`` asks for half as many rows in both children, so that no
    node with fewer rows is split (and some with more are not either).
    """
    if name not in DEFAULTS:
        raise ValueError(f"unknown model: {name}; known: {sorted(DEFAULTS)}")
    p = {**DEFAULTS[name], **(params or {})}
    shared = {"featuresCol": FEATURES, "labelCol": LABEL, "weightCol": WEIGHT}
    if name == "LogisticRegression":
        return LogisticRegression(
            **shared,
            regParam=1.0 / (p["C"] * rows),
            elasticNetParam=1.0 if p["penalty"] == "l1" else 0.0,
            maxIter=p["max_iter"],
            tol=p["tol"],
            standardization=False,
        )
    rounds = p.pop("n_estimators")
    if "num_leaves" in p:
        p["max_depth"] = min(p.get("max_depth", DEEPEST), int(log2(p.pop("num_leaves"))))
    if "min_samples_split" in p:
        p["min_samples_leaf"] = max(p.get("min_samples_leaf", 1), -(-p.pop("min_samples_split") // 2))
    spark_params = {}
    for key, value in p.items():
        if key not in _TREE_NAMES:
            raise ValueError(f"unknown parameter of {name}: {key}")
        spark_params[_TREE_NAMES[key]] = str(value) if key == "colsample_bytree" else value
    if name == "RandomForest":
        return RandomForestClassifier(**shared, numTrees=rounds, seed=seed, **spark_params)
    return GBTClassifier(**shared, maxIter=rounds, seed=seed, **spark_params)


def assemble(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep…, label, weight, features)``: one vector per row and the balanced class weight."""
    base = df.select(
        *[ref(k) for k in keep],
        ref(label).cast("double").alias(LABEL),
        *[number(df, c).alias(c) for c in features],
    )
    vector = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")
    ready = with_class_weight(base, LABEL, WEIGHT)
    return vector.transform(ready).select(*[ref(k) for k in keep], LABEL, WEIGHT, FEATURES)


def sized(data: DataFrame, key: str, rows_per_part: int = ROWS_PER_PART, most_rows: int = MOST_ROWS) -> DataFrame:
    """The table written in parts of even size, in key order within each, so that a fit sees the same rows in the same order again.

    A step of a fit takes as long as its busiest core. So parts beyond one for each core come in equal numbers for all.
    """
    n, cores = data.count(), data.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n // rows_per_part))
    if parts > cores:
        parts = cores * -(-n // (cores * most_rows))
    return materialize(data.repartition(parts, ref(key)).sortWithinPartitions(ref(key)), "sized")


@contextmanager
def part_by_part(spark: SparkSession) -> Iterator[None]:
    """Inside, a task reads one written part. Otherwise Spark packs as many as it takes for 128 MB, which leaves few tasks of uneven
    number for the cores, and what a fit keeps of a task's rows (100 counts a row in a forest) is several times as large."""
    name = "spark.sql.files.openCostInBytes"
    before, most = spark.conf.get(name), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class Trained:
    name: str
    params: dict
    model: Model
    seconds: float
    is_tuned: bool = False
    features: list[str] = field(default_factory=list)


def train(
    name: str,
    data: DataFrame,
    params: Mapping | None = None,
    is_tuned: bool = False,
    features: Sequence[str] = (),
    seed: int = SEED,
) -> Trained:
    """Fit one model on assembled rows and time it."""
    start = time.monotonic()
    with part_by_part(data.sparkSession):
        model = make_estimator(name, params, data.count(), seed).fit(data)
    return Trained(name, dict(params or {}), model, time.monotonic() - start, is_tuned, list(features))


def probability(column: str = "probability") -> Column:
    """The probability of the positive class, out of a model's probability vector."""
    return vector_to_array(column)[1]


def score(model: Model, data: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scored rows ``(keep…, y, p, pred)``; works on batch and streaming tables alike."""
    return model.transform(data).select(
        *[ref(k) for k in keep],
        F.col(LABEL).cast("int").alias("y"),
        probability().alias("p"),
        F.col("prediction").cast("int").alias("pred"),
    )


def _joint_scores(data: DataFrame, fold: str, held: Sequence, estimators: Sequence[LogisticRegression]) -> list[float]:
    """F1 on the fold that each linear fit leaves out; the fits share their passes over the rows."""
    rows = linear.rows_of(data, fold, LABEL, WEIGHT, FEATURES)
    fits = []
    for out, e in zip(held, estimators):
        penalty, share = e.getRegParam(), e.getElasticNetParam()
        fits.append(linear.Fit(out, penalty * (1.0 - share), penalty * share, e.getMaxIter(), e.getTol()))
    return linear.held_out_f1(rows, fits, linear.fit_together(rows, fits))


def cross_validate(
    name: str,
    data: DataFrame,
    fold: str = "fold",
    params: Mapping | None = None,
    seed: int = SEED,
    parallelism: int = 4,
) -> DataFrame:
    """``(model, fold, f1_score)``: fit on all other folds, score on this one.

    ``parallelism`` folds are fitted at a time; the held-out rows of all folds are
    evaluated in one aggregate at the end. Linear models are fitted together, each step of all folds in one pass.
    """
    sizes = {r[0]: r[1] for r in data.groupBy(fold).count().orderBy(fold).collect()}
    if name == "LogisticRegression":
        made = [make_estimator(name, params, sum(sizes.values()) - n, seed) for n in sizes.values()]
        scores = _joint_scores(data, fold, list(sizes), made)
        found = data.sparkSession.createDataFrame(list(zip(sizes, scores)), f"_fold {data.schema[fold].dataType.simpleString()}, f1_score double")
        return found.select(F.lit(name).alias("model"), F.col("_fold").alias(fold), "f1_score")

    def held_out(f: int) -> DataFrame:
        inside = data.where(F.col(fold) != f)
        model = make_estimator(name, params, sum(sizes.values()) - sizes[f], seed).fit(inside)
        return score(model, data.where(F.col(fold) == f), keep=[fold])

    with part_by_part(data.sparkSession), ThreadPool(min(parallelism, len(sizes))) as pool:
        parts = pool.map(inheritable_thread_target(data.sparkSession)(held_out), list(sizes))
    return threshold_metrics(reduce(DataFrame.unionByName, parts), by=[fold]).select(F.lit(name).alias("model"), fold, "f1_score")


def cv_summary(scores: DataFrame, aggregate: str = "mean") -> DataFrame:
    """Mean (or median), population std, min and max over the folds, one row per model."""
    center = {"mean": F.avg, "median": F.median}[aggregate]("f1_score")
    return scores.groupBy("model").agg(
        F.count("*").alias("n_folds"),
        center.alias(f"cv_{aggregate}"),
        F.stddev_pop("f1_score").alias("cv_std"),
        F.min("f1_score").alias("cv_min"),
        F.max("f1_score").alias("cv_max"),
    )


def draw(space: Mapping[str, tuple], rng: random.Random) -> dict:
    """One random point of a search space; kinds: int, uniform, log_uniform, categorical."""
    point = {}
    for name, (kind, *args) in space.items():
        if kind == "int":
            point[name] = rng.randint(*args)
        elif kind == "uniform":
            point[name] = rng.uniform(*args)
        elif kind == "log_uniform":
            point[name] = exp(rng.uniform(log(args[0]), log(args[1])))
        elif kind == "categorical":
            point[name] = rng.choice(args[0])
        else:
            raise ValueError(f"unknown search-space kind: {kind}")
    return point


TRIALS_SCHEMA = "model string, params string, score double, seconds double, trial int, fold int"


def random_search(
    name: str,
    data: DataFrame,
    fold: str = "fold",
    trials: int = 50,
    space: Mapping[str, tuple] | None = None,
    parallelism: int = 8,
    seed: int = SEED,
    path: str | None = None,
    timeout: float | None = None,
) -> tuple[dict, DataFrame]:
    """Best parameters by mean F1 over the folds, and every trial with its score.

    Parameters outside the space keep their defaults, also in the returned set. Each (trial, fold) is written to ``path`` as soon as it
    ends. A search that is started again with the same path and seed fits only what is missing, so one that broke off goes on; trials
    depend on the seed alone, and more trials may be asked for later. All are fitted, however long it takes. With a ``timeout`` no
    further fit starts after so many seconds, and it is an error if one is then missing: the best is never chosen among a part of the
    trials. What had ended stands in ``path``. Linear models are fitted and written ``JOINT`` at a time, each step of all of them in
    one pass over the rows; with ``parallelism`` 1 one at a time.
    """
    spark = data.sparkSession
    space = SEARCH_SPACES[name] if space is None else space
    rng = random.Random(seed)
    points = [draw(space, rng) for _ in range(trials)]
    sizes = {r[0]: r[1] for r in data.groupBy(fold).count().collect()}  # one row per fold
    path = path or scratch_path(spark, "trials")
    done = {(r["trial"], r["fold"]): r["params"] for r in read_or_empty(spark, path, TRIALS_SCHEMA).select("trial", "fold", "params").collect()}
    other = [t for (t, _), params in done.items() if t < trials and params != str(points[t])]
    if other:
        raise ValueError(f"{path} holds trials of another search: {sorted(set(other))[:5]}")
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0)

    def fit(job: tuple[int, int]) -> None:
        trial, held = job
        start = time.monotonic()
        estimator = make_estimator(name, points[trial], sum(sizes.values()) - sizes[held], seed)
        model = estimator.fit(data.where(F.col(fold) != held))
        score = float(evaluator.evaluate(model.transform(data.where(F.col(fold) == held))))
        row = [(name, str(points[trial]), score, time.monotonic() - start)]
        one = spark.createDataFrame(row, "model string, params string, score double, seconds double")
        one.coalesce(1).write.mode("overwrite").json(f"{path}/trial={trial}/fold={held}")

    def fit_jointly(jobs: list[tuple[int, int]]) -> None:
        start = time.monotonic()
        made = [make_estimator(name, points[t], sum(sizes.values()) - sizes[f], seed) for t, f in jobs]
        scores = _joint_scores(data, fold, [f for _, f in jobs], made)
        each = (time.monotonic() - start) / len(jobs)
        written = [(name, str(points[t]), score, each, t, f) for (t, f), score in zip(jobs, scores)]
        ended = spark.createDataFrame(written, TRIALS_SCHEMA)
        ended.coalesce(1).write.mode("append").partitionBy("trial", "fold").json(path)

    def in_time(job, run=fit) -> None:
        if timeout is None or time.monotonic() < begun + timeout:
            run(job)

    begun = time.monotonic()
    left = [(t, f) for t in range(trials) for f in sorted(sizes) if (t, f) not in done]
    if name == "LogisticRegression":
        size = 1 if parallelism == 1 else JOINT
        for i in range(0, len(left), size):
            in_time(left[i : i + size], fit_jointly)
    else:
        with part_by_part(spark), ThreadPool(parallelism) as pool:
            for _ in pool.imap_unordered(inheritable_thread_target(spark)(in_time), left):
                pass
    rows = read_or_empty(spark, path, TRIALS_SCHEMA).where((F.col("trial") < trials) & F.col("fold").isin(list(sizes)))
    found = rows.groupBy("model", "trial", "params").agg(F.avg("score").alias("score"), F.count("*").alias("n"))
    found = found.where(F.col("n") == len(sizes)).drop("n")
    ended = found.collect()  # one row per trial
    if len(ended) < trials or not ended:
        raise TimeoutError(f"{trials - len(ended)} of {trials} trials of {name} are missing after {timeout} s")
    best = min(ended, key=lambda r: (-r["score"], r["trial"]))["trial"]
    return {**DEFAULTS[name], **points[best]}, found


def native_importance(trained: Trained) -> DataFrame:
    """``(feature, importance)`` of a tree model, largest first; a model of another kind has none."""
    spark = SparkSession.active()
    if not hasattr(trained.model, "featureImportances"):
        return spark.createDataFrame([], "feature string, importance double")
    values = trained.model.featureImportances.toArray()
    names = trained.features or [f"f{i}" for i in range(len(values))]
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def permutation_importance(
    model: Model,
    data: DataFrame,
    key: str,
    features: Sequence[str],
    repeats: int = 10,
    seed: int = SEED,
    bucket_rows: int = 50_000,
) -> DataFrame:
    """``(feature, importance_mean, importance_std)``: drop in accuracy when a column is permuted.

    For each repeat the rows fall into random buckets by a hash of the key; inside a
    bucket each row takes the value of the next row in random order. That is a
    permutation of the whole table that needs windows of bounded size only, and one
    shuffle serves all features of a repeat. A binary linear model is judged by its margin, which a permuted column moves by its
    coefficient times the difference: no row is made for each feature. Other models predict every permuted row.
    """
    buckets = max(1, data.count() // bucket_rows)
    base = data.select(ref(key).alias("_key"), LABEL, vector_to_array(FEATURES).alias("x"))
    repeated = base.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    shuffled = repeated.withColumn(
        "bucket", F.pmod(F.xxhash64("_key", "repeat", F.lit(seed)), F.lit(buckets))
    ).withColumn("order", F.xxhash64("_key", "repeat", F.lit(seed + 1)))
    w = Window.partitionBy("repeat", "bucket").orderBy("order")
    first = F.first("x").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    donors = shuffled.withColumn("donor", F.coalesce(F.lead("x").over(w), first))
    right = F.avg((F.col("prediction") == F.col(LABEL)).cast("double"))
    is_odd = F.exists(vector_to_array(FEATURES), lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
    facts = model.transform(data).agg(right.alias("s"), F.count_if(is_odd).alias("odd")).first()
    is_linear = isinstance(model, LogisticRegressionModel) and model.numClasses == 2 and not model.isSet("thresholds")
    if is_linear and not facts["odd"]:
        per = _right_by_margin(model, donors, len(features))
    else:
        per = _right_by_prediction(model, donors, len(features))
    names = F.array(*[F.lit(f) for f in features])
    drop = F.lit(facts["s"]) - F.col("s")
    return per.groupBy(F.element_at(names, F.col("j") + 1).alias("feature")).agg(
        F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std")
    )


def _right_by_prediction(model: Model, donors: DataFrame, width: int) -> DataFrame:
    """``(j, repeat, s)``: share of right predictions with feature ``j`` of the donor; the model sees a row for each feature."""
    permuted = donors.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(width - 1)))).select(
        "repeat",
        "j",
        LABEL,
        array_to_vector(
            F.transform("x", lambda v, i: F.when(i == F.col("j"), F.element_at("donor", i + 1)).otherwise(v))
        ).alias(FEATURES),
    )
    right = F.avg((F.col("prediction") == F.col(LABEL)).cast("double"))
    return model.transform(permuted).groupBy("j", "repeat").agg(right.alias("s"))


def _right_by_margin(model: LogisticRegressionModel, donors: DataFrame, width: int) -> DataFrame:
    """The same of a binary linear model over finite features: one count for each feature, no row."""
    weights, t = [float(c) for c in model.coefficients.toArray()], model.getThreshold()
    cut = -inf if t <= 0 else inf if t >= 1 else log(t / (1 - t))
    terms = [F.col("x")[i] * F.lit(c) for i, c in enumerate(weights)]
    rows = donors.withColumn("margin", reduce(Column.__add__, terms, F.lit(0.0)) + F.lit(float(model.intercept)))

    def right(j: int) -> Column:
        moved = F.col("margin") + F.lit(weights[j]) * (F.col("donor")[j] - F.col("x")[j])
        return F.sum((F.when(moved > cut, 1.0).otherwise(0.0) == F.col(LABEL)).cast("long"))

    counts = rows.groupBy("repeat").agg(F.count(LABEL).alias("n"), *[right(j).alias(f"n{j}") for j in range(width)])
    shares = F.array(*[F.col(f"n{j}") / F.col("n") for j in range(width)])
    return counts.select("repeat", F.posexplode(shares).alias("j", "s"))


def scoring_pipeline(features: Sequence[str], model: Model) -> PipelineModel:
    """Assembler and model as one object that can be saved, loaded and applied to a stream."""
    vector = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")
    return PipelineModel(stages=[vector, model])

