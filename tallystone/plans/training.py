"""Training: baselines, tuned finalists, selection, gates, saving.

A run lives in a folder. Every fit leaves its model, its metric rows and its fold scores there as soon as it has them, every
search its trials; selection, gates and the saved model are read from these tables. A run that broke off goes on where it stopped.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.functions.columns import ref
from tallystone.operators import gates, metrics, models
from tallystone.operators.split import stratified_folds
from tallystone.session import scratch_path
from tallystone.sources.tables import load_training, read_or_empty, save_model

PRIMARY = "f1_score"
METRICS = "model string, is_tuned boolean, dataset string, metric string, value double"
FOLDS = "model string, is_tuned boolean, fold int, f1_score double"
FITS = "model string, is_tuned boolean, params string, seconds double"


@dataclass(frozen=True)
class TrainingSettings:
    key: str
    target: str
    models: Mapping[str, Mapping] = field(
        default_factory=lambda: {name: {} for name in models.DEFAULTS}
    )
    cv_folds: int = 10
    tuning_folds: int = 5
    tune_top: int = 3
    trials: int = 50
    timeout: float | None = None
    parallelism: int = 4
    search_spaces: Mapping[str, Mapping] = field(default_factory=lambda: dict(models.SEARCH_SPACES))
    seed: int = 42


@dataclass
class TrainingResult:
    """``metrics`` and ``cv`` are tidy tables over all models; ``best`` is the selected one."""

    metrics: DataFrame
    cv: DataFrame
    board: DataFrame
    gaps: DataFrame
    checks: dict[str, DataFrame]
    verdict: DataFrame
    best: models.Trained
    all_models: list[models.Trained]
    path: str


def evaluate_model(trained: models.Trained, train: DataFrame, test: DataFrame) -> DataFrame:
    """``(model, is_tuned, dataset, metric, value)`` on both sets, from one evaluation."""
    scored = models.score(trained.model, train).withColumn("dataset", F.lit("train")).unionByName(
        models.score(trained.model, test).withColumn("dataset", F.lit("val"))
    )
    rows = metrics.evaluate(scored, by=["dataset"])
    return rows.select(
        F.lit(trained.name).alias("model"), F.lit(trained.is_tuned).alias("is_tuned"), "dataset", "metric", "value"
    )


class OtherRun(ValueError):
    """The folder holds a run of other settings or other rows."""


@dataclass(frozen=True)
class RunFolder:
    """The tables of one training run; a part is written whole, and a part that is there is not made again."""

    spark: SparkSession
    path: str

    def table(self, name: str, schema: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/{name}", schema)

    def has(self, name: str, schema: str, model: str, is_tuned: bool) -> bool:
        mine = (F.col("model") == model) & (F.col("is_tuned") == is_tuned)
        return not self.table(name, schema).where(mine).isEmpty()

    def put(self, name: str, part: str, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").json(f"{self.path}/{name}/part={part}")

    def claim(self, facts: Mapping[str, str]) -> None:
        """Write what the run is about, or compare with what stands there."""
        before = {r["fact"]: r["value"] for r in self.table("run", "fact string, value string").collect()}
        other = sorted(k for k in before if before[k] != facts.get(k))
        if other:
            raise OtherRun(f"{self.path} holds a run with another {', '.join(other)}")
        if not before:
            self.put("run", "facts", self.spark.createDataFrame(list(facts.items()), "fact string, value string"))

    def fitted(self, features: list[str], only: tuple[str, bool] | None = None) -> list[models.Trained]:
        """The fits of the run (or one of them), baselines first, with their models read back."""
        rows = self.table("fits", FITS).orderBy("is_tuned", "model").collect()  # one row per fit
        return [
            models.Trained(
                r["model"], json.loads(r["params"]), PipelineModel.load(self.model(r["model"], r["is_tuned"])).stages[0],
                r["seconds"], r["is_tuned"], list(features),
            )
            for r in rows if only in (None, (r["model"], r["is_tuned"]))
        ]

    def model(self, name: str, is_tuned: bool) -> str:
        return f"{self.path}/models/{_part(name, is_tuned)}"


def _part(name: str, is_tuned: bool) -> str:
    return f"{name}-{'tuned' if is_tuned else 'baseline'}"


def _fingerprint(df: DataFrame) -> str:
    """Number of rows and a sum of row hashes, the same for any order of rows."""
    row = F.pmod(F.xxhash64(*[ref(c) for c in df.columns]), F.lit(1 << 31))
    r = df.agg(F.count("*").alias("n"), F.sum(row).alias("s")).first()
    return f"{r['n']} rows, {r['s']}"


def run_training(train: DataFrame, test: DataFrame, s: TrainingSettings, path: str | None = None) -> TrainingResult:
    """Fit the baselines, tune the leading ones, rank all on the test part, gate the best.

    The run's tables go to ``path``: ``fits`` and ``models``, ``metrics``, ``cv``, ``trials``. Called again with the same path, it makes
    only what is missing; a folder of other settings or other rows is refused (:class:`OtherRun`). Ties on the leaderboard go
    by model name, baseline first.
    """
    spark = train.sparkSession
    _, _, names = load_training(train.drop(s.key), test.drop(s.key), s.target)
    folder = RunFolder(spark, path or scratch_path(spark, "training"))
    fixed = {k: v for k, v in asdict(s).items() if k not in ("parallelism", "timeout")}
    facts = {k: json.dumps(v, sort_keys=True) for k, v in fixed.items()}
    folder.claim({**facts, "features": json.dumps(names), "train": _fingerprint(train), "test": _fingerprint(test)})
    ready = models.assemble(train, names, s.target, keep=[s.key])
    ready = stratified_folds(ready, s.key, models.LABEL, s.cv_folds, s.seed)
    if s.tune_top:
        ready = stratified_folds(ready, s.key, models.LABEL, s.tuning_folds, s.seed + 1, "tuning_fold")
    ready = models.sized(ready, s.key)  # iterative fits read it many times
    held = models.sized(models.assemble(test, names, s.target, keep=[s.key]), s.key)

    def settle(name: str, params: Mapping, tuned: bool) -> None:
        part = _part(name, tuned)
        if not folder.has("fits", FITS, name, tuned):
            t = models.train(name, ready, params, tuned, names, s.seed)
            PipelineModel(stages=[t.model]).write().overwrite().save(folder.model(name, tuned))
            row = [(name, tuned, json.dumps(t.params, sort_keys=True), t.seconds)]
            folder.put("fits", part, spark.createDataFrame(row, FITS))
        if not folder.has("metrics", METRICS, name, tuned):
            folder.put("metrics", part, evaluate_model(*folder.fitted(names, (name, tuned)), ready, held))
        if s.cv_folds > 1 and not folder.has("cv", FOLDS, name, tuned):
            scores = models.cross_validate(name, ready, "fold", params, s.seed, s.parallelism)
            folder.put("cv", part, scores.select("model", F.lit(tuned).alias("is_tuned"), "fold", "f1_score"))

    for name, params in s.models.items():
        settle(name, params, False)
    result = folder.table("metrics", METRICS)
    val = F.col("dataset") == "val"
    if s.tune_top:
        leading = gates.leaderboard(result.where(val & ~F.col("is_tuned")), PRIMARY, s.tune_top).collect()
        for name in [r["model"] for r in leading]:
            trials = f"{folder.path}/trials/{name}"
            best, _ = models.random_search(
                name, ready, "tuning_fold", s.trials, s.search_spaces[name], s.parallelism, s.seed, trials, s.timeout
            )
            settle(name, {**s.models[name], **best}, True)
    result = folder.table("metrics", METRICS)  # the folder has got files since
    board = gates.leaderboard(result.where(val), PRIMARY)
    fits = folder.fitted(names)
    top = board.first()
    best = next(t for t in fits if t.name == top["model"] and t.is_tuned == top["is_tuned"])
    gaps = metrics.generalization_gap(result)
    checks = gate_checks(result, gaps, best, held)
    return TrainingResult(
        result, folder.table("cv", FOLDS), board, gaps, checks, gates.combined_verdict(*checks.values()), best, fits, folder.path
    )


def gate_checks(result: DataFrame, gaps: DataFrame, best: models.Trained, held: DataFrame) -> dict[str, DataFrame]:
    """Threshold, overfitting and business checks of the selected model."""
    mine = (F.col("model") == best.name) & (F.col("is_tuned") == best.is_tuned)
    val = result.where(mine & (F.col("dataset") == "val")).select("metric", "value")
    confusion = metrics.confusion_matrix(models.score(best.model, held))
    return {
        "performance": gates.performance_gate(val),
        "overfitting": gates.overfitting_gate(gaps.where(mine & (F.col("metric") == PRIMARY))),
        "business": gates.business_gate(confusion),
    }


def save_best(result: TrainingResult, path: str) -> None:
    best = result.best
    mine = (F.col("model") == best.name) & (F.col("is_tuned") == best.is_tuned)
    seconds = result.metrics.sparkSession.createDataFrame(
        [(best.name, best.is_tuned, "train", "training_time", best.seconds)], result.metrics.schema
    )
    save_model(
        best.model, path, best.features, result.metrics.where(mine).unionByName(seconds), result.cv.where(mine)
    )
