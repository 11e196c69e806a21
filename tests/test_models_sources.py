import inspect
import random
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from row_helpers import by
from pyspark.sql import functions as F

from tallystone.operators import models
from tallystone.operators.selectors import CheckFailed
from tallystone.operators.split import stratified_folds
from tallystone.plans.catalog import modelling
from tallystone.plans.training import OtherRun, TrainingSettings, run_training, save_best
from tallystone.session import materialize, shared_dir
from tallystone.sources import tables


@pytest.fixture(scope="module")
def separable(spark):
    """The label follows ``a``; ``b`` is noise."""
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=600), rng.normal(size=600)
    y = (a + 0.3 * rng.normal(size=600) > 0.4).astype(int)
    rows = [(i, float(a[i]), float(b[i]), int(y[i])) for i in range(600)]
    return materialize(spark.createDataFrame(rows, "id long, a double, b double, y int"))


@pytest.mark.parametrize(
    "name,params",
    [
        ("LogisticRegression", {}),
        ("LogisticRegression", {"penalty": "l1", "C": 0.5}),
        ("RandomForest", {"n_estimators": 8, "max_features": "sqrt"}),
        ("XGBoost", {"n_estimators": 5, "subsample": 0.8, "colsample_bytree": 0.9, "gamma": 0.0}),
        ("LightGBM", {"n_estimators": 5, "min_child_samples": 5}),
    ],
)
def test_every_model_learns(separable, name, params):
    data = models.assemble(separable, ["a", "b"], "y", keep=["id"])
    trained = models.train(name, data, params, features=["a", "b"])
    r = models.score(trained.model, data, ["id"]).agg(F.avg((F.col("y") == F.col("pred")).cast("int"))).first()
    assert r[0] > 0.8 and trained.seconds > 0
    if name != "LogisticRegression":
        assert models.native_importance(trained).first()["feature"] == "a"


def test_unknown_names_are_refused():
    with pytest.raises(ValueError):
        models.make_estimator("Magic")
    with pytest.raises(ValueError):
        models.make_estimator("RandomForest", {"magic": 1})
    with pytest.raises(ValueError):
        models.draw({"x": ("magic", 1, 2)}, random.Random(0))


def test_draws_stay_inside_their_space():
    rng = random.Random(1)
    for _ in range(50):
        p = models.draw({"i": ("int", 1, 3), "u": ("uniform", 0, 2), "l": ("log_uniform", 0.01, 1), "c": ("categorical", "xy")}, rng)
        assert p["i"] in (1, 2, 3) and 0 <= p["u"] <= 2 and 0.01 <= p["l"] <= 1 and p["c"] in "xy"


def test_cross_validation_and_permutation(separable):
    data = models.assemble(separable, ["a", "b"], "y", keep=["id"])
    folded = stratified_folds(data, "id", models.LABEL, 3)
    scores = models.cross_validate("LogisticRegression", folded)
    assert scores.count() == 3
    s = models.cv_summary(scores).first()
    assert s["cv_min"] <= s["cv_mean"] <= s["cv_max"] and s["n_folds"] == 3
    assert models.cv_summary(scores, "median").first()["cv_median"] > 0.7
    model = models.train("LogisticRegression", data).model
    for rows in (50_000, 40):  # one bucket, many buckets
        imp = by(models.permutation_importance(model, data, "id", ["a", "b"], repeats=4, bucket_rows=rows), "feature")
        assert imp["a"]["importance_mean"] > 0.2 > 0.05 > abs(imp["b"]["importance_mean"])


def test_linear_importance_makes_no_row_for_each_feature(separable, monkeypatch):
    data = models.assemble(separable, ["a", "b"], "y", keep=["id"])
    model = models.train("LogisticRegression", data).model.setThreshold(0.6)
    shown = lambda rows: models.permutation_importance(model, rows, "id", ["a", "b"], repeats=3, bucket_rows=40)
    found = lambda rows: {r["feature"]: pytest.approx([r["importance_mean"], r["importance_std"]]) for r in shown(rows).collect()}
    predicted = []
    general = models._right_by_prediction
    monkeypatch.setattr(models, "_right_by_prediction", lambda *x: predicted.append(1) or general(*x))
    fast = found(data)
    assert not predicted
    odd = models.assemble(separable.withColumn("b", F.when(F.col("id") == 0, float("inf")).otherwise(F.col("b"))), ["a", "b"], "y", keep=["id"])
    assert found(odd) and predicted  # what an infinite value adds cannot be taken off again
    monkeypatch.setattr(models, "_right_by_margin", general)
    assert {r["feature"]: [r["importance_mean"], r["importance_std"]] for r in shown(data).collect()} == fast


def test_fits_read_even_parts(separable, monkeypatch):
    """Parts beyond one for each core come in equal numbers for all, and a task of a fit reads one of them."""
    spark = separable.sparkSession
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.files.openCostInBytes")
    data = models.assemble(separable, ["a", "b"], "y", keep=["id"])
    small, large = (models.sized(data, "id", rows, -(-600 // (2 * cores))) for rows in (600 // 2, 600 // (3 * cores)))
    read = lambda table: sorted(r["n"] for r in table.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    with models.part_by_part(spark):
        assert len(read(small)) == 2 and len(read(large)) == 2 * cores
    assert len(read(large)) <= cores + 1 and spark.conf.get("spark.sql.files.openCostInBytes") == before

    seen = []

    class Probe:
        def fit(self, rows):
            seen.append(len(read(rows)))

    monkeypatch.setattr(models, "make_estimator", lambda *_: Probe())
    models.train("RandomForest", large)
    assert seen == [2 * cores]


def small_run(**more):
    return TrainingSettings(
        key="id", target="y", models={"LogisticRegression": {}, "RandomForest": {"n_estimators": 3}}, cv_folds=2, tuning_folds=2,
        tune_top=1, trials=2, search_spaces={"RandomForest": {"max_depth": ("int", 2, 3)}, "LogisticRegression": {"C": ("uniform", 0.5, 1)}}, **more,
    )


@pytest.fixture(scope="module")
def split_rows(separable):
    return separable.where("id % 5 > 0"), separable.where("id % 5 = 0")


@pytest.fixture(scope="module")
def result(split_rows, tmp_path_factory):
    return run_training(*split_rows, small_run(), str(tmp_path_factory.mktemp("training") / "whole"))


def test_training_flow_selects_gates_and_saves(spark, split_rows, result, tmp_path):
    train, test = split_rows
    assert len(result.all_models) == 3 and result.board.count() == 3 and result.cv.count() == 6
    assert result.board.first()["model"] == result.best.name
    assert {r["metric"] for r in result.metrics.collect()} >= {"roc_auc", "log_loss"}
    assert result.verdict.first()["n_checks"] == 5
    save_best(result, str(tmp_path / "best"))
    model, names = tables.load_model(spark, str(tmp_path / "best"))
    assert names == ["a", "b"]
    data = models.assemble(test, names, "y")
    same = models.score(model, data).agg(F.sum("p")).first()[0]
    assert same == pytest.approx(models.score(result.best.model, data).agg(F.sum("p")).first()[0])


def test_training_goes_on_where_it_broke_off(split_rows, result, tmp_path, monkeypatch):
    train, test = split_rows
    path, made, make = str(tmp_path / "run"), [], models.make_estimator

    def breaking(limit):
        def counted(*args):
            if len(made) >= limit:
                raise RuntimeError("the machine is gone")
            made.append(args[0])
            return make(*args)

        return counted

    # two baselines of one fit and two folds, a search of two trials and two folds, a tuned fit and its two folds
    for limit in (4, 9):
        monkeypatch.setattr(models, "make_estimator", breaking(limit))
        with pytest.raises(RuntimeError):
            run_training(train, test, small_run(parallelism=1), path)
    monkeypatch.setattr(models, "make_estimator", breaking(10**9))
    parts = run_training(train, test, small_run(parallelism=1), path)
    assert len(made) <= 13 + 1  # the folds of one fit are written together, so those of a broken set are fitted again
    rows = lambda df: sorted(map(tuple, df.collect()))
    for table in ("metrics", "board", "cv", "gaps", "verdict"):
        assert rows(getattr(parts, table)) == rows(getattr(result, table)), table


def test_a_run_folder_belongs_to_one_run(split_rows, tmp_path):
    train, test = split_rows
    s = TrainingSettings(key="id", target="y", models={"RandomForest": {"n_estimators": 2}}, cv_folds=0, tune_top=0)
    path = str(tmp_path / "run")
    run_training(train, test, s, path)
    run_training(train.orderBy(F.desc("id")), test, s, path)  # the order of rows says nothing
    with pytest.raises(OtherRun, match="train"):
        run_training(train.where("id <> 1"), test, s, path)
    with pytest.raises(OtherRun, match="seed"):
        run_training(train, test, replace(s, seed=7), path)


def test_board_and_gates_follow_from_the_stored_rows(result):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW m AS SELECT * FROM read_json('{result.path}/metrics/*/*.json')")
    board = con.execute("SELECT model, is_tuned, value FROM m WHERE dataset = 'val' AND metric = 'f1_score' ORDER BY value DESC, model, is_tuned")
    assert [tuple(r) for r in result.board.collect()] == board.fetchall()
    sides = "max(value) FILTER (dataset = '{}')"
    gaps = con.execute(f"SELECT model, is_tuned, metric, {sides.format('train')} - {sides.format('val')} FROM m GROUP BY ALL").fetchall()
    assert {(r["model"], r["is_tuned"], r["metric"]): r["gap"] for r in result.gaps.collect()} == pytest.approx({r[:3]: r[3] for r in gaps})
    best = result.best
    score = dict(con.execute("SELECT metric, value FROM m WHERE dataset = 'val' AND model = ? AND is_tuned = ?", [best.name, best.is_tuned]).fetchall())
    passed = {r["metric"]: r["passed"] for r in result.checks["performance"].collect()}
    assert passed == {"f1_score": score["f1_score"] >= 0.7, "roc_auc": score["roc_auc"] >= 0.75}
    assert result.verdict.first()["overall_passed"] == (result.verdict.first()["n_failed"] == 0)


def test_a_search_stops_at_its_time(separable, tmp_path):
    data = models.assemble(separable, ["a", "b"], "y", keep=["id"])
    folded = materialize(stratified_folds(data, "id", models.LABEL, 2))
    space, path = {"C": ("log_uniform", 0.01, 10)}, str(tmp_path / "t")
    search = lambda timeout: models.random_search("LogisticRegression", folded, trials=3, space=space, path=path, parallelism=1, timeout=timeout)
    with pytest.raises(TimeoutError):
        search(0.0)
    assert search(None)[1].count() == 3 and search(0.0)[1].count() == 3  # trials that stand need no time


def test_a_search_never_answers_with_a_part_of_its_trials(separable, tmp_path):
    data = models.assemble(separable, ["a", "b"], "y", keep=["id"])
    folded = materialize(stratified_folds(data, "id", models.LABEL, 2))
    for name, space in (("LogisticRegression", {"C": ("log_uniform", 0.01, 10)}), ("RandomForest", {"n_estimators": ("int", 2, 4)})):
        search = lambda trials, **more: models.random_search(name, folded, trials=trials, space=space, path=str(tmp_path / name), **more)
        assert search(1)[1].count() == 1
        with pytest.raises(TimeoutError):
            search(3, timeout=0.0)  # one trial stands, two are missing
        assert search(3)[1].count() == 3
    assert inspect.signature(models.random_search).parameters["timeout"].default is None and modelling.LOAN_TRAINING.timeout is None


def test_search_goes_on_where_it_broke_off(separable, tmp_path, monkeypatch):
    data = models.assemble(separable, ["a", "b"], "y", keep=["id"])
    folded = materialize(stratified_folds(data, "id", models.LABEL, 2))
    path, space = str(tmp_path / "trials"), {"C": ("log_uniform", 0.01, 10), "solver": ("categorical", ["liblinear", "saga"])}
    built, make, limit = [], models.make_estimator, 3

    def counted(*args):
        if len(built) == limit:
            raise RuntimeError("the machine is gone")
        built.append(args)
        return make(*args)

    monkeypatch.setattr(models, "make_estimator", counted)
    search = lambda trials: models.random_search("LogisticRegression", folded, trials=trials, space=space, parallelism=1, path=path)
    with pytest.raises(RuntimeError):
        search(3)
    limit = 99
    best, found = search(3)
    assert len(built) == 6 and found.count() == 3  # three trials of two folds, none fitted twice
    again, same = search(3)
    assert len(built) == 6 and again == best and sorted(map(tuple, same.collect())) == sorted(map(tuple, found.collect()))
    rows = by(found, "trial")
    assert rows[max(rows, key=lambda t: (rows[t]["score"], -t))]["params"] in str([{k: best[k] for k in space}])
    search(4)
    assert len(built) == 8
    with pytest.raises(ValueError, match="another search"):
        models.random_search("LogisticRegression", folded, trials=3, space=space, path=path, seed=1)


def test_leaves_and_splits_are_bounded(separable):
    data = models.assemble(separable, ["a", "b"], "y", keep=["id"])
    for leaves in (2, 5, 31):
        model = models.train("LightGBM", data, {"n_estimators": 3, "num_leaves": leaves, "min_child_samples": 1}).model
        assert all((t.numNodes + 1) // 2 <= leaves for t in model.trees)
    model = models.train("RandomForest", data, {"n_estimators": 5, "max_depth": 20, "min_samples_split": 200}).model
    nodes = data.sparkSession.createDataFrame([(t.numNodes,) for t in model.trees], "n int")
    assert nodes.where("n > 11").count() == 0  # 600 rows, 100 or more on each side
    presets = {n: models.make_estimator(n).extractParamMap() for n in ("XGBoost", "LightGBM")}
    assert len({str(sorted((p.name, v) for p, v in m.items())) for m in presets.values()}) == 2


# ---- sources --------------------------------------------------------------------------------


def test_read_guards(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "gone"), "csv")
    (tmp_path / "empty.csv").write_text("a,b\n")
    with pytest.raises(tables.EmptyTable):
        tables.read_table(spark, str(tmp_path / "empty.csv"), "csv", "a int, b string")


def test_csv_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,flag,x\n1,0,1.5\n2,1,\n")
    df = tables.read_table(spark, str(tmp_path / "t.csv"), categorical=["flag"])
    assert dict(df.dtypes) == {"id": "int", "flag": "string", "x": "double"}
    assert df.where("x IS NULL").count() == 1


def test_split_round_trip_reads_one_partition(spark, tmp_path, frame):
    df = frame([(1, 1, "train"), (2, 0, "train"), (3, 1, "test")], "a int, y int, split string")
    tables.save_split(df, str(tmp_path / "s"))
    train, test = tables.load_split(spark, str(tmp_path / "s"), "y")
    assert (train.count(), test.count()) == (2, 1)
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().executedPlan().toString()
    _, _, names = tables.load_training(train, test, "y")
    assert names == ["a"]
    with pytest.raises(CheckFailed):
        tables.load_training(train, test.withColumnRenamed("a", "b"), "y")
    m = by(tables.training_metadata(train, test, "y"), "split", "class")
    assert m["train", 1]["n"] == 1 and m["test", 1]["n_features"] == 1


def test_results_and_metadata_accumulate(spark, tmp_path, frame):
    df = frame([("x", 1.0)], "column string, value double")
    for run in ("r1", "r2"):
        tables.save_results({"numeric": df}, str(tmp_path / "res"), run)
        tables.append_run_metadata(spark, str(tmp_path / "meta"), run, {"rows": 3})
    assert {r["run_id"] for r in tables.load_results(spark, str(tmp_path / "res"), "numeric").collect()} == {"r1", "r2"}
    assert spark.read.json(str(tmp_path / "meta")).count() == 2
    with pytest.raises(ValueError):
        tables.save_results({"numeric": df}, str(tmp_path / "res"), "r3", "pickle")


def test_runs_are_published_once_and_whole(spark, tmp_path, frame):
    path = str(tmp_path / "runs")
    one, two = frame([("x", 1.0)], "column string, value double"), frame([("y", 2.0), ("z", 3.0)], "column string, value double")
    tables.publish_run({"a": one, "b": two}, path, "2024-01-01")
    with pytest.raises(tables.RunPublished):
        tables.publish_run({"a": two}, path, "2024-01-01")
    broken = two.select("column", F.raise_error(F.lit("lost")).cast("double").alias("value"))
    with pytest.raises(Exception, match="lost"):
        tables.publish_run({"a": two, "b": broken}, path, "r2")
    read = lambda name: sorted((r["run_id"], r["column"]) for r in tables.read_published(spark, path, name).collect())
    assert read("a") == [("2024-01-01", "x")]  # what r2 staged is not seen
    tables.publish_run({"a": two, "b": one}, path, "r2")
    assert read("a") == [("2024-01-01", "x"), ("r2", "y"), ("r2", "z")] and read("b")[-1] == ("r2", "x")
    tables.publish_run({"a": two}, path, "2024-01-01", replace=True)
    assert [c for run, c in read("a") if run == "2024-01-01"] == ["y", "z"] and read("b") == [("r2", "x")]
    with pytest.raises(ValueError):
        tables.publish_run({}, path, "r3")


def test_repeated_metadata_replaces(spark, tmp_path):
    for rows in (1, 2):
        tables.append_run_metadata(spark, str(tmp_path / "m"), "2024-01-01", {"rows": rows})
    assert [tuple(r) for r in tables.load_run_metadata(spark, str(tmp_path / "m")).collect()] == [("rows", "2", "2024-01-01")]


def test_intermediates_go_to_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(f.startswith("file:" + shared_dir(spark)) or shared_dir(spark) in f for f in materialize(spark.range(3)).inputFiles())


# ---- registered queries ---------------------------------------------------------------------


def test_registered_fits_and_search_are_at_full_size(spark, separable, monkeypatch):
    data = models.assemble(separable.withColumnRenamed("id", modelling.KEY), ["a", "b"], "y", keep=[modelling.KEY])
    monkeypatch.setattr(modelling, "_ready", lambda spark, sf: (data, data, ["a", "b"]))
    built, searched = {}, {}

    def fit(name, rows, params=None, **_):
        built[name] = models.make_estimator(name, params)
        return models.Trained(name, {}, None, 0.0)

    def search(name, folded, fold="fold", trials=50, space=None):
        searched.update(folds=folded.select(fold).distinct().count(), trials=trials, space=space or models.SEARCH_SPACES[name])
        return {}, None

    scored = spark.createDataFrame([(1, 0.9, 1), (0, 0.1, 0)], "y int, p double, pred int")
    monkeypatch.setattr(models, "train", fit)
    monkeypatch.setattr(models, "score", lambda model, rows: scored)
    monkeypatch.setattr(models, "random_search", search)
    modelling.train_boosted_trees(spark, "")
    modelling.train_boosted_trees_second_preset(spark, "")
    modelling.random_search(spark, "")
    assert {n: (e.getMaxIter(), e.getMaxDepth()) for n, e in built.items()} == {"XGBoost": (100, 6), "LightGBM": (100, 4)}
    assert searched == {"folds": 5, "trials": 50, "space": models.SEARCH_SPACES["RandomForest"]}
