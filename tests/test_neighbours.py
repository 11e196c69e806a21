"""The pivot index against brute force, and what is built on it."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystone.operators import impute, neighbours, resample

SCHEMA = "g string, d long, x array<double>, v string"


def search(spark, x, k, **blocks):
    rows = [("a", i, [float(c) for c in r], str(i)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    return neighbours.nearest_donors(df.select("g", "x"), df, k, **blocks)


def by_hand(x, k):
    """For every distinct vector the k nearest rows, by distance and then number."""
    out = {}
    for r in {tuple(map(float, r)) for r in x}:
        gap = np.sqrt(((x - np.array(r)) ** 2).sum(axis=1))
        out[r] = [int(i) for i in np.lexsort((np.arange(len(x)), gap))[:k]]
    return out


@pytest.mark.parametrize("blocks", [{}, {"queries_per_block": 7, "donors_per_block": 11}])
def test_index_finds_what_all_pairs_find(spark, blocks):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(250, 3)), rng.integers(0, 3, (150, 3)), np.ones((120, 3))])  # clouds, ties, copies
    near = search(spark, x, 4, **blocks)
    found = {}
    for r in near.found.collect():
        assert r["v"] == str(r["d"])
        found.setdefault(tuple(r["x"]), []).append((r["distance"], r["d"]))
    assert {q: [d for _, d in sorted(some)] for q, some in found.items()} == by_hand(x, 4)


def test_measured_pairs_grow_slower_than_all_pairs(spark):
    rng = np.random.default_rng(9)
    work = {}
    for n in (1000, 8000):
        r = search(spark, rng.normal(size=(n, 2)), 5).work.first()
        assert r["queries"] == n and r["donors"] == n
        work[n] = r["pairs"]
    assert work[1000] < 1000 * 1000 / 2 and work[8000] < 8000 * 8000 / 10
    assert work[8000] / work[1000] < 64 / 2  # 64 times the pairs


def test_groups_do_not_meet(spark):
    rows = [("a", 1, [0.0], "p"), ("a", 2, [5.0], "q"), ("b", 3, [0.1, 0.0], "r")]
    df = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([("a", [0.1]), ("b", [9.0, 9.0]), ("c", [1.0])], "g string, x array<double>")
    assert sorted((r["g"], r["d"]) for r in neighbours.nearest_donors(asked, df, 3).found.collect()) == [("a", 1), ("a", 2), ("b", 3)]
    assert neighbours.nearest_donors(asked, df.limit(0), 3).found.count() == 0


def test_imputation_reports_its_work(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(3000, 2))
    rows = [(i, float(a), None if i % 10 == 0 else float(b)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    filled, work = impute.knn_search(df, "id", ["a", "b"], k=3)
    assert filled.where("b IS NULL").count() == 0
    r = work.first()
    assert (r["g"], r["queries"], r["donors"]) == ("10|11", 300, 2700) and r["pairs"] < 300 * 2700 / 10
    whole, none = impute.knn_search(df.where("b IS NOT NULL"), "id", ["a", "b"])
    assert none is None and whole.count() == 2700


# ---- synthetic rows -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def uneven(spark):
    rng = np.random.default_rng(11)
    rows = [(i, "many" if i < 300 else "few" if i < 370 else "rare", *map(float, rng.normal(size=2)), "x") for i in range(385)]
    rows += [(385, "rare", None, 1.0, "x"), (386, None, 0.0, 0.0, "x")]
    return spark.createDataFrame(rows, "id long, t string, a double, b double, other string")


def test_smote_raises_small_classes_along_segments(spark, uneven):
    made = resample.smote(uneven, "id", "t", ["a", "b"], k=3)
    got = made.collect()
    counts = {t: sum(r["t"] == t for r in got) for t in ("few", "rare")}
    assert counts == {"few": 230, "rare": 284} and len(got) == 514
    points = {r["id"]: (r["t"], np.array([r["a"], r["b"]])) for r in uneven.collect() if r["t"] and r["a"] is not None}
    per_base = {}
    for r in got:
        (t, p), (u, q) = points[r["base"]], points[r["neighbour"]]
        assert t == u == r["t"] and 0 <= r["gap"] < 1 and r["base"] != r["neighbour"]
        assert np.allclose(np.array([r["a"], r["b"]]), p + r["gap"] * (q - p))
        others = sorted((math.dist(p, v), i) for i, (c, v) in points.items() if c == t and i != r["base"])[:3]
        assert r["neighbour"] in [i for _, i in others]  # recall against brute force is 1
        per_base.setdefault((t, r["base"]), []).append(r["copy"])
    for t in counts:
        sizes = [len(c) for (c_t, _), c in per_base.items() if c_t == t]
        assert max(sizes) - min(sizes) <= 1
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, resample.smote(uneven, "id", "t", ["a", "b"], k=3).collect()), key=str)
    other = resample.smote(uneven, "id", "t", ["a", "b"], k=3, seed=1)
    assert other.exceptAll(made).count() > 0


def test_smote_limits(spark, uneven):
    assert resample.smote(uneven, "id", "t", ["a", "b"], ratio=0.04).count() == 0
    assert resample.smote(uneven.where("t = 'few'"), "id", "t", ["a", "b"]).count() == 0
    assert resample.smote(uneven.limit(0), "id", "t", ["a", "b"]).count() == 0
    with pytest.raises(ValueError, match="fewer than two"):
        resample.smote(uneven.where("id < 3 OR id = 384"), "id", "t", ["a", "b"])
    with pytest.raises(ValueError):
        resample.smote(uneven, "id", "t", ["a", "b"], ratio=2)
    copies = spark.createDataFrame([(i, "a", 1.0) for i in range(9)] + [(i, "b", 2.0) for i in range(9, 12)], "id long, t string, a double")
    made = resample.smote(copies, "id", "t", ["a"])
    assert made.count() == 6 and made.where((F.col("a") != 2.0) | (F.col("base") == F.col("neighbour"))).count() == 0


def test_measured_pairs_of_a_query_do_not_grow_with_the_donors(spark):
    rng = np.random.default_rng(12)
    each = {n: search(spark, rng.normal(size=(n, 2)), 5, donors_per_block=1000).work.first()["pairs"] / n for n in (2000, 16000)}
    assert each[16000] < 1.5 * each[2000]
