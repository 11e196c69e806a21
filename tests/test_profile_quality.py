import math

import pandas as pd
import pytest
from row_helpers import by

from tallystone.operators import profile, quality, selectors
from tallystone.operators.quantiles import exact_quantiles
from tallystone.operators.ranks import average_ranks, value_cells
from tallystone.operators.selectors import CheckFailed

NAN = float("nan")


@pytest.fixture
def mixed(frame):
    rows = [(1, 1.0, "a"), (2, None, "b"), (3, NAN, None), (4, 4.0, "a"), (5, -2.0, "b"), (6, 4.0, None)]
    return frame(rows, "id long, x double, s string")


def test_null_and_nan_are_both_missing(mixed):
    r = by(quality.missing_report(mixed), "column")
    assert r["x"]["missing_count"] == 2 and r["s"]["missing_count"] == 2 and "id" not in r
    assert r["x"]["missing_fraction"] == 0.3333 and r["x"]["severity"] == "CRITICAL"


def test_severity_borders(frame):
    rows = [(None if i < 1 else 1, None if i < 6 else 1, 1 if i else 1) for i in range(20)]
    r = by(quality.missing_report(frame(rows, "a int, b int, c int")), "column")
    assert (r["a"]["severity"], r["b"]["severity"]) == ("WARNING", "CRITICAL")
    assert "c" not in r


def test_no_missing_gives_no_rows(frame):
    assert quality.missing_report(frame([(1, "x")], "a int, b string")).count() == 0


def test_numeric_profile_matches_pandas(mixed):
    row = by(profile.numeric_profile(mixed, id_column="id"), "column")["x"]
    s = pd.Series([1.0, 4.0, -2.0, 4.0])
    d = s.describe()
    assert row["count"] == 4
    for mine, theirs in (("mean", "mean"), ("std", "std"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert row[mine] == pytest.approx(d[theirs])
    assert row["range"] == 6.0 and row["cv"] == round(d["std"] / d["mean"], 4)


def test_profile_of_empty_and_constant_columns(frame):
    r = by(profile.numeric_profile(frame([(None, 5.0), (NAN, 5.0)], "a double, b double")), "column")
    assert r["a"]["count"] == 0 and r["a"]["mean"] is None and r["a"]["q50"] is None
    assert r["b"]["std"] == 0.0 and r["b"]["range"] == 0.0


@pytest.mark.parametrize("small_window", [0, 1_000_000])
@pytest.mark.parametrize("accuracy", [4, 10_000])
def test_quantiles_are_exact_on_both_routes(spark, small_window, accuracy):
    # a third of all rows hold one value; a coarse sketch makes the brackets wide
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7.0D ELSE id * 0.37D % 11 END AS v", "id * id AS w")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["v", "w"], qs, accuracy=accuracy, small_window=small_window)
    pdf = df.toPandas()
    for c in ("v", "w"):
        for q in qs:
            assert got[c].values[q] == pytest.approx(pdf[c].quantile(q), abs=1e-9)


def test_quantiles_with_infinities(frame):
    df = frame([(float("-inf"),), (1.0,), (2.0,), (float("inf"),)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])["x"].values[0.5] == 1.5


def test_column_names_with_odd_characters(frame):
    df = frame([(1.0, 2.0), (3.0, 5.0)], "`a^2` double, `it's {v} ``q``` double")
    r = by(profile.numeric_profile(df), "column")
    assert r["a^2"]["mean"] == 2.0 and r["it's {v} `q`"]["max"] == 5.0


def test_average_ranks_match_pandas(spark):
    df = spark.range(500).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1.0D ELSE id % 17 * 1.0D END AS v")
    ranks = {r["value"]: r["rank"] for r in average_ranks(value_cells(df, ["v"])).collect()}
    pdf = df.toPandas()
    want = dict(zip(pdf["v"], pdf["v"].rank()))
    assert ranks == want


def test_duplicates_count_and_list(frame):
    rows = [(1, "a", 0.0), (2, "a", -0.0), (3, None, NAN), (4, None, None), (5, "b", 1.0), (6, "a", 0.0)]
    df = frame(rows, "id long, s string, x double")
    r = quality.duplicate_report(df, ["s", "x"]).first()
    assert (r["duplicate_count"], r["duplicate_percent"], r["has_duplicates"]) == (3, 50.0, True)
    assert {x["id"] for x in quality.duplicate_rows(df, "id", ["s", "x"]).collect()} == {2, 4, 6}
    none = quality.duplicate_report(df, ["id"]).first()
    assert none["duplicate_count"] == 0 and not none["has_duplicates"]


def test_keys_that_join_to_the_same_text_stay_apart(frame):
    df = frame([("a,b", "c"), ("a", "b,c"), ('a"', ""), ("a", '"')], "x string, y string")
    assert quality.duplicate_report(df).first()["duplicate_count"] == 0


def test_value_on_the_bound_is_no_outlier(frame):
    df = frame([(float(v),) for v in (1, 2, 3, 4, 5, 8, 9)], "x double")
    q1, q3 = 2.5, 6.5
    high = q3 + 1.5 * (q3 - q1)
    r = quality.iqr_outliers(df.union(df.sparkSession.createDataFrame([], df.schema)), ["x"]).first()
    assert r["outlier_count"] == 0 and r["upper_bound"] == high and r["iqr"] == 4.0
    z = quality.zscore_outliers(df, ["x"], threshold=1.0).first()
    assert z["outlier_count"] == 3


def test_mode_ties_go_to_the_smaller_value(frame):
    df = frame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    r = profile.categorical_profile(df).first()
    assert (r["count"], r["unique_count"], r["most_frequent"], r["most_frequent_count"]) == (4, 2, "a", 2)


def test_skewness_matches_pandas(frame):
    values = [1.0, 2.0, 2.5, 9.0, None]
    r = profile.skewness(frame([(v,) for v in values], "x double"), ["x"]).first()
    assert r["skewness"] == pytest.approx(pd.Series(values).skew())
    two = profile.skewness(frame([(1.0,), (2.0,)], "x double"), ["x"]).first()
    same = profile.skewness(frame([(1.0,)] * 5, "x double"), ["x"]).first()
    assert two["skewness"] is None and same["skewness"] is None


def test_range_check_bounds_are_inclusive_and_missing_passes(frame):
    df = frame([(0.0,), (10.0,), (None,), (NAN,)], "x double")
    r = selectors.range_check(df, {"x": (0, 10), "gone": (0, 1)}).collect()
    assert len(r) == 1 and r[0]["passed"] and (r[0]["n_below"], r[0]["n_above"]) == (0, 0)
    assert selectors.range_check(df, {"x": (1, None)}).first()["n_below"] == 1


def test_schema_and_type_reports(frame):
    df = frame([(1, "a")], "n int, s string")
    s = by(selectors.schema_report(df, ["n", "gone"]), "column")
    assert s["gone"]["severity"] == "error" and s["s"]["severity"] == "warning"
    t = by(selectors.dtype_report(df, numeric=["s", "gone"], categorical=["n"]), "column")
    assert t["s"]["severity"] == "error" and t["n"]["severity"] == "warning" and "gone" not in t
    with pytest.raises(CheckFailed):
        selectors.validate(df, expected=["n", "gone"])
    with pytest.raises(CheckFailed):
        selectors.validate(df, numeric=["s"])
    with pytest.raises(CheckFailed):
        selectors.validate(df, bounds={"n": (2, None)})
    assert selectors.validate(df, ["n", "s"], ["n"], ["s"], {"n": (0, 1)}) is df


def test_distinct_counts_keep_empty_columns(frame):
    df = frame([("a", None), ("b", None), ("a", None)], "s string, e string")
    r = by(profile.distinct_counts(df, ["s", "e"]), "column")
    assert (r["s"]["unique_count"], r["e"]["unique_count"]) == (2, 0)


def test_log_profile_flags(frame):
    r = by(profile.log_profile(frame([(0.0, -1.0), (2.0, 3.0)], "a double, b double"), ["a", "b"]), "column")
    assert r["a"]["has_zeros"] and not r["a"]["has_negatives"]
    assert r["b"]["has_negatives"] and not math.isnan(r["b"]["mean"])


def test_duplicates_keep_microseconds_and_missing_keys(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1L, TIMESTAMP_NTZ '2024-01-01 00:00:00.000001', TIMESTAMP '2024-01-01 00:00:00.000001'),
        (2L, TIMESTAMP_NTZ '2024-01-01 00:00:00.000002', TIMESTAMP '2024-01-01 00:00:00.000001'),
        (3L, TIMESTAMP_NTZ '2024-01-01 00:00:00.000003', TIMESTAMP '2024-01-01 00:00:00.000001'),
        (CAST(NULL AS BIGINT), TIMESTAMP_NTZ '2024-01-01 00:00:00.000003', TIMESTAMP '2024-01-01 00:00:00.000001'),
        (CAST(NULL AS BIGINT), TIMESTAMP_NTZ '2024-01-02 00:00:00', NULL) AS t(id, a, b)"""
    )
    assert quality.duplicate_report(df, ["a"]).first()["duplicate_count"] == 1
    assert quality.duplicate_report(df, ["b"]).first()["duplicate_count"] == 3
    again = quality.duplicate_rows(df, "id", ["a"]).collect()
    assert [(r["id"], r["a"].microsecond) for r in again] == [(None, 3)]


def test_ranges_of_large_whole_numbers(spark):
    df = spark.createDataFrame([(2**53,), (2**53 + 1,)], "v long")
    r = selectors.range_check(df, {"v": (0, 2**53)}).first()
    assert (r["n_below"], r["n_above"]) == (0, 1)
    assert selectors.range_check(df, {"v": (0.5, float("inf"))}).first()["passed"]


def test_density_with_a_long_tail(spark):
    import numpy as np

    from tallystone.operators import plotdata

    x = np.append(np.random.default_rng(1).normal(size=3000), [400.0, -900.0])
    got = plotdata.density(spark.createDataFrame([(float(v),) for v in x], "v double"), ["v"]).collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    for r in got[::20]:
        u = (r["x"] - x) / h
        want = np.exp(-0.5 * u * u).sum() / (len(x) * h * np.sqrt(2 * np.pi))
        assert abs(r["density"] - want) < 1e-6 * max(1.0, want)
