import numpy as np
import pandas as pd
import pytest
from row_helpers import by

from tallystone.operators import association, compare, correlation, drift


def groups(frame, **values):
    rows = [(i, g, float(v)) for g, vs in values.items() for i, v in enumerate(vs)]
    return frame([(n, g, v) for n, (_, g, v) in enumerate(rows)], "id long, g string, x double")


def test_confidence_interval_example(frame):
    df = frame([(v,) for v in (45.0, 52.0, 48.0, 55.0, 50.0)], "x double")
    r = compare.confidence_intervals(df, ["x"]).first()
    assert r["mean"] == 50.0 and r["margin_of_error"] == pytest.approx(4.728, abs=5e-4)
    assert r["sample_size"] == 5


def test_one_value_has_no_interval(frame):
    assert compare.confidence_intervals(frame([(1.0,), (None,)], "x double"), ["x"]).count() == 0


def test_welch_example(frame):
    df = groups(frame, a=[60, 65, 58, 62, 61], b=[45, 48, 50, 47, 46])
    r = compare.two_group_compare(df, ["x"], "g", "a", "b", test="welch").first()
    assert r["statistic"] == 9.7073 and r["cohens_d"] == 6.1394 and r["effect"] == "large" and r["significant"]


def test_anova_example(frame):
    df = groups(frame, a=[50, 52, 48, 51], b=[60, 62, 59, 61], c=[80, 82, 79, 81])
    parts = compare.anova_parts(compare.group_moments(df, ["x"], "g")).first()
    pdf = df.toPandas()
    grand = pdf["x"].mean()
    between = sum(len(g) * (g["x"].mean() - grand) ** 2 for _, g in pdf.groupby("g"))
    assert parts["between"] == pytest.approx(between)
    assert compare.anova(3, 12, 1800.6666667, 30.0)[0] == pytest.approx(270.1)


def test_mann_whitney_exact_for_small_untied_groups(frame):
    df = groups(frame, a=[1, 2, 3, 4], b=[5, 6, 7, 8])
    r = compare.two_group_compare(df, ["x"], "g", "a", "b", test="rank", tail="exact").first()
    assert r["statistic"] == 0.0 and r["p_value"] == pytest.approx(2 / 70, abs=1e-6)
    asymptotic = compare.two_group_compare(df, ["x"], "g", "a", "b", test="rank").first()
    assert asymptotic["p_value"] == pytest.approx(0.030383, abs=1e-6)


def test_a_test_does_not_change_with_the_size_of_the_table():
    """One more row does not switch the method: p-values on both sides of a size are close."""
    near = [compare.mann_whitney(8, n, 8 * 4.5 + 3000, 0.0)[1] for n in (124_999, 125_001)]
    assert near[0] == pytest.approx(near[1], rel=1e-3)
    with pytest.raises(ValueError, match="too large"):
        compare.mann_whitney(8, 125_001, 3036.0, 0.0, "exact")
    with pytest.raises(ValueError, match="ties"):
        compare.mann_whitney(8, 10, 40.0, 6.0, "exact")


def test_two_proportions_with_an_empty_group(frame):
    df = frame([("a", True), ("a", False)], "g string, ok boolean")
    r = compare.two_proportions(df, "g", "a", "b", df["ok"]).first()
    assert (r["n1"], r["n2"], r["share1"], r["share2"], r["z"]) == (2, 0, 0.5, None, None)


def test_chi_square_with_absent_pairs(spark):
    cells = [(str(i), str(j)) for i in range(3) for j in range(4) for _ in range((i + 1) * (j + 2) + (i == j))]
    df = spark.createDataFrame([c for c in cells if c != ("0", "3")], "v string, t string")
    got = association.chi_square_tests(df, ["v"], "t").first()
    table = df.toPandas().groupby(["v", "t"]).size().unstack(fill_value=0).to_numpy().astype(float)
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    assert got["chi2"] == pytest.approx(((table - expected) ** 2 / expected).sum(), abs=1e-4) and got["dof"] == 6


def test_crosstab_with_a_class_called_value(frame):
    df = frame([("a", "value"), ("a", "n"), ("b", "value")], "c string, t string")
    got = {(r["value"], r["target"]): r["n"] for r in association.crosstab(df, "c", "t").collect()}
    assert got == {("a", "value"): 1, ("a", "n"): 1, ("b", "value"): 1, ("b", "n"): 0}


def test_ks_tail_is_an_argument(spark):
    a, b = spark.range(60).selectExpr("id * 1.0 AS x"), spark.range(50).selectExpr("id * 1.1 + 7 AS x")
    exact, near = (drift.distribution_shift(a, b, ["x"], tail=t).first() for t in ("exact", "asymptotic"))
    assert exact["statistic"] == near["statistic"] and exact["p_value"] != near["p_value"]
    with pytest.raises(ValueError, match="unknown tail"):
        drift.distribution_shift(a, b, ["x"], tail="large")


def test_mann_whitney_all_tied(frame):
    df = groups(frame, a=[5, 5, 5], b=[5, 5, 5])
    r = compare.two_group_compare(df, ["x"], "g", "a", "b", test="rank").first()
    assert r["p_value"] == 1.0 and r["cohens_d"] == 0.0 and r["effect"] == "negligible"


def test_small_groups_are_left_out(frame):
    df = groups(frame, a=[1, 2], b=[3, 4, 5])
    assert compare.two_group_compare(df, ["x"], "g", "a", "b", test="welch").count() == 0
    assert compare.multi_group_compare(df, ["x"], "g", test="anova").count() == 0


def test_gate_picks_the_test(spark):
    rng = np.random.default_rng(3)
    n = 400
    pdf = pd.DataFrame({
        "id": range(2 * n),
        "g": ["a"] * n + ["b"] * n,
        "bell": rng.normal(size=2 * n),
        "flat": rng.uniform(size=2 * n) ** 4,
    })
    df = spark.createDataFrame(pdf)
    r = by(compare.two_group_compare(df, ["bell", "flat"], "g", "a", "b", "id"), "column")
    assert r["bell"]["test_type"] == "Welch's t-test" and r["flat"]["test_type"] == "Mann-Whitney U"
    m = by(compare.multi_group_compare(df, ["bell", "flat"], "g", "id"), "column")
    assert m["bell"]["test_type"] == "One-way ANOVA" and m["flat"]["test_type"] == "Kruskal-Wallis H-test"


def test_sample_has_exact_size_and_is_reproducible(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS g", "id * 1.0D AS x")
    sizes = spark.createDataFrame([("x", "a", 1000, 200), ("x", "b", 2000, 2000)], "column string, group string, n long, k long")
    first, second = (
        compare.sample_per_group(df, ["x"], "g", "id", sizes).orderBy("group", "value").collect() for _ in range(2)
    )
    assert first == second
    assert sum(r["group"] == "a" for r in first) == 200 and sum(r["group"] == "b" for r in first) == 2000


def test_sample_widens_a_bound_that_was_too_tight(spark):
    # one key value for all rows: the hash bound keeps nothing or everything
    df = spark.range(500).selectExpr("0 AS k", "'a' AS g", "id * 1.0D AS x")
    sizes = spark.createDataFrame([("x", "a", 500, 10)], "column string, group string, n long, k long")
    assert compare.sample_per_group(df, ["x"], "g", "k", sizes).count() == 10


def test_unknown_options_are_refused(frame):
    df = groups(frame, a=[1, 2, 3], b=[3, 4, 5])
    with pytest.raises(ValueError):
        compare.two_group_compare(df, ["x"], "g", "a", "b", test="magic", key="id")
    with pytest.raises(ValueError):
        compare.two_group_compare(df, ["x"], "g", "a", "b")
    with pytest.raises(ValueError):
        compare.adjust_p_values(df, "magic")
    with pytest.raises(ValueError):
        drift.distribution_shift(df, df, ["x"], method="magic")
    with pytest.raises(ValueError):
        correlation.correlation(df, ["id", "x"], "magic")


def table_2x2(frame, a, b, c, d):
    cells = {("r", "s"): a, ("r", "t"): b, ("u", "s"): c, ("u", "t"): d}
    return frame([k for k, n in cells.items() for _ in range(n)] + [(None, "s"), ("r", None)], "x string, y string")


@pytest.mark.parametrize(
    "cells,plain,corrected,p",
    [((120, 80, 100, 100), 4.0404, 3.6465, 0.0562), ((22, 16, 6, 79), 38.5982, 35.7610, 0.0)],
)
def test_chi_square_examples(frame, cells, plain, corrected, p):
    df = table_2x2(frame, *cells)
    assert association.chi_square_tests(df, ["x"], "y", yates=False).first()["chi2"] == plain
    r = association.chi_square_tests(df, ["x"], "y").first()
    assert r["chi2"] == pytest.approx(corrected, abs=1e-4) and r["dof"] == 1
    assert r["p_value"] == pytest.approx(p, abs=1e-4)


def test_chi_square_with_empty_cell_and_low_counts(frame):
    df = frame([("a", "s")] * 6 + [("b", "t")] * 3 + [("b", "s")] + [("c", "t")] * 2, "x string, y string")
    r = association.chi_square_tests(df, ["x"], "y").first()
    o = pd.crosstab(df.toPandas()["x"], df.toPandas()["y"]).to_numpy()
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    assert r["chi2"] == pytest.approx(((o - e) ** 2 / e).sum(), abs=1e-4)
    assert r["dof"] == 2 and r["low_expected"]


def test_chi_square_of_a_single_level(frame):
    r = association.chi_square_tests(frame([("a", "s"), ("a", "t")], "x string, y string"), ["x"], "y").first()
    assert (r["chi2"], r["dof"], r["p_value"], r["cramers_v"]) == (0.0, 0, 1.0, 0.0)


def test_crosstab_fills_zeros_and_takes_any_target_type(frame):
    df = frame([("a", 1), ("b", 2), ("a", 1), (None, 1)], "x string, y int")
    assert {(r["value"], r["target"]): r["n"] for r in association.crosstab(df, "x", "y").collect()} == {
        ("a", "1"): 2, ("a", "2"): 0, ("b", "1"): 0, ("b", "2"): 1,
    }


def test_ks_does_not_change_under_an_increasing_map(spark):
    a = spark.range(300).selectExpr("id * 0.5D AS x", "exp(id * 0.01D) AS y")
    b = spark.range(200).selectExpr("id * 0.9D AS x", "exp(id * 0.018D) AS y")
    r = by(drift.ks_statistics(a, b, ["x", "y"]), "column")
    assert r["x"]["d"] == pytest.approx(r["y"]["d"])
    va, vb = np.arange(300) * 0.5, np.arange(200) * 0.9
    grid = np.concatenate([va, vb])
    want = np.abs(np.searchsorted(va, grid, "right") / 300 - np.searchsorted(np.sort(vb), grid, "right") / 200).max()
    assert r["x"]["d"] == pytest.approx(want)


def test_same_tables_do_not_shift(spark):
    a = spark.range(100).selectExpr("id * 1.0D AS x")
    r = drift.distribution_shift(a, a, ["x", "absent"]).collect()
    assert len(r) == 1 and r[0]["statistic"] == 0.0 and r[0]["p_value"] == 1.0 and not r[0]["shift_detected"]
    assert drift.psi(a, a, ["x"]).first()["psi"] == 0.0


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_matches_pandas_with_nulls_ties_and_a_hot_value(spark, method):
    df = spark.range(900).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 5.0D ELSE id % 50 * 1.0D END AS a",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE id * id % 101 * 1.0D END AS b",
        "CASE WHEN id % 11 = 0 THEN double('nan') ELSE id * 1.0D END AS c",
        "1.0D AS constant",
    )
    columns = ["a", "b", "c", "constant"]
    want = df.toPandas()[columns].corr(method=method)
    for key in ("id", None):
        for r in correlation.correlation(df, columns, method, key).collect():
            expected = want.loc[r["x"], r["y"]]
            if np.isnan(expected):
                assert r["correlation"] is None
            else:
                assert r["correlation"] == pytest.approx(expected, abs=1e-9)


def test_wide_correlation_takes_the_same_route(spark):
    df = spark.range(80).selectExpr("id", *[f"CAST(id * {i + 3} % {17 + i} AS DOUBLE) AS c{i}" for i in range(15)], "1.0D AS same")
    columns = [c for c in df.columns if c != "id"]
    want = df.toPandas()[columns].corr(method="spearman")
    rows = correlation.correlation(df, columns, "spearman", "id").collect()
    assert len(rows) == 120
    for r in rows:
        expected = want.loc[r["x"], r["y"]]
        assert r["correlation"] is None if np.isnan(expected) else r["correlation"] == pytest.approx(expected, abs=1e-9)


def test_corrections(frame):
    df = frame([("a", 0.01), ("b", 0.02), ("c", 0.03), ("d", 0.6)], "column string, p_value double")
    b = by(compare.adjust_p_values(df, "bonferroni"), "column")
    assert [round(b[c]["p_adjusted"], 6) for c in "abcd"] == [0.04, 0.08, 0.12, 1.0]
    f = by(compare.adjust_p_values(df, "fdr"), "column")
    assert [round(f[c]["p_adjusted"], 6) for c in "abcd"] == [0.04, 0.04, 0.04, 0.6]


def test_two_proportions_example(frame):
    rows = [("a", True)] * 45 + [("a", False)] * 55 + [("b", True)] * 120 + [("b", False)] * 80
    df = frame(rows, "g string, ok boolean")
    r = compare.two_proportions(df, "g", "a", "b", df["ok"]).first()
    assert r["z"] == -2.4618 and r["p_value"] == pytest.approx(0.0138, abs=5e-5)


def test_tukey_and_fisher_on_small_tables(frame):
    rows = [(g, float(v)) for g, vs in (("a", (1, 2, 3, 4)), ("b", (2, 3, 4, 5, 6)), ("c", (8, 9, 10)), ("one", (7,))) for v in vs]
    got = {(r["group1"], r["group2"]): r for r in compare.tukey_hsd(frame(rows, "g string, x double"), ["x"], "g").collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert got["a", "c"]["significant"] and not got["a", "b"]["significant"] and got["a", "b"]["mean_difference"] == -1.5
    flat = frame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, x double")
    assert [(r["statistic"], r["p_value"]) for r in compare.tukey_hsd(flat, ["x"], "g").collect()] == [(None, None)]
    assert compare.tukey_hsd(flat.where("g = 'a'"), ["x"], "g").collect() == []
    tea = [("milk", "milk")] * 3 + [("milk", "tea")] + [("tea", "milk")] + [("tea", "tea")] * 3 + [(None, "tea")]
    r = association.fisher_exact(frame(tea, "c string, t string"), ["c"], "t").first()
    assert (r["n"], r["odds_ratio"], r["p_value"], r["significant"]) == (8, 9.0, 0.485714, False)
    with pytest.raises(ValueError, match="2x2"):
        association.fisher_exact(frame([("x", "a"), ("y", "b"), ("z", "a")], "c string, t string"), ["c"], "t")


def test_ranks_are_dealt_into_parts_by_their_number(spark, monkeypatch):
    from tallystone.operators import ranks

    monkeypatch.setattr(ranks, "ROWS_PER_RANGE", 100)
    dealt = []
    write = ranks.materialize
    monkeypatch.setattr(ranks, "materialize", lambda df, label: dealt.append(write(df, label)) or dealt[-1])
    cells = spark.range(3000).selectExpr("'a' AS column", "double(id) AS value", "1L AS n")
    upto = ranks.running(cells, ["column"], ["value"], ["n"])
    assert upto.where("n_upto != value + 1").count() == 0 and upto.count() == 3000
    sizes = [r["count"] for r in dealt[-1].groupBy("_pid").count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 300  # 8 parts of some 375 rows before, by the shuffle setting
