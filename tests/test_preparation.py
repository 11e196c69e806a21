import json
import math
from dataclasses import asdict, replace

import numpy as np
import pytest
from row_helpers import by
from pyspark.sql import functions as F

from tallystone.functions.formula import formula_column
from tallystone.operators import encode, features, impute, outliers, scale, selection, split
from tallystone.operators.selectors import CheckFailed
from tallystone.plans.catalog.registry import loan
from tallystone.plans.prepare import FittedPreparation, fit_preparation, loan_settings, prepare, save_prepared, settings_from

NAN = float("nan")


@pytest.fixture
def skewed(spark):
    """A third of the rows in one class, and a rare class."""
    return spark.range(1000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 97 = 0 THEN 'rare' ELSE 'b' END AS t", "id * 1.0D AS x"
    )


def test_split_is_disjoint_complete_and_exact(skewed):
    out = split.stratified_split(skewed, "id", "t")
    rows = out.collect()
    assert len(rows) == 1000 and len({r["id"] for r in rows}) == 1000
    test = [r for r in rows if r["split"] == "test"]
    assert len(test) == math.ceil(0.2 * 1000)
    sizes = {r["t"]: r["count"] for r in skewed.groupBy("t").count().collect()}
    for t, n in sizes.items():
        assert abs(sum(r["t"] == t for r in test) - 0.2 * n) <= 1
    again = {r["id"]: r["split"] for r in split.stratified_split(skewed.repartition(7), "id", "t").collect()}
    assert again == {r["id"]: r["split"] for r in rows}
    other = {r["id"]: r["split"] for r in split.stratified_split(skewed, "id", "t", seed=7).collect()}
    assert other != again


def test_split_handles_missing_classes_and_tiny_tables(frame):
    df = frame([(i, None if i < 4 else "a") for i in range(10)], "id long, t string")
    counts = split.stratified_split(df, "id", "t").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in counts} == {"train": 8, "test": 2}


def test_split_guards(skewed):
    with pytest.raises(ValueError):
        split.stratified_split(skewed, "id", "t", 0.8, 0.3)
    with pytest.raises(ValueError):
        split.stratified_split(skewed, "id", "gone")
    with pytest.raises(ValueError):
        split.stratified_split(skewed, "id", "t", shuffle=False)
    many = skewed.sparkSession.range(1100).withColumn("u", F.col("id"))
    full = split.stratified_split(many, "id", "u")
    assert full.where("split = 'test'").count() == 220


def test_split_refuses_missing_keys(frame):
    df = frame([(None if i < 3 else i, "a") for i in range(20)], "id long, t string")
    with pytest.raises(ValueError, match="needs a key"):
        split.stratified_split(df, "id", "t")
    with pytest.raises(ValueError, match="needs a key"):
        split.stratified_split(df, "id", "t", stratify=False, shuffle=False)


@pytest.mark.parametrize(
    ("keys", "kind"),
    [([i / 10 for i in range(10)], "double"), ([2**60 + i for i in range(10)], "long"), ([f"k{i}" for i in range(10)], "string")],
)
def test_ordered_split_on_any_key(frame, keys, kind):
    got = split.stratified_split(frame([(k, "a") for k in reversed(keys)], f"id {kind}, t string"), "id", "t", stratify=False, shuffle=False)
    assert sorted(r["id"] for r in got.where("split = 'train'").collect()) == keys[:8]


def test_imputed_types_do_not_depend_on_the_values(frame):
    for values in ([1, 2, 3, None], [1, 2, 2, None]):
        df = frame([(v,) for v in values], "v int")
        for strategy, kind in (("mean", "double"), ("median", "double"), ("mode", "int"), ("constant", "int")):
            out = impute.apply_imputer(df, impute.fit_imputer(df, numeric=strategy))
            assert dict(out.dtypes)["v"] == kind, strategy


def test_knn_takes_any_key_and_always_gives_doubles(frame):
    holes = frame([("LP1", 1, 1), ("LP2", 2, None), ("LP3", 3, 5)], "id string, a int, b int")
    whole = holes.where("b IS NOT NULL")
    assert {r["id"]: r["b"] for r in impute.knn_impute(holes, "id", ["a", "b"], k=2).collect()}["LP2"] == 3.0
    assert impute.knn_impute(holes, "id", ["a", "b"]).dtypes == impute.knn_impute(whole, "id", ["a", "b"]).dtypes


def test_ordered_split_keeps_order(skewed):
    out = split.stratified_split(skewed, "id", "t", stratify=False, shuffle=False)
    assert {r["id"] for r in out.where("split = 'test'").collect()} == set(range(800, 1000))


def test_folds_are_even_per_class(skewed):
    counts = split.stratified_folds(skewed, "id", "t", 10).groupBy("t", "fold").count().collect()
    assert {r["fold"] for r in counts} == set(range(10))
    for t in ("a", "b"):
        sizes = [r["count"] for r in counts if r["t"] == t]
        assert max(sizes) - min(sizes) <= 1


def test_under_sample_and_weights(skewed):
    counts = {r["t"]: r["count"] for r in split.under_sample(skewed, "id", "t").groupBy("t").count().collect()}
    assert len(set(counts.values())) == 1
    weights = by(split.class_weights(skewed, "t"), "class")
    assert sum(r["n"] * r["weight"] for r in weights.values()) == pytest.approx(1000)
    one = split.with_class_weight(skewed, "t").where("t = 'a'").first()["weight"]
    assert one == pytest.approx(weights["a"]["weight"])


# ---- imputation -----------------------------------------------------------------------------


@pytest.fixture
def holed(frame):
    return frame(
        [(1, 1.0, "a", 1), (2, None, None, None), (3, NAN, "b", 2), (4, 2.0, "b", 2), (5, 6.0, "a", 4)],
        "id long, x double, s string, n int",
    )


@pytest.mark.parametrize("strategy,x,n", [("mean", 3.0, 2.25), ("median", 2.0, 2), ("mode", 1.0, 2), ("constant", 0.0, 0)])
def test_impute(holed, strategy, x, n):
    params = impute.fit_imputer(holed, strategy)
    out = impute.apply_imputer(holed, params)
    row = out.where("id = 2").first()
    assert row["x"] == x and row["n"] == n and row["s"] == "a"
    assert out.where("id = 3").first()["x"] == x
    assert impute.remaining_missing(out) == 0
    assert {r["column"] for r in params.collect()} == {"x", "s", "n"}


def test_impute_constant_text_and_guards(holed):
    out = impute.apply_imputer(holed, impute.fit_imputer(holed, categorical="constant"))
    assert out.where("id = 2").first()["s"] == "Unknown"
    with pytest.raises(ValueError):
        impute.fit_imputer(holed, "forward_fill")


def knn_by_hand(x, k):
    out = x.copy()
    for i in range(len(x)):
        for j in np.flatnonzero(np.isnan(x[i])):
            found = []
            for d in range(len(x)):
                both = ~np.isnan(x[i]) & ~np.isnan(x[d])
                if d == i or np.isnan(x[d, j]) or not both.any():
                    continue
                found.append((math.sqrt(((x[i] - x[d])[both] ** 2).sum() * x.shape[1] / both.sum()), d))
            out[i, j] = np.mean([x[d, j] for _, d in sorted(found)[:k]]) if found else np.nanmean(x[:, j])
    return out


@pytest.mark.parametrize("holes,donors", [(20_000, 500_000), (7, 11)])
def test_knn_matches_brute_force_for_any_block_size(spark, holes, donors):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 3)).round(2)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[0] = np.nan  # nothing to measure a distance by
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    out = impute.knn_impute(df, "id", ["a", "b", "c"], holes_per_block=holes, donors_per_block=donors)
    got = np.array([[r["a"], r["b"], r["c"]] for r in out.orderBy("id").collect()])
    assert np.allclose(got, knn_by_hand(x, 5))


# ---- outliers -------------------------------------------------------------------------------


def test_outlier_actions(frame):
    df = frame([(float(v),) for v in (1, 2, 3, 4, 100)] + [(None,)], "x double")
    bounds = outliers.fit_outliers(df, ["x"])
    clipped = sorted(r["x"] for r in outliers.apply_outliers(df, bounds).collect() if r["x"] is not None)
    assert clipped == [1.0, 2.0, 3.0, 4.0, 7.0]
    assert outliers.apply_outliers(df, bounds).where("x IS NULL").count() == 1
    assert outliers.apply_outliers(df, bounds, "remove").count() == 4
    assert outliers.apply_outliers(df, bounds, "transform").where("x = 100").count() == 1
    logged = outliers.apply_outliers(df.na.drop(), bounds, "transform").agg(F.max("x")).first()[0]
    assert logged == pytest.approx(math.log(101))
    with pytest.raises(ValueError):
        outliers.fit_outliers(df, ["x"], "magic")
    with pytest.raises(ValueError):
        outliers.apply_outliers(df, bounds, "magic")


def test_isolation_scores_find_the_far_rows(spark):
    df = spark.range(2000).selectExpr(
        "id", "CASE WHEN id < 5 THEN 50.0D ELSE id * 37 % 101 / 101.0D END AS a", "id * 53 % 97 / 97.0D AS b"
    )
    forest = outliers.fit_isolation_forest(df, "id", ["a", "b"])
    scored = outliers.isolation_scores(df, ["a", "b"], forest)
    lowest = {r["id"] for r in scored.orderBy("score").limit(5).collect()}
    assert lowest == set(range(5))
    r = outliers.isolation_outliers(df, "id", ["a", "b"]).first()
    assert 150 <= r["outlier_count"] <= 200


# ---- encoding and scaling -------------------------------------------------------------------


def test_one_hot_unseen_missing_and_absent_levels(frame):
    train = frame([("b", 1), ("a", 2), ("c", 3)], "s string, n int")
    params = encode.fit_one_hot(train, ["s"])
    out = encode.apply_one_hot(frame([("z", 1), (None, 2), ("c", 3)], "s string, n int"), params)
    assert out.columns == ["n", "s_b", "s_c"]
    assert [(r["s_b"], r["s_c"]) for r in out.orderBy("n").collect()] == [(0, 0), (0, 0), (0, 1)]
    with pytest.raises(ValueError):
        encode.fit_one_hot(train, ["s"], limit=2)


def test_one_hot_cap(frame):
    df = frame([("a",)] * 5 + [("b",)] * 3 + [("c",)] + [("d",)], "s string")
    out = encode.apply_one_hot(df, encode.fit_one_hot(df, ["s"], max_categories=2))
    assert out.columns == ["s_b", "s_other"]
    assert out.agg(F.sum("s_b"), F.sum("s_other")).first() == (3, 2)


def test_label_encode_reports_what_it_cannot_map(frame):
    df = frame([("Y",), ("N",), ("?",), (None,)], "t string")
    assert [r["t"] for r in encode.label_encode(df, "t", "Y", "N").collect()] == [1, 0, None, None]
    assert {r["value"]: r["n"] for r in encode.unmapped_labels(df, "t", "Y", "N").collect()} == {"?": 1, None: 1}


def test_align_and_compare_columns(frame):
    df = frame([(1, 2)], "a int, b int")
    out = encode.align_columns(df, ["c", "b"])
    assert out.columns == ["c", "b"] and out.first() == (0, 2)
    with pytest.raises(CheckFailed):
        encode.require_same_features(df, df.select("b", "a"))


@pytest.mark.parametrize("method", scale.METHODS)
def test_scalers_invert_and_survive_constants(frame, method):
    df = frame([(1.0, 5.0, -4), (2.0, 5.0, 0), (6.0, 5.0, 2)], "x double, constant double, n int")
    params = scale.fit_scaler(df, ["x", "constant", "n", "gone"], method)
    assert {r["column"] for r in params.collect()} == {"x", "constant", "n"}
    out = scale.apply_scaler(df, params)
    back = scale.invert_scaler(out, params)
    for a, b in zip(df.collect(), back.collect()):
        assert tuple(a) == pytest.approx(tuple(b))
    scaled = [r["constant"] for r in out.collect()]
    assert scaled == ([1.0] * 3 if method == "maxabs" else [0.0] * 3)


def test_standard_scaler_uses_the_population_deviation(frame):
    df = frame([(1.0,), (2.0,), (6.0,)], "x double")
    assert scale.fit_scaler(df, ["x"]).first()["scale"] == pytest.approx(np.std([1, 2, 6]))
    with pytest.raises(ValueError):
        scale.fit_scaler(df, ["x"], "magic")
    with pytest.raises(ValueError):
        scale.apply_scaler(df, None)


# ---- features -------------------------------------------------------------------------------


def test_formulas(frame):
    df = frame([(1.0, 0.0, None), (0.0, 0.0, 2.0), (-3.0, 2.0, NAN)], "a double, b double, c double")
    specs = {
        "ratio": "a / b",
        "later": "ratio + 1",
        "missing": "a + c",
        "flag": features.FormulaSpec("a / b > 5", "int"),
        "mixed": "-abs(a) * 2 + (b - 1) / 4",
    }
    r = features.formula_features(df, specs).collect()
    assert [x["ratio"] for x in r] == [0.0, 0.0, -1.5]
    assert [x["later"] for x in r] == [1.0, 1.0, -0.5]
    assert [x["missing"] for x in r] == [0.0, 2.0, 0.0]
    assert [x["flag"] for x in r] == [1, 0, 0]  # 1/0 is infinite, 0/0 is missing
    assert [x["mixed"] for x in r] == [-2.25, -0.25, -5.75]


@pytest.mark.parametrize("bad", ["__import__('os')", "a.b", "a % 2", "open('x')", "b + gone", "'text'", "a if b else 1", "True"])
def test_formulas_refuse_everything_else(bad, spark):
    with pytest.raises((ValueError, SyntaxError)):
        formula_column(bad, {"a": F.col("a"), "b": F.col("b")})


def test_log_domain_is_checked(frame):
    df = frame([(0.0,), (-1.0,)], "a double")
    with pytest.raises(CheckFailed):
        features.fit_log(df, ["a"])
    with pytest.raises(CheckFailed):
        features.log_features(df, {"a": features.LogSpec("log1p")}, check=True)
    with pytest.raises(ValueError):
        features.log_features(df, {"a": features.LogSpec("ln2")})
    out = features.log_features(frame([(0.0,)], "a double"), {"a": features.LogSpec("log10", "_l", False)}, check=True)
    assert out.columns == ["a_l"] and out.first()[0] == pytest.approx(-8.0)


def test_polynomial_names_and_order(frame):
    terms = features.polynomial_terms
    spec = features.PolynomialSpec(["a", "b"])
    assert list(terms(spec)) == ["a", "b", "a^2", "a b", "b^2"]
    assert list(terms(replace(spec, degree=3)))[5:] == ["a^3", "a^2 b", "a b^2", "b^3"]
    assert list(terms(replace(spec, interaction_only=True, include_bias=True))) == ["1", "a", "b", "a b"]
    df = frame([(2.0, 3.0, "x")], "a double, b double, s string")
    assert features.polynomial_features(df, spec).columns == ["a", "b", "s", "a^2", "a b", "b^2"]
    moved = features.polynomial_features(df, replace(spec, keep_original=False))
    assert moved.columns == ["s", "a", "b", "a^2", "a b", "b^2"] and moved.first()["a b"] == 6.0


def test_feature_report_finds_each_fault(frame):
    df = frame(
        [(1.0, float("inf"), None, -1.0, 7.0), (2.0, 1.0, 2.0, 2.0, 7.0), (4.0, 2.0, 3.0, 3.0, 7.0)],
        "ok double, inf double, nan double, x_log double, same double",
    )
    r = by(features.feature_report(df, ["ok", "inf", "nan", "x_log", "same", "gone"], 10.0), "column")
    assert r["ok"]["severity"] == "OK" and len(r) == 5
    assert all(r[c]["severity"] == "FATAL" for c in ("inf", "nan", "x_log", "same"))
    with pytest.raises(CheckFailed):
        features.validate_features(df, ["same"])


def test_selection(spark):
    df = spark.range(200).selectExpr("id", "id * 1.0D AS a", "id * id * 1.0D AS b", "-id * 1.0D AS c", "0.05D * (id % 2) AS d")
    v = by(selection.variance_filter(df, ["a", "d"]), "column")
    assert v["a"]["kept"] and not v["d"]["kept"]
    c = by(selection.correlation_filter(df, ["a", "b", "c"], "id"), "column")
    assert c["a"]["kept"] and not c["b"]["kept"] and c["c"]["kept"]  # the sign counts
    t = df.withColumn("t", (F.col("a") > 100).cast("string"))
    m = by(selection.mutual_information(t, ["a", "d"], "t"), "column")
    assert m["a"]["mutual_information"] > 0.5 > 0.01 > m["d"]["mutual_information"]


# ---- the whole preparation ------------------------------------------------------------------

# fixed values: the expected order of the prepared features
EXPECTED = [
    "Dependents", "Applicant_Income", "Coapplicant_Income", "Loan_Amount", "Loan_Amount_Term", "Credit_History",
    "Applicant_Income_log", "Coapplicant_Income_log",
    "Total_Income", "Income_Ratio", "Loan_to_Income", "Income_per_Dependent",
    "Applicant_Income^2", "Applicant_Income Coapplicant_Income", "Applicant_Income Loan_Amount",
    "Coapplicant_Income^2", "Coapplicant_Income Loan_Amount", "Loan_Amount^2",
    "EMI", "Loan_Income_Ratio", "EMI_to_Income", "Has_Coapplicant", "Total_Experience", "Loan_Term_Years",
    "Married_Yes", "Education_Not Graduate", "Gender_Male", "Self_Employed_Yes",
    "Property_Area_Semiurban", "Property_Area_Urban",
]


def test_prepared_table_saved_and_loaded(spark, sf, tmp_path):
    from tallystone.plans.catalog.registry import loan

    df = loan(spark, sf)
    ready, fitted = prepare(df, loan_settings())
    names = [c for c in ready.columns if c not in ("Loan_Status", "split")]
    assert sorted(names) == sorted(EXPECTED) and names[:24] == EXPECTED[:24]
    train = ready.where("split = 'train'")
    stats = train.agg(F.avg("Loan_Amount"), F.stddev_pop("Loan_Amount")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1)
    assert fitted.shift.count() == 30
    save_prepared(ready, fitted, str(tmp_path / "out"), "run1")
    facts = {r["fact"]: r["value"] for r in spark.read.json(str(tmp_path / "out/metadata")).collect()}
    assert int(facts["train_rows"]) + int(facts["test_rows"]) == df.count()
    back = FittedPreparation.load(spark, str(tmp_path / "out/params"), loan_settings())
    a = fitted.apply(df).orderBy("Loan_Amount", "Applicant_Income").first()
    b = back.apply(df).orderBy("Loan_Amount", "Applicant_Income").first()
    assert a == b


def test_preparation_with_imputing_and_clipping(spark, sf):
    from tallystone.plans.catalog.registry import loan

    df = loan(spark, sf).withColumn("Loan_Amount", F.expr("CASE WHEN Customer_ID % 9 = 0 THEN NULL ELSE Loan_Amount END"))
    s = replace(loan_settings(), impute_numeric="median", outlier_method="iqr", outlier_columns=["Applicant_Income"])
    out = fit_preparation(df, s).apply(df)
    assert out.where(F.col("Loan_Amount").isNull()).count() == 0


def test_formula_functions(frame):
    import math

    df = frame([(4.0, 3.0), (-1.0, 2.0)], "a double, b double")
    known = {c: F.col(c) for c in "ab"}
    value = lambda text: [r[0] for r in df.select(formula_column(text, known)).collect()]
    assert value("a ** 2 + max(a, b, 1)") == [20.0, 3.0]
    assert value("min(a, b)") == [3.0, -1.0]
    assert value("sqrt(a)") == [2.0, None] and value("log(a)") == [math.log(4.0), None]
    assert value("exp(log1p(b))") == pytest.approx([4.0, 3.0])
    for bad in ("max(a)", "sqrt(a, b)", "abs()", "open(a)"):
        with pytest.raises(ValueError, match="not allowed"):
            formula_column(bad, known)


def test_selection_is_fitted_and_applied(frame):
    train = frame([(float(i), 1.0, float(2 * i), i) for i in range(20)], "a double, same double, twice double, id long")
    test = frame([(9.0, 5.0, 1.0, 1)], "a double, same double, twice double, id long")
    flat = selection.variance_filter(train, ["a", "same", "twice"])
    assert selection.keep_selected(test, flat).columns == ["a", "twice", "id"]
    near = selection.correlation_filter(train, ["a", "twice"], "id")
    assert selection.keep_selected(test, near).columns == ["a", "same", "id"]


def test_fitted_state_loads_from_its_folder_alone(spark, sf, tmp_path):
    settings = replace(loan_settings(), keep_key=True, outlier_method="iqr", outlier_columns=["Loan_Amount"], max_categories=2)
    df = loan(spark, sf)
    fitted = fit_preparation(df, settings)
    fitted.save(str(tmp_path / "p"))
    loaded = FittedPreparation.load(spark, str(tmp_path / "p"))
    assert loaded.settings == settings or loaded.settings == settings_from(json.loads(json.dumps(asdict(settings))))
    assert loaded.apply(df).exceptAll(fitted.apply(df)).count() == 0 and loaded.apply(df).columns == fitted.apply(df).columns
    row = spark.createDataFrame([(99, "{}")], "version int, settings string")
    row.write.mode("overwrite").json(str(tmp_path / "p/settings"))
    with pytest.raises(ValueError, match="version 99"):
        FittedPreparation.load(spark, str(tmp_path / "p"))


def test_one_hot_refuses_keys_without_a_word(spark):
    keys = spark.range(encode.MOST_CATEGORIES + 1).selectExpr("CAST(id AS STRING) AS k")
    with pytest.raises(ValueError, match="more than 1000"):
        encode.fit_one_hot(keys, ["k"])
    assert encode.fit_one_hot(keys, ["k"], limit=2000).count() == encode.MOST_CATEGORIES + 1
