"""Splits, imputation, outlier actions, encoding, scaling and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.operators import (
    encode,
    features,
    impute,
    outliers,
    resample,
    scale,
    selection,
    split,
)
from tallystone.operators.selectors import alias_all
from tallystone.plans.catalog.registry import (
    LINE_NUMBERS,
    LINEITEM_HOLES,
    LOAN,
    LOAN_NUMBERS,
    lineitem_holes,
    loan,
    per_column,
    query,
    rounded,
    table,
)
from tallystone.plans.prepare import loan_settings, prepare

ORDER = "md5(concat(CAST(o_orderkey AS VARCHAR), '-42'))"
# class sizes in train: proportional, largest remainders first
SHARES = """
counts AS (SELECT {label} AS cls, count(*) AS n FROM orders GROUP BY 1),
total AS (SELECT sum(n) AS n, sum(n) - ceil(0.2 * sum(n)) AS n_train FROM counts),
exact AS (SELECT cls, counts.n, counts.n * n_train / total.n AS x, n_train FROM counts, total),
ranked AS (SELECT *, row_number() OVER (ORDER BY x - floor(x) DESC, cls) AS pos,
  n_train - sum(floor(x)) OVER () AS spare FROM exact),
share AS (SELECT cls, floor(x) + CASE WHEN pos <= spare THEN 1 ELSE 0 END AS k FROM ranked)
"""


@query(
    "stratified_split",
    f"""WITH {SHARES.format(label="o_orderstatus")},
    r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ORDER}) AS rn FROM orders)
    SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= k THEN 'train' ELSE 'test' END AS split
    FROM r JOIN share ON cls = o_orderstatus""",
)
def stratified_split(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(df, "o_orderkey", "o_orderstatus")


@query(
    "unstratified_split",
    f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY {ORDER}) AS rn, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, CASE WHEN rn <= n - ceil(0.2 * n) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def unstratified_split(spark, sf):
    df = table(spark, sf, "orders")
    return split.stratified_split(df, "o_orderkey", "o_orderstatus", stratify=False).select("o_orderkey", "split")


@query(
    "ordered_split",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, CASE WHEN rn <= n - ceil(0.2 * n) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def ordered_split(spark, sf):
    df = table(spark, sf, "orders")
    cut = split.stratified_split(df, "o_orderkey", "o_orderstatus", stratify=False, shuffle=False)
    return cut.select("o_orderkey", "split")


@query(
    "ordered_split_decimal_key",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey / 10 AS tenth, CASE WHEN rn <= n - ceil(0.2 * n) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def ordered_split_decimal_key(spark, sf):
    df = table(spark, sf, "orders").selectExpr("o_orderkey / 10 AS tenth", "o_orderstatus")
    return split.stratified_split(df, "tenth", "o_orderstatus", stratify=False, shuffle=False).select("tenth", "split")


@query(
    "split_summary",
    f"""WITH {SHARES.format(label="o_orderstatus")},
    r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ORDER}) AS rn FROM orders)
    SELECT CASE WHEN rn <= k THEN 'train' ELSE 'test' END AS split, o_orderstatus AS class, count(*) AS n,
      CAST(2 AS BIGINT) AS n_features
    FROM r JOIN share ON cls = o_orderstatus GROUP BY 1, 2""",
)
def split_summary(spark, sf):
    cut = split.stratified_split(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus")
    return split.split_summary(cut, ["o_totalprice", "o_orderpriority"], "o_orderstatus")


@query(
    "stratified_folds",
    f"""WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ORDER}) AS rn,
      count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    SELECT o_orderkey, o_orderstatus,
      CAST((SELECT count(*) FROM generate_series(1, 9) t(i) WHERE rn > (n * i) // 10) AS INT) AS fold FROM r""",
)
def stratified_folds(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_folds(df, "o_orderkey", "o_orderstatus")


@query(
    "under_sample",
    f"""WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ORDER}) AS rn FROM orders),
    m AS (SELECT min(n) AS least FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus))
    SELECT o_orderkey, o_orderstatus FROM r, m WHERE rn <= least""",
)
def under_sample(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.under_sample(df, "o_orderkey", "o_orderstatus")


@query(
    "class_weights",
    """WITH c AS (SELECT quality AS class, count(*) AS n FROM labels GROUP BY 1)
    SELECT class, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c""",
)
def class_weights(spark, sf):
    return rounded(split.class_weights(table(spark, sf, "labels"), "quality"), 6)


# ---- imputation -----------------------------------------------------------------------------

HOLED = ["l_tax_n", "l_quantity_n", "l_returnflag_n"]


def impute_sql(number: str, text: str = "(SELECT mode_value FROM m)") -> str:
    return f"""WITH src AS ({LINEITEM_HOLES}),
    m AS (SELECT l_returnflag_n AS mode_value FROM src WHERE l_returnflag_n IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    f AS (SELECT {number.format(c="l_tax_n")} AS tax, {number.format(c="l_quantity_n")} AS quantity FROM src)
    SELECT l_orderkey, l_linenumber, round(coalesce(l_tax_n, tax), 6) AS l_tax_n,
      round(coalesce(l_quantity_n, quantity), 6) AS l_quantity_n, coalesce(l_returnflag_n, {text}) AS l_returnflag_n
    FROM src, f"""


def _imputed(spark, sf, numeric, categorical="mode"):
    df = lineitem_holes(spark, sf).select("l_orderkey", "l_linenumber", *HOLED)
    params = impute.fit_imputer(df, numeric, categorical)
    return rounded(impute.apply_imputer(df, params), 6)


@query("impute_mean", impute_sql("avg({c})"))
def impute_mean(spark, sf):
    return _imputed(spark, sf, "mean")


@query("impute_median", impute_sql("quantile_cont({c}, 0.5)"))
def impute_median(spark, sf):
    return _imputed(spark, sf, "median")


@query(
    "impute_mode",
    impute_sql("(SELECT {c} FROM src WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)").replace(
        " AS quantity FROM src)", " AS quantity)"
    ),
)
def impute_mode(spark, sf):
    return _imputed(spark, sf, "mode")


@query("impute_constant", impute_sql("any_value(0.0)", "'Unknown'"))
def impute_constant(spark, sf):
    return _imputed(spark, sf, "constant", "constant")


@query(
    "missing_counts",
    f"""WITH m AS ({per_column(HOLED, "count(*) - count({c}) AS k, count(*) AS n", f"({LINEITEM_HOLES})")})
    SELECT "column", k AS missing_count, round(k * 100.0 / n, 2) AS missing_percent,
      CASE WHEN "column" = 'l_returnflag_n' THEN 'string' ELSE 'double' END AS dtype FROM m WHERE k > 0""",
)
def missing_counts(spark, sf):
    return rounded(impute.missing_counts(lineitem_holes(spark, sf), HOLED))


PART_HOLES = "SELECT p_partkey, p_retailprice, CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE p_size END AS p_size FROM {part}"


@query(
    "knn_impute",
    f"""WITH src AS ({PART_HOLES.format(part="part")}),
    near AS (SELECT a.p_partkey, b.p_size, row_number() OVER (PARTITION BY a.p_partkey
               ORDER BY sqrt(2 * pow(a.p_retailprice - b.p_retailprice, 2)), b.p_partkey) AS pos
             FROM src a JOIN src b ON a.p_size IS NULL AND b.p_size IS NOT NULL),
    fill AS (SELECT p_partkey, avg(p_size) AS v FROM near WHERE pos <= 5 GROUP BY 1)
    SELECT p_partkey, p_retailprice, round(coalesce(CAST(p_size AS DOUBLE), v), 4) AS p_size
    FROM src LEFT JOIN fill USING (p_partkey)""",
)
def knn_impute(spark, sf):
    df = spark.sql(PART_HOLES, part=table(spark, sf, "part"))
    return rounded(impute.knn_impute(df, "p_partkey", ["p_retailprice", "p_size"]))


SMOTE_ROW = f"[{', '.join(f'CAST({c} AS DOUBLE)' for c in LOAN_NUMBERS)}]"
SMOTE_GAP = " + ".join(f"(a.x[{i}] - b.x[{i}]) * (a.x[{i}] - b.x[{i}])" for i in range(1, len(LOAN_NUMBERS) + 1))
SMOTE_HEX = "list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(range(1, {n} + 1), lambda i: CAST(instr('123456789abcdef', {h}[i]) AS BIGINT))), lambda a, b: a * 16 + b)"


@query(
    "smote",
    f"""WITH loan AS ({LOAN}),
    sizes AS (SELECT Loan_Status AS c, count(*) AS n, max(count(*)) OVER () AS most FROM loan GROUP BY 1),
    small AS MATERIALIZED (SELECT Customer_ID AS id, Loan_Status AS c, {SMOTE_ROW} AS x, most - n AS need, n,
      row_number() OVER (PARTITION BY Loan_Status ORDER BY md5(CAST(Customer_ID AS VARCHAR) || '-42')) AS pos
      FROM loan JOIN sizes ON c = Loan_Status WHERE n < most),
    base AS (SELECT *, need // n + CASE WHEN pos <= need % n THEN 1 ELSE 0 END AS copies FROM small),
    near AS (SELECT a.id, list(b.id ORDER BY sqrt({SMOTE_GAP}), b.id)[1:5] AS ids
      FROM base a JOIN small b ON a.c = b.c AND a.id <> b.id WHERE copies > 0 GROUP BY a.id),
    made AS (SELECT base.id, c, x, ids, unnest(range(1, copies + 1)) AS copy FROM base JOIN near USING (id) WHERE copies > 0),
    drawn AS (SELECT *, md5(id || '-' || copy || '-42-neighbour') AS h1, md5(id || '-' || copy || '-42-gap') AS h2 FROM made),
    picked AS (SELECT drawn.*, ids[1 + {SMOTE_HEX.format(n=15, h="h1")} % len(ids)] AS other, {SMOTE_HEX.format(n=13, h="h2")} / pow(16, 13) AS gap FROM drawn)
    SELECT p.c AS Loan_Status, {", ".join(f"round(p.x[{i + 1}] + gap * (o.x[{i + 1}] - p.x[{i + 1}]), 4) AS {c}" for i, c in enumerate(LOAN_NUMBERS))},
      p.id AS base, other AS neighbour, CAST(copy AS INTEGER) AS copy, round(gap, 6) AS gap
    FROM picked p JOIN small o ON o.id = other""",
)
def smote(spark, sf):
    made = resample.smote(loan(spark, sf), "Customer_ID", "Loan_Status", LOAN_NUMBERS)
    return rounded(rounded(made, 4, LOAN_NUMBERS), 6, ["gap"])


# ---- outliers -------------------------------------------------------------------------------

BOUNDS = """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
"""


def _events(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return df, outliers.fit_outliers(df, ["value"])


@query(
    "clip_outliers",
    BOUNDS
    + "SELECT event_id, round(CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6) AS value FROM events, b",
)
def clip_outliers(spark, sf):
    df, bounds = _events(spark, sf)
    return rounded(outliers.apply_outliers(df, bounds, "clip"), 6)


@query("remove_outliers", BOUNDS + "SELECT event_id, value FROM events, b WHERE value BETWEEN lo AND hi")
def remove_outliers(spark, sf):
    df, bounds = _events(spark, sf)
    return outliers.apply_outliers(df, bounds, "remove")


@query("log_outliers", "SELECT event_id, round(ln(1 + value), 6) AS value FROM events")
def log_outliers(spark, sf):
    df, bounds = _events(spark, sf)
    return rounded(outliers.apply_outliers(df, bounds, "transform"), 6)


@query(
    "clip_zscore",
    """WITH s AS (SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi FROM events)
    SELECT event_id, round(CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6) AS value FROM events, s""",
)
def clip_zscore(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return rounded(outliers.apply_outliers(df, outliers.fit_outliers(df, ["value"], "zscore")), 6)


@query("isolation_forest")
def isolation_forest(spark, sf):
    return outliers.isolation_outliers(loan(spark, sf), "Customer_ID", LOAN_NUMBERS)


# ---- encoding and scaling -------------------------------------------------------------------


@query(
    "one_hot",
    "SELECT Customer_ID, "
    + ", ".join(
        f"CAST({c} = '{v}' AS INT) AS \"{c}_{v}\""
        for c, v in (
            ("Married", "Yes"),
            ("Education", "Not Graduate"),
            ("Property_Area", "Semiurban"),
            ("Property_Area", "Urban"),
        )
    )
    + f" FROM ({LOAN})",
)
def one_hot(spark, sf):
    df = loan(spark, sf).select("Customer_ID", "Married", "Education", "Property_Area")
    params = encode.fit_one_hot(df, ["Married", "Education", "Property_Area"])
    return encode.apply_one_hot(df, params)


@query(
    "one_hot_capped",
    """WITH top AS (SELECT p_type AS v FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3),
    names AS (SELECT v, row_number() OVER (ORDER BY v) AS pos FROM (SELECT v FROM top UNION ALL SELECT 'other')),
    e AS (SELECT p_partkey, CASE WHEN p_type IN (SELECT v FROM top) THEN p_type ELSE 'other' END AS v FROM part)
    SELECT p_partkey, CAST(pos = 2 AS INT) AS second, CAST(pos = 3 AS INT) AS third, CAST(pos = 4 AS INT) AS fourth
    FROM e JOIN names USING (v)""",
)
def one_hot_capped(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_type")
    out = encode.apply_one_hot(df, encode.fit_one_hot(df, ["p_type"], max_categories=3))
    return alias_all(out, dict(zip(out.columns[1:], ("second", "third", "fourth"))))


@query(
    "label_encode",
    f"SELECT Customer_ID, CASE Loan_Status WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS Loan_Status FROM ({LOAN})",
)
def label_encode(spark, sf):
    return encode.label_encode(loan(spark, sf).select("Customer_ID", "Loan_Status"), "Loan_Status", "Y", "N")


@query(
    "unmapped_labels",
    "SELECT o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
)
def unmapped_labels(spark, sf):
    return encode.unmapped_labels(table(spark, sf, "orders"), "o_orderstatus", "F", "O")


@query("align_columns", "SELECT p_size, CAST(0 AS INT) AS p_weight, p_partkey FROM part")
def align_columns(spark, sf):
    return encode.align_columns(table(spark, sf, "part"), ["p_size", "p_weight", "p_partkey"])


def scale_sql(center: str, spread: str) -> str:
    stats = ", ".join(
        f"{center.format(c=c)} AS c_{c}, coalesce(nullif({spread.format(c=c)}, 0), 1) AS s_{c}" for c in LINE_NUMBERS
    )
    cols = ", ".join(f"round(({c} - c_{c}) / s_{c}, 6) + 0.0 AS {c}" for c in LINE_NUMBERS)
    return f"WITH s AS (SELECT {stats} FROM lineitem) SELECT l_orderkey, l_linenumber, {cols} FROM lineitem, s"


def _scaled(spark, sf, method):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return df, scale.fit_scaler(df, LINE_NUMBERS, method)


@query("scale_standard", scale_sql("avg({c})", "stddev_pop({c})"))
def scale_standard(spark, sf):
    return rounded(scale.apply_scaler(*_scaled(spark, sf, "standard")), 6)


@query("scale_minmax", scale_sql("min({c})", "max({c}) - min({c})"))
def scale_minmax(spark, sf):
    return rounded(scale.apply_scaler(*_scaled(spark, sf, "minmax")), 6)


@query(
    "scale_robust",
    scale_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
)
def scale_robust(spark, sf):
    return rounded(scale.apply_scaler(*_scaled(spark, sf, "robust")), 6)


@query("scale_maxabs", scale_sql("0", "max(abs({c}))"))
def scale_maxabs(spark, sf):
    return rounded(scale.apply_scaler(*_scaled(spark, sf, "maxabs")), 6)


@query(
    "scale_inverse",
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round({c}, 6) AS {c}" for c in LINE_NUMBERS) + " FROM lineitem",
)
def scale_inverse(spark, sf):
    df, params = _scaled(spark, sf, "standard")
    return rounded(scale.invert_scaler(scale.apply_scaler(df, params), params), 6)


@query(
    "scaler_params",
    per_column(
        LINE_NUMBERS,
        "'standard' AS method, round(avg({c}), 6) AS center, round(stddev_pop({c}), 6) AS scale",
        "lineitem",
    ),
)
def scaler_params(spark, sf):
    return rounded(_scaled(spark, sf, "standard")[1], 6)


# ---- features -------------------------------------------------------------------------------

A, C, L, D, TERM = "Applicant_Income", "Coapplicant_Income", "Loan_Amount", "Dependents", "Loan_Amount_Term"
LOGS = {f"{A}_log": f"ln(1 + {A})", f"{C}_log": f"ln(1 + {C})"}
INTERACTIONS = {
    "Total_Income": f"{A} + {C}",
    "Income_Ratio": f"{A} / ({C} + 1)",
    "Loan_to_Income": f"{L} / ({A} + {C} + 1)",
    "Income_per_Dependent": f"({A} + {C}) / ({D} + 1)",
}
POLYNOMIAL = {
    f"{A}^2": f"{A} * {A}",
    f"{A} {C}": f"{A} * {C}",
    f"{A} {L}": f"{A} * {L}",
    f"{C}^2": f"{C} * {C}",
    f"{C} {L}": f"{C} * {L}",
    f"{L}^2": f"{L} * {L}",
}
DOMAIN = {
    "EMI": f"{L} / {TERM}",
    "Loan_Income_Ratio": f"{L} / ({A} + {C} + 1)",
    "EMI_to_Income": f"({L} / {TERM}) / ({A} / 12 + {C} / 12 + 1)",
    "Has_Coapplicant": f"CASE WHEN {C} > 0 THEN 1 ELSE 0 END",
    "Total_Experience": f"{A} / 1000",
    "Loan_Term_Years": f"{TERM} / 12",
}
LOAN_PLAN = loan_settings().feature_plan


def feature_cells(columns: dict[str, str]) -> str:
    """Plain arithmetic gives the same bits in both engines; only logarithms are rounded."""
    return ", ".join(f'round({e}, 6) AS "{n}"' if n in LOGS else f'{e} AS "{n}"' for n, e in columns.items())


def feature_sql(columns: dict[str, str]) -> str:
    return f"SELECT Customer_ID, {feature_cells(columns)} FROM ({LOAN})"


def _picked(df, names):
    return df.select("Customer_ID", *[F.col(f"`{n}`") for n in names])


@query("log_features", feature_sql(LOGS))
def log_features(spark, sf):
    df = loan(spark, sf)
    features.fit_log(df, list(LOAN_PLAN.logs))
    return rounded(_picked(features.log_features(df, LOAN_PLAN.logs, check=True), LOGS), 6)


@query(
    "log_methods",
    "SELECT Customer_ID, round(ln(Loan_Amount + 1e-8), 6) AS Loan_Amount_ln,"
    f" round(log10(Loan_Amount_Term + 1e-8), 6) AS Loan_Amount_Term_l10 FROM ({LOAN})",
)
def log_methods(spark, sf):
    specs = {
        "Loan_Amount": features.LogSpec("log", "_ln"),
        "Loan_Amount_Term": features.LogSpec("log10", "_l10"),
    }
    out = features.log_features(loan(spark, sf), specs)
    return rounded(_picked(out, ["Loan_Amount_ln", "Loan_Amount_Term_l10"]), 6)


@query("interactions", feature_sql(INTERACTIONS))
def interactions(spark, sf):
    out = features.formula_features(loan(spark, sf), LOAN_PLAN.interactions)
    return _picked(out, INTERACTIONS)


@query("polynomial", feature_sql(POLYNOMIAL))
def polynomial(spark, sf):
    out = features.polynomial_features(loan(spark, sf), LOAN_PLAN.polynomial)
    return _picked(out, POLYNOMIAL)


@query("domain_features", feature_sql(DOMAIN))
def domain_features(spark, sf):
    return _picked(features.formula_features(loan(spark, sf), LOAN_PLAN.domain), DOMAIN)


@query(
    "formula_zero_division",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0 THEN 0 ELSE l_discount / l_tax END AS rate,
      CAST(l_quantity >= 25 AS INT) AS large, abs(l_discount - l_tax) * 2 AS gap FROM lineitem""",
)
def formula_zero_division(spark, sf):
    specs = {
        "rate": "l_discount / l_tax",
        "large": features.FormulaSpec("l_quantity >= 25", "int"),
        "half_gap": "abs(l_discount - l_tax)",
        "gap": "half_gap * 2",
    }
    out = features.formula_features(table(spark, sf, "lineitem"), specs)
    return out.select("l_orderkey", "l_linenumber", "rate", "large", "gap")


ENGINEERED = LOGS | INTERACTIONS | DOMAIN


@query(
    "feature_report",
    f"""WITH f AS (SELECT {", ".join(f"{e} AS {n}" for n, e in ENGINEERED.items())} FROM ({LOAN})),
    r AS ({per_column(
        ENGINEERED,
        "CAST(0 AS BIGINT) AS n_inf, count(*) - count({c}) AS n_missing, CAST(0 AS BIGINT) AS n_negative_log,"
        " round(skewness({c}), 4) AS skewness, min({c}) = max({c}) AS is_constant, round(avg({c}), 4) AS mean,"
        " round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(max({c}), 4) AS max",
        "f",
    )})
    SELECT *, CASE WHEN n_missing > 0 OR is_constant THEN 'FATAL' WHEN abs(skewness) > 1 THEN 'WARNING' ELSE 'OK' END AS severity
    FROM r""",
)
def feature_report(spark, sf):
    ready = LOAN_PLAN.apply(loan(spark, sf))
    return rounded(features.feature_report(ready, list(ENGINEERED)))


ALL_FEATURES = LOGS | INTERACTIONS | POLYNOMIAL | DOMAIN


@query("feature_plan", feature_sql(ALL_FEATURES))
def feature_plan(spark, sf):
    out = LOAN_PLAN.fit(loan(spark, sf)).apply(loan(spark, sf))
    return rounded(_picked(out, ALL_FEATURES), 6, list(LOGS))


SCALED = ["Dependents", A, C, L, TERM]
ONE_HOT = [
    ("Married", "Yes"),
    ("Education", "Not Graduate"),
    ("Gender", "Male"),
    ("Self_Employed", "Yes"),
    ("Property_Area", "Semiurban"),
    ("Property_Area", "Urban"),
]


@query(
    "prepared_loans",
    f"""WITH loan AS ({LOAN}),
    counts AS (SELECT Loan_Status AS cls, count(*) AS n FROM loan GROUP BY 1),
    total AS (SELECT sum(n) AS n, sum(n) - ceil(0.2 * sum(n)) AS n_train FROM counts),
    exact AS (SELECT cls, counts.n * n_train / total.n AS x, n_train FROM counts, total),
    ranked AS (SELECT *, row_number() OVER (ORDER BY x - floor(x) DESC, cls) AS pos, n_train - sum(floor(x)) OVER () AS spare FROM exact),
    share AS (SELECT cls, floor(x) + CASE WHEN pos <= spare THEN 1 ELSE 0 END AS k FROM ranked),
    r AS (SELECT *, row_number() OVER (PARTITION BY Loan_Status
            ORDER BY md5(concat(CAST(Customer_ID AS VARCHAR), '-42'))) AS rn FROM loan),
    s AS (SELECT r.*, CASE WHEN rn <= k THEN 'train' ELSE 'test' END AS split FROM r JOIN share ON cls = Loan_Status),
    p AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)} FROM s WHERE split = 'train')
    SELECT {", ".join(f"round(({c} - m_{c}) / s_{c}, 4) + 0.0 AS {c}" for c in SCALED)}, Credit_History,
      {feature_cells(ALL_FEATURES)},
      {", ".join(f"CAST({c} = '{v}' AS INT) AS \"{c}_{v}\"" for c, v in ONE_HOT)},
      CASE Loan_Status WHEN 'Y' THEN 1 ELSE 0 END AS Loan_Status, split
    FROM s, p""",
)
def prepared_loans(spark, sf):
    ready, _ = prepare(loan(spark, sf), loan_settings())
    return rounded(rounded(ready, 4, SCALED), 6, list(LOGS))


# ---- selection ------------------------------------------------------------------------------


@query(
    "variance_filter",
    per_column(LINE_NUMBERS, "round(var_pop({c}), 4) AS variance, var_pop({c}) > 0.01 AS kept", "lineitem"),
)
def variance_filter(spark, sf):
    return rounded(selection.variance_filter(table(spark, sf, "lineitem"), LINE_NUMBERS))


RATED = "SELECT *, l_extendedprice * 2 AS double_price FROM {lineitem}"
FILTERED = ["l_quantity", "l_extendedprice", "double_price", "l_discount"]


def _rank(c: str) -> str:
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"


@query(
    "correlation_filter",
    f"""WITH r AS (SELECT {", ".join(_rank(c) for c in FILTERED)} FROM ({RATED.format(lineitem="lineitem")})),
    m AS ({" UNION ALL ".join(
        f"SELECT '{y}' AS \"column\", "
        + (f"greatest({', '.join(f'corr({x}, {y})' for x in FILTERED[:i])})" if i else "CAST(NULL AS DOUBLE)")
        + " AS rho FROM r"
        for i, y in enumerate(FILTERED)
    )})
    SELECT "column", round(any_value(rho), 6) AS max_correlation, coalesce(any_value(rho) <= 0.95, true) AS kept
    FROM m GROUP BY 1""",
)
def correlation_filter(spark, sf):
    df = spark.sql(RATED, lineitem=table(spark, sf, "lineitem"))
    return rounded(selection.correlation_filter(df, FILTERED), 6)


@query(
    "mutual_information",
    """WITH q AS (SELECT DISTINCT unnest(quantile_cont(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM lineitem),
    v AS (SELECT l_extendedprice, l_returnflag FROM lineitem),
    b AS (SELECT count(*) FILTER (WHERE e < l_extendedprice) AS bin, l_returnflag AS t, n FROM
      (SELECT l_extendedprice, l_returnflag, count(*) AS n FROM v GROUP BY 1, 2), q GROUP BY l_extendedprice, l_returnflag, n),
    o AS (SELECT bin, t, sum(n) AS o FROM b GROUP BY 1, 2),
    m AS (SELECT *, sum(o) OVER (PARTITION BY bin) AS r, sum(o) OVER (PARTITION BY t) AS c, sum(o) OVER () AS n FROM o)
    SELECT 'l_extendedprice' AS "column", round(sum(o / n * ln(CAST(o AS DOUBLE) * n / (CAST(r AS DOUBLE) * c))), 8) AS mutual_information FROM m""",
)
def mutual_information(spark, sf):
    df = table(spark, sf, "lineitem")
    return rounded(selection.mutual_information(df, ["l_extendedprice"], "l_returnflag"), 8)
