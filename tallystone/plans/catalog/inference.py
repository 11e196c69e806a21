"""Confidence intervals, group tests, association, drift and correlation.

The SQL side computes tail probabilities by summing the density over a fixed
grid, independently of the series and fractions the operators use.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.functions import normality
from tallystone.operators import association, compare, correlation, drift
from tallystone.plans.catalog.registry import (
    LINE_NUMBERS,
    LINEITEM_HOLES,
    LOAN,
    LOAN_CATEGORIES,
    LOAN_NUMBERS,
    NODES,
    chi2_tail,
    f_tail,
    lineitem_holes,
    loan,
    long_texts,
    long_values,
    normal_tail,
    query,
    rounded,
    t_tail,
    table,
)

LINES = f"long AS ({long_values(LINE_NUMBERS, 'lineitem', 'l_linestatus AS g')})"
EFFECT_D = "CASE WHEN d < 0.2 THEN 'negligible' WHEN d < 0.5 THEN 'small' WHEN d < 0.8 THEN 'medium' ELSE 'large' END"
EFFECT_V = "CASE WHEN v < 0.1 THEN 'negligible' WHEN v < 0.3 THEN 'small' WHEN v < 0.5 THEN 'medium' ELSE 'large' END"

# z is the 0.975 normal quantile; the expansion of the t quantile is exact to 1e-10 at these sizes
T_QUANTILE = "(z + (z*z*z + z) / (4 * v) + (5*z*z*z*z*z + 16*z*z*z + 3*z) / (96 * v * v))"


@query(
    "confidence_intervals",
    f"""WITH {LINES},
    s AS (SELECT "column", count(*) AS n, avg(value) AS m, stddev_samp(value) AS s, CAST(count(*) - 1 AS DOUBLE) AS v,
          CAST(1.959963984540054 AS DOUBLE) AS z FROM long GROUP BY 1),
    c AS (SELECT *, {T_QUANTILE} * s / sqrt(n) AS margin FROM s)
    SELECT "column", round(round(m, 4), 3) AS mean, round(round(m - margin, 4), 3) AS lower_bound,
      round(round(m + margin, 4), 3) AS upper_bound, round(round(margin, 4), 3) AS margin_of_error, n AS sample_size, CAST(0.95 AS DOUBLE) AS confidence_level FROM c""",
)
def confidence_intervals(spark, sf):
    # the operator's own 4 decimals may split a tie the other way than SQL does
    return rounded(compare.confidence_intervals(table(spark, sf, "lineitem"), LINE_NUMBERS), 3)


@query(
    "group_moments",
    f"""WITH {LINES} SELECT g AS "group", "column", count(*) AS n, round(avg(value), 4) AS mean,
      round(stddev_samp(value), 4) AS std FROM long GROUP BY 1, 2""",
)
def group_moments(spark, sf):
    return rounded(compare.group_moments(table(spark, sf, "lineitem"), LINE_NUMBERS, "l_linestatus"))


TWO_MOMENTS = """
s AS (SELECT "column", count(*) FILTER (WHERE g = '{a}') AS n1, count(*) FILTER (WHERE g = '{b}') AS n2,
      avg(value) FILTER (WHERE g = '{a}') AS m1, avg(value) FILTER (WHERE g = '{b}') AS m2,
      stddev_samp(value) FILTER (WHERE g = '{a}') AS s1, stddev_samp(value) FILTER (WHERE g = '{b}') AS s2
      FROM long GROUP BY 1),
e AS (SELECT *, abs(m1 - m2) / sqrt((s1*s1 + s2*s2) / 2) AS d, s1*s1/n1 AS v1, s2*s2/n2 AS v2 FROM s)
"""
TWO_COLUMNS = f"""round(m1, 4) AS group1_mean, round(m2, 4) AS group2_mean, round(s1, 4) AS group1_std,
  round(s2, 4) AS group2_std, n1 AS group1_n, n2 AS group2_n, round(stat, 4) AS statistic,
  round(p, 6) AS p_value, p < 0.05 AS significant, round(d, 4) AS cohens_d, {EFFECT_D} AS effect"""


@query(
    "welch_ttest",
    f"""WITH {LINES}, {NODES}, {TWO_MOMENTS.format(a="F", b="O")},
    t AS (SELECT *, (m1 - m2) / sqrt(v1 + v2) AS stat,
          (v1 + v2) * (v1 + v2) / (v1*v1/(n1-1) + v2*v2/(n2-1)) AS v FROM e),
    p AS (SELECT "column", 2 * {t_tail("abs(stat)", "v")} AS p FROM t, nodes GROUP BY 1)
    SELECT "column", 'Welch''s t-test' AS test_type, {TWO_COLUMNS} FROM t JOIN p USING ("column")""",
)
def welch_ttest(spark, sf):
    df = table(spark, sf, "lineitem")
    return rounded(compare.two_group_compare(df, LINE_NUMBERS, "l_linestatus", "F", "O", test="welch"), 6)


RANKS = """
r AS (SELECT "column", value, g, rank() OVER (PARTITION BY "column" ORDER BY value)
        + (count(*) OVER (PARTITION BY "column", value) - 1) / 2.0 AS rk FROM long),
ties AS (SELECT "column", sum(CAST(t AS DOUBLE) * t * t - t) AS tie FROM
         (SELECT "column", value, count(*) AS t FROM long GROUP BY 1, 2) GROUP BY 1)
"""
U_TEST = """
u AS (SELECT "column", sum(rk) FILTER (WHERE g = '{a}') - any_value(n1) * (any_value(n1) + 1) / 2.0 AS stat
      FROM r JOIN s USING ("column") GROUP BY 1),
z AS (SELECT *, CAST(n1 AS DOUBLE) * n2 AS nn, CAST(n1 + n2 AS DOUBLE) AS n FROM e JOIN u USING ("column") JOIN ties USING ("column")),
zz AS (SELECT *, (greatest(stat, nn - stat) - nn / 2 - 0.5) / sqrt(nn / 12 * (n + 1 - tie / (n * (n - 1)))) AS zed FROM z)
"""


@query(
    "mann_whitney",
    f"""WITH {LINES}, {NODES}, {TWO_MOMENTS.format(a="F", b="O")}, {RANKS}, {U_TEST.format(a="F")},
    p AS (SELECT "column", least(1, 2 * {normal_tail("zed")}) AS p FROM zz, nodes GROUP BY 1)
    SELECT "column", 'Mann-Whitney U' AS test_type, {TWO_COLUMNS} FROM zz JOIN p USING ("column")""",
)
def mann_whitney(spark, sf):
    df = table(spark, sf, "lineitem")
    return rounded(compare.two_group_compare(df, LINE_NUMBERS, "l_linestatus", "F", "O", test="rank"), 6)


@query(
    "two_group_min_size",
    f"""WITH long AS ({long_values(["l_quantity", "l_quantity_n"], f"({LINEITEM_HOLES})", "l_linestatus AS g")}),
    {NODES}, {TWO_MOMENTS.format(a="F", b="O")},
    t AS (SELECT *, (m1 - m2) / sqrt(v1 + v2) AS stat,
          (v1 + v2) * (v1 + v2) / (v1*v1/(n1-1) + v2*v2/(n2-1)) AS v FROM e WHERE least(n1, n2) >= 2500),
    p AS (SELECT "column", 2 * {t_tail("abs(stat)", "v")} AS p FROM t, nodes GROUP BY 1)
    SELECT "column", 'Welch''s t-test' AS test_type, {TWO_COLUMNS} FROM t JOIN p USING ("column")""",
)
def two_group_min_size(spark, sf):
    columns = ["l_quantity", "l_quantity_n"]
    found = compare.two_group_compare(lineitem_holes(spark, sf), columns, "l_linestatus", "F", "O", test="welch", min_size=2500)
    return rounded(found, 6)


# ---- the normality gate: the same 5000 rows a group, Royston's statistic, then the test it picks ----

# fixed values: the rational pieces of the published normal quantile AS 241, highest power first
QUANTILE_CENTRE = (
    [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608],
    [5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867, 5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0],
)
QUANTILE_SIDE = (
    [7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258, 3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734],
    [1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459, 0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0],
)


def polynomial(coefficients, x: str) -> str:
    """By Horner's rule, highest power first."""
    text = repr(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r})"
    return text


def rational(pieces, x: str) -> str:
    return f"({polynomial(pieces[0], x)} / {polynomial(pieces[1], x)})"


def royston(source: str, rows: str) -> str:
    """Subqueries up to ``sw ("column", g, n, w, p)`` over ``source ("column", g, value, hash)``; ``rows`` is a group's sample size."""
    weight = lambda name, u: polynomial(list(reversed(getattr(normality, name))), u)
    return f"""
    counted AS (SELECT "column", g, count(*) AS n_all FROM {source} GROUP BY 1, 2),
    limits AS (SELECT "column", g, CAST({rows} AS BIGINT) AS k FROM counted),
    ordered AS (SELECT "column", g, value, row_number() OVER (PARTITION BY "column", g ORDER BY hash) AS pos FROM {source}),
    picked AS (SELECT o."column", o.g, value, k AS n, row_number() OVER (PARTITION BY o."column", o.g ORDER BY value) AS i
               FROM ordered o JOIN limits USING ("column", g) WHERE pos <= k),
    shares AS (SELECT *, (i - 0.375) / (n + 0.25) - 0.5 AS q FROM picked),
    reduced AS (SELECT *, 0.180625 - q * q AS r1, sqrt(-ln(0.5 - abs(q))) - 1.6 AS r2 FROM shares),
    scored AS MATERIALIZED (SELECT *, CASE WHEN abs(q) <= 0.425 THEN q * {rational(QUANTILE_CENTRE, "r1")}
               ELSE sign(q) * {rational(QUANTILE_SIDE, "r2")} END AS m FROM reduced),
    norms AS (SELECT "column", g, n, sum(m * m) AS norm, max(m) FILTER (WHERE i = n) AS mn, max(m) FILTER (WHERE i = n - 1) AS mp,
              avg(value) AS mean, var_samp(value) * (n - 1) AS spread, 1 / sqrt(n) AS u FROM scored GROUP BY 1, 2, 3),
    ends AS (SELECT *, mn / sqrt(norm) + {weight("WEIGHT_LAST", "u")} AS e1, mp / sqrt(norm) + {weight("WEIGHT_SECOND", "u")} AS e2 FROM norms),
    whole AS (SELECT *, sqrt((norm - 2 * mn * mn - 2 * mp * mp) / (1 - 2 * e1 * e1 - 2 * e2 * e2)) AS phi FROM ends),
    stats AS (SELECT "column", g, w.n, least(1, pow(sum(value * CASE WHEN i = w.n THEN e1 WHEN i = w.n - 1 THEN e2 WHEN i = 1 THEN -e1 WHEN i = 2 THEN -e2
              ELSE m / phi END), 2) / any_value(spread)) AS w FROM scored JOIN whole w USING ("column", g) GROUP BY 1, 2, 3),
    zeds AS (SELECT *, ln(n) AS l, ln(1 - w) AS y FROM stats),
    zed AS (SELECT *, (y - {weight("LARGE_MEAN", "l")}) / exp({weight("LARGE_LOG_SD", "l")}) AS z FROM zeds),
    sw AS (SELECT "column", g, n, w, {normal_tail("z")} AS p FROM zed, nodes GROUP BY 1, 2, 3, 4)"""


HASH = "substr(md5(CAST(Customer_ID AS VARCHAR) || '-42'), 1, 15) AS hash"
LOAN_HASHED = f"long AS MATERIALIZED ({long_values(LOAN_NUMBERS, f'({LOAN})', f'Loan_Status AS g, {HASH}')})"


@query(
    "normality_check",
    f"""WITH {LOAN_HASHED}, {NODES}, {royston("long", "least(n_all, 5000)")}
    SELECT "column", g AS "group", n, round(w, 6) AS w, round(p, 6) AS p_value FROM sw""",
)
def normality_check(spark, sf):
    return rounded(compare.normality_check(loan(spark, sf), LOAN_NUMBERS, "Loan_Status", "Customer_ID"), 6)


@query(
    "two_group_compare",
    f"""WITH {LOAN_HASHED}, {NODES}, {TWO_MOMENTS.format(a="Y", b="N")}, {RANKS}, {U_TEST.format(a="Y")},
    {royston("long", 'least(min(n_all) OVER (PARTITION BY "column"), 5000)')},
    gate AS (SELECT "column", min(p) < 0.05 AS ranked FROM sw GROUP BY 1),
    t AS (SELECT *, (m1 - m2) / sqrt(v1 + v2) AS t, (v1 + v2) * (v1 + v2) / (v1*v1/(n1-1) + v2*v2/(n2-1)) AS v FROM e),
    pw AS (SELECT "column", 2 * {t_tail("abs(t)", "v")} AS pw FROM t, nodes GROUP BY 1),
    pm AS (SELECT "column", least(1, 2 * {normal_tail("zed")}) AS pm FROM zz, nodes GROUP BY 1),
    f AS (SELECT t.*, ranked, CASE WHEN ranked THEN zz.stat ELSE t END AS stat, CASE WHEN ranked THEN pm ELSE pw END AS p
          FROM t JOIN zz USING ("column") JOIN gate USING ("column") JOIN pw USING ("column") JOIN pm USING ("column"))
    SELECT "column", CASE WHEN ranked THEN 'Mann-Whitney U' ELSE 'Welch''s t-test' END AS test_type, {TWO_COLUMNS} FROM f""",
)
def two_group_compare(spark, sf):
    return rounded(compare.two_group_compare(loan(spark, sf), LOAN_NUMBERS, "Loan_Status", "Y", "N", "Customer_ID"), 6)


PART = f"long AS ({long_values(['p_retailprice', 'p_size'], 'part', 'p_type AS g')})"


@query(
    "anova",
    f"""WITH {PART}, {NODES},
    k AS (SELECT "column", g, count(*) AS n, avg(value) AS m, var_samp(value) AS s2 FROM long GROUP BY 1, 2),
    t AS (SELECT "column", avg(value) AS grand FROM long GROUP BY 1),
    f AS (SELECT "column", count(*) AS n_groups, sum(n) AS total,
          (sum(n * (m - grand) * (m - grand)) / (count(*) - 1)) / (sum((n - 1) * s2) / (sum(n) - count(*))) AS stat
          FROM k JOIN t USING ("column") GROUP BY 1),
    p AS (SELECT "column", {f_tail("stat", "(n_groups - 1)", "(total - n_groups)")} AS p FROM f, nodes GROUP BY 1)
    SELECT "column", 'One-way ANOVA' AS test_type, n_groups, round(stat, 4) AS statistic, round(p, 6) AS p_value,
      p < 0.05 AS significant FROM f JOIN p USING ("column")""",
)
def anova(spark, sf):
    df = table(spark, sf, "part")
    return rounded(compare.multi_group_compare(df, ["p_retailprice", "p_size"], "p_type", test="anova"), 6)


@query(
    "kruskal",
    f"""WITH {PART}, {NODES}, {RANKS},
    k AS (SELECT "column", g, count(*) AS n, sum(rk) AS rs FROM r GROUP BY 1, 2),
    h0 AS (SELECT "column", count(*) AS n_groups, CAST(sum(n) AS DOUBLE) AS total, sum(rs * rs / n) AS q FROM k GROUP BY 1),
    h AS (SELECT "column", n_groups, (12 / (total * (total + 1)) * q - 3 * (total + 1))
          / (1 - tie / (total * total * total - total)) AS stat FROM h0 JOIN ties USING ("column")),
    p AS (SELECT "column", {chi2_tail("stat", "(n_groups - 1)")} AS p FROM h, nodes GROUP BY 1)
    SELECT "column", 'Kruskal-Wallis H-test' AS test_type, n_groups, round(stat, 4) AS statistic,
      round(p, 6) AS p_value, p < 0.05 AS significant FROM h JOIN p USING ("column")""",
)
def kruskal(spark, sf):
    df = table(spark, sf, "part")
    return rounded(compare.multi_group_compare(df, ["p_retailprice", "p_size"], "p_type", test="rank"), 6)


AREA = long_values(["Applicant_Income", "Loan_Amount"], f"({LOAN})", f"Property_Area AS g, {HASH}")


@query(
    "multi_group_compare",
    f"""WITH long AS MATERIALIZED ({AREA}), {NODES}, {RANKS}, {royston("long", "least(n_all, 5000)")},
    gate AS (SELECT "column", min(p) < 0.05 AS ranked FROM sw GROUP BY 1),
    k AS (SELECT "column", g, count(*) AS n, avg(value) AS m, var_samp(value) AS s2, sum(rk) AS rs FROM r GROUP BY 1, 2),
    t AS (SELECT "column", avg(value) AS grand FROM long GROUP BY 1),
    f AS (SELECT "column", count(*) AS n_groups, CAST(sum(n) AS DOUBLE) AS total, sum(rs * rs / n) AS q,
          (sum(n * (m - grand) * (m - grand)) / (count(*) - 1)) / (sum((n - 1) * s2) / (sum(n) - count(*))) AS a
          FROM k JOIN t USING ("column") GROUP BY 1),
    h AS (SELECT *, (12 / (total * (total + 1)) * q - 3 * (total + 1)) / (1 - tie / (total * total * total - total)) AS h
          FROM f JOIN ties USING ("column")),
    p AS (SELECT "column", {chi2_tail("h", "(n_groups - 1)")} AS ph, {f_tail("a", "(n_groups - 1)", "(total - n_groups)")} AS pa
          FROM h, nodes GROUP BY 1),
    c AS (SELECT "column", ranked, n_groups, CASE WHEN ranked THEN h ELSE a END AS stat, CASE WHEN ranked THEN ph ELSE pa END AS p
          FROM h JOIN p USING ("column") JOIN gate USING ("column"))
    SELECT "column", CASE WHEN ranked THEN 'Kruskal-Wallis H-test' ELSE 'One-way ANOVA' END AS test_type, n_groups,
      round(stat, 4) AS statistic, round(p, 6) AS p_value, p < 0.05 AS significant FROM c""",
)
def multi_group_compare(spark, sf):
    found = compare.multi_group_compare(
        loan(spark, sf), ["Applicant_Income", "Loan_Amount"], "Property_Area", "Customer_ID"
    )
    return rounded(found, 6)


# fixed values: the published rational form of the normal distribution function, highest power first
CDF_PIECES = (
    [0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376],
    [0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752],
)


def normal_below(x: str) -> str:
    far = f"exp(-{x} * {x} / 2) / 2.506628274631 / (abs({x}) + 1 / (abs({x}) + 2 / (abs({x}) + 3 / (abs({x}) + 4 / (abs({x}) + 0.65)))))"
    upper = f"CASE WHEN abs({x}) > 37 THEN 0 WHEN abs({x}) < 7 THEN exp(-{x} * {x} / 2) * {rational(CDF_PIECES, f'abs({x})')} ELSE {far} END"
    return f"(CASE WHEN {x} > 0 THEN 1 - {upper} ELSE {upper} END)"


FLAGS = f"long AS ({long_values(LINE_NUMBERS, 'lineitem', 'l_returnflag AS g')})"


@query(
    "tukey_hsd",
    f"""WITH {FLAGS},
    k AS (SELECT "column", g, count(*) AS n, avg(value) AS m, var_samp(value) AS s2 FROM long GROUP BY 1, 2),
    f AS (SELECT "column", count(*) AS n_groups, CAST(sum(n) - count(*) AS DOUBLE) AS v, sum((n - 1) * s2) / (sum(n) - count(*)) AS mse FROM k GROUP BY 1),
    pairs AS (SELECT a."column", a.g AS group1, b.g AS group2, n_groups, v, a.m - b.m AS gap,
              abs(a.m - b.m) / sqrt(mse / 2 * (1.0 / a.n + 1.0 / b.n)) AS q
              FROM k a JOIN k b ON a."column" = b."column" AND a.g < b.g JOIN f ON f."column" = a."column"),
    zs AS (SELECT z, {normal_below("z")} AS below, exp(-z * z / 2) / sqrt(2 * pi()) * 17 / 400 AS share
           FROM (SELECT -8.5 + (i + 0.5) * 17 / 400 AS z FROM generate_series(0, 399) t(i))),
    wide AS (SELECT *, greatest(0, 1 - 12 / sqrt(2 * v)) AS low, 1 + 12 / sqrt(2 * v) AS high FROM pairs),
    ss AS (SELECT *, low + (i + 0.5) * (high - low) / 80 AS s FROM wide, generate_series(0, 79) t(i)),
    weighed AS (SELECT *, exp((v - 1) * ln(s) - v * (s * s - 1) / 2) AS w FROM ss),
    cells AS (SELECT weighed.*, below, share, z - q * s AS x FROM weighed, zs),
    inner_sums AS (SELECT "column", group1, group2, gap, q, s, w,
                   sum(n_groups * share * pow(greatest(0, below - {normal_below("x")}), n_groups - 1)) AS h FROM cells GROUP BY ALL),
    p AS (SELECT "column", group1, group2, gap, q, greatest(0, least(1, 1 - sum(w * h) / sum(w))) AS p FROM inner_sums GROUP BY ALL)
    SELECT "column", group1, group2, round(gap, 4) AS mean_difference, round(q, 4) AS statistic, round(p, 6) AS p_value, p < 0.05 AS significant FROM p""",
)
def tukey_hsd(spark, sf):
    return rounded(compare.tukey_hsd(table(spark, sf, "lineitem"), LINE_NUMBERS, "l_returnflag"), 6)


# ---- association ----------------------------------------------------------------------------

CHI = """
o AS (SELECT "column", value, t, count(*) AS o FROM long WHERE t IS NOT NULL GROUP BY 1, 2, 3),
rt AS (SELECT "column", value, sum(o) AS r FROM o GROUP BY 1, 2),
ct AS (SELECT "column", t, sum(o) AS c FROM o GROUP BY 1, 2),
nt AS (SELECT "column", CAST(sum(o) AS DOUBLE) AS n FROM o GROUP BY 1),
cells AS (SELECT rt."column", coalesce(o, 0) AS o, CAST(r AS DOUBLE) * c / n AS e
  FROM rt JOIN ct USING ("column") JOIN nt USING ("column")
  LEFT JOIN o ON o."column" = rt."column" AND o.value = rt.value AND o.t = ct.t),
dims AS (SELECT "column", (SELECT count(*) FROM rt x WHERE x."column" = nt."column") AS nr,
  (SELECT count(*) FROM ct x WHERE x."column" = nt."column") AS nc, n FROM nt),
x AS (SELECT "column", sum(CASE WHEN {corrected} THEN pow(greatest(abs(o - e) - 0.5, 0), 2) ELSE pow(o - e, 2) END / e) AS chi2,
  any_value((nr - 1) * (nc - 1)) AS dof, any_value(n) AS n, any_value(least(nr, nc)) AS side, bool_or(e < 5) AS low_expected
  FROM cells JOIN dims USING ("column") GROUP BY 1),
w AS (SELECT *, sqrt(chi2 / (n * (side - 1))) AS v FROM x),
p AS (SELECT "column", {tail} AS p FROM w, nodes GROUP BY 1)
SELECT "column", round(chi2, 4) AS chi2, round(p, 6) AS p_value, CAST(dof AS BIGINT) AS dof, round(v, 4) AS cramers_v,
  {effect} AS effect, p < 0.05 AS significant, low_expected FROM w JOIN p USING ("column")
"""


def chi_sql(long: str, corrected: str) -> str:
    return f"WITH {NODES}, long AS ({long}), " + CHI.format(
        corrected=corrected, tail=chi2_tail("chi2", "dof"), effect=EFFECT_V
    )


LOAN_LONG = long_texts(LOAN_CATEGORIES, f"({LOAN})", "Loan_Status AS t")


@query("chi_square", chi_sql(LOAN_LONG, "(nr - 1) * (nc - 1) = 1"))
def chi_square(spark, sf):
    return rounded(association.chi_square_tests(loan(spark, sf), LOAN_CATEGORIES, "Loan_Status"), 6)


@query("chi_square_uncorrected", chi_sql(LOAN_LONG, "false"))
def chi_square_uncorrected(spark, sf):
    return rounded(
        association.chi_square_tests(loan(spark, sf), LOAN_CATEGORIES, "Loan_Status", yates=False), 6
    )


@query(
    "chi_square_many_classes",
    """WITH cells AS (SELECT l_returnflag AS v, l_partkey AS t, count(*) AS o FROM lineitem GROUP BY ALL),
    m AS (SELECT o, sum(o) OVER (PARTITION BY v) AS r, sum(o) OVER (PARTITION BY t) AS c, sum(o) OVER () AS n FROM cells)
    SELECT 'l_returnflag' AS "column", round(any_value(n) * (sum(CAST(o AS DOUBLE) * o / (r * c)) - 1), 3) AS chi2,
      (SELECT (count(DISTINCT v) - 1) * (count(DISTINCT t) - 1) FROM cells) AS dof FROM m""",
)
def chi_square_many_classes(spark, sf):
    found = association.chi_square_tests(table(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey")
    return rounded(found.select("column", "chi2", "dof"), 3)


@query(
    "chi_square_with_nulls",
    chi_sql(
        long_texts(["l_returnflag_n", "l_linenumber"], f"({LINEITEM_HOLES})", "l_linestatus AS t"),
        "(nr - 1) * (nc - 1) = 1",
    ),
)
def chi_square_with_nulls(spark, sf):
    df = lineitem_holes(spark, sf)
    return rounded(association.chi_square_tests(df, ["l_returnflag_n", "l_linenumber"], "l_linestatus"), 6)


TWO_VALUED = ["Gender", "Married", "Education", "Self_Employed"]


@query(
    "fisher_exact",
    f"""WITH long AS ({long_texts(TWO_VALUED, f"({LOAN})", "Loan_Status AS t")}),
    marked AS (SELECT "column", value = min(value) OVER (PARTITION BY "column") AS v1, t = min(t) OVER () AS t1 FROM long),
    m AS (SELECT "column", count(*) FILTER (v1 AND t1) AS a, count(*) FILTER (v1 AND NOT t1) AS b, count(*) FILTER (NOT v1 AND t1) AS c,
          count(*) FILTER (NOT v1 AND NOT t1) AS d FROM marked GROUP BY 1),
    s AS (SELECT *, a + b AS r, a + c AS k, a + b + c + d AS n FROM m),
    x AS (SELECT *, unnest(generate_series(greatest(0, r + k - n), least(r, k))) AS x FROM s),
    w AS (SELECT *, lgamma(k + 1) - lgamma(x + 1) - lgamma(k - x + 1) + lgamma(n - k + 1) - lgamma(r - x + 1) - lgamma(n - k - r + x + 1)
          - lgamma(n + 1) + lgamma(r + 1) + lgamma(n - r + 1) AS l FROM x),
    o AS (SELECT "column", l AS own FROM w WHERE x = a),
    p AS (SELECT "column", any_value(n) AS n, any_value(a * d / (b * c)) AS odds, least(1, sum(exp(l)) FILTER (l <= own + 1e-7)) AS p
          FROM w JOIN o USING ("column") GROUP BY 1)
    SELECT "column", n, round(odds, 4) AS odds_ratio, round(p, 6) AS p_value, p < 0.05 AS significant FROM p""",
)
def fisher_exact(spark, sf):
    return rounded(association.fisher_exact(loan(spark, sf), TWO_VALUED, "Loan_Status"), 6)


# ---- drift ----------------------------------------------------------------------------------

CUT = "2024-01-16"
EVENT_SIDES = f"""long AS (SELECT 'value' AS "column", value, CASE WHEN ts < TIMESTAMP '{CUT}' THEN 1 ELSE 2 END AS side FROM events)"""
LINE_SIDES = "long AS (" + long_values(
    ["l_quantity", "l_extendedprice"],
    "lineitem",
    "CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS side",
) + ")"
KS_D = """
n AS (SELECT "column", count(*) FILTER (WHERE side = 1) AS n1, count(*) FILTER (WHERE side = 2) AS n2 FROM long GROUP BY 1),
f AS (SELECT "column", n1, n2, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) OVER w / n1 AS f1,
        sum(CASE WHEN side = 2 THEN 1 ELSE 0 END) OVER w / n2 AS f2
      FROM long JOIN n USING ("column") WINDOW w AS (PARTITION BY "column" ORDER BY value RANGE UNBOUNDED PRECEDING)),
d AS (SELECT "column", n1, n2, max(abs(f1 - f2)) AS d FROM f GROUP BY 1, 2, 3)
"""


def _halves(spark, sf):
    df = table(spark, sf, "events")
    early = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")
    return df.where(early), df.where(~early)


def _line_halves(spark, sf):
    df = table(spark, sf, "lineitem")
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return df.where(early), df.where(~early)


@query("ks_statistics", f"WITH {EVENT_SIDES}, {KS_D} SELECT \"column\", n1, n2, round(d, 6) AS d FROM d")
def ks_statistics(spark, sf):
    return rounded(drift.ks_statistics(*_halves(spark, sf), ["value"]), 6)


@query(
    "ks_shift",
    f"""WITH {LINE_SIDES}, {KS_D},
    e AS (SELECT *, CAST(n1 AS DOUBLE) * n2 / (n1 + n2) AS ne FROM d),
    z AS (SELECT *, d * sqrt(ne) + 1 / (6 * sqrt(ne)) + (d * sqrt(ne) - 1) / (4 * ne) AS x FROM e),
    p AS (SELECT "column", greatest(0, least(1, 2 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * k * k * x * x)))) AS p
          FROM z, generate_series(1, 100) t(k) GROUP BY 1)
    SELECT "column", round(d, 4) AS statistic, round(p, 6) AS p_value, p < 0.05 AS shift_detected,
      CAST(0.05 AS DOUBLE) AS threshold FROM z JOIN p USING ("column")""",
)
def ks_shift(spark, sf):
    columns = ["l_quantity", "l_extendedprice"]
    return rounded(drift.distribution_shift(*_line_halves(spark, sf), columns), 6)


@query("ks_shift_events")
def ks_shift_events(spark, sf):
    return drift.distribution_shift(*_halves(spark, sf), ["value"])


@query(
    "psi_shift",
    f"""WITH {EVENT_SIDES},
    q AS (SELECT DISTINCT unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM long WHERE side = 1),
    b AS (SELECT side, (SELECT count(*) FROM q WHERE e < value) AS bin FROM long),
    c AS (SELECT bin, count(*) FILTER (WHERE side = 1) AS a, count(*) FILTER (WHERE side = 2) AS b FROM b GROUP BY 1),
    s AS (SELECT greatest(a / sum(a) OVER (), 1e-6) AS p, greatest(b / sum(b) OVER (), 1e-6) AS q FROM c)
    SELECT 'value' AS "column", round(sum((q - p) * ln(q / p)), 6) AS psi FROM s""",
)
def psi_shift(spark, sf):
    return rounded(drift.distribution_shift(*_halves(spark, sf), ["value"], method="psi"), 6)


@query(
    "chi_square_shift",
    "SELECT \"column\", chi2 AS statistic, p_value, significant AS shift_detected, CAST(0.05 AS DOUBLE) AS threshold FROM ("
    + chi_sql(
        long_texts(["event_type"], "events", f"CASE WHEN ts < TIMESTAMP '{CUT}' THEN '1' ELSE '2' END AS t"),
        "(nr - 1) * (nc - 1) = 1",
    )
    + ")",
)
def chi_square_shift(spark, sf):
    return rounded(drift.distribution_shift(*_halves(spark, sf), ["event_type"], method="chi_square"), 6)


# ---- correlation ----------------------------------------------------------------------------


def pair_list(columns):
    return [(x, y) for i, x in enumerate(columns) for y in columns[i + 1 :]]


def rank_of(c: str, source_filter: str = "") -> str:
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


def spearman_sql(columns, source: str, digits: int = 6) -> str:
    return f"WITH src AS ({source})\n" + "\nUNION ALL\n".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr(a, b), {digits}) AS correlation FROM (SELECT {rank_of(x)} AS a,"
        f" {rank_of(y)} AS b FROM src WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
        for x, y in pair_list(columns)
    )


@query("spearman", spearman_sql(LOAN_NUMBERS, LOAN))
def spearman(spark, sf):
    return rounded(correlation.correlation(loan(spark, sf), LOAN_NUMBERS, "spearman", "Customer_ID"), 6)


@query("spearman_keyless", spearman_sql(LINE_NUMBERS, "SELECT * FROM lineitem"))
def spearman_keyless(spark, sf):
    return rounded(correlation.correlation(table(spark, sf, "lineitem"), LINE_NUMBERS), 6)


@query("spearman_with_nulls", spearman_sql(["l_tax_n", "l_quantity_n", "l_discount"], LINEITEM_HOLES))
def spearman_with_nulls(spark, sf):
    return rounded(
        correlation.correlation(lineitem_holes(spark, sf), ["l_tax_n", "l_quantity_n", "l_discount"]), 6
    )


@query(
    "pearson",
    "\nUNION ALL\n".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS correlation FROM lineitem"
        for x, y in pair_list(LINE_NUMBERS)
    ),
)
def pearson(spark, sf):
    return rounded(correlation.correlation(table(spark, sf, "lineitem"), LINE_NUMBERS, "pearson"), 6)


@query(
    "correlation_heatmap",
    f"""WITH u AS (SELECT x, y, correlation FROM ({spearman_sql(LOAN_NUMBERS[:3], LOAN, 12)}))
    SELECT x, y, round(correlation, 2) AS correlation FROM u
    UNION ALL SELECT y, x, round(correlation, 2) FROM u
    UNION ALL SELECT c, c, 1.0 FROM (VALUES {", ".join(f"('{c}')" for c in LOAN_NUMBERS[:3])}) t(c)""",
)
def correlation_heatmap(spark, sf):
    return rounded(correlation.heatmap_cells(loan(spark, sf), LOAN_NUMBERS[:3], "spearman", "Customer_ID"))


# ---- further tests --------------------------------------------------------------------------


@query(
    "paired_t",
    f"""WITH {NODES},
    s AS (SELECT count(d) AS n, avg(d) AS m, stddev_samp(d) AS s FROM (SELECT l_discount - l_tax AS d FROM lineitem)),
    t AS (SELECT *, m / (s / sqrt(n)) AS stat, n - 1.0 AS v FROM s),
    p AS (SELECT 2 * {t_tail("abs(stat)", "v")} AS p FROM t, nodes)
    SELECT n, round(m, 4) AS mean_difference, round(stat, 4) AS statistic, round(p, 6) AS p_value FROM t, p""",
)
def paired_t(spark, sf):
    return rounded(compare.paired_t(table(spark, sf, "lineitem"), "l_discount", "l_tax"), 6)


@query(
    "two_proportions",
    f"""WITH {NODES},
    c AS (SELECT count(*) FILTER (WHERE l_linestatus = 'F') AS n1, count(*) FILTER (WHERE l_linestatus = 'O') AS n2,
      count(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'R') AS x1,
      count(*) FILTER (WHERE l_linestatus = 'O' AND l_returnflag = 'R') AS x2 FROM lineitem),
    z AS (SELECT *, (x1 / n1 - x2 / n2) / sqrt((x1 + x2) / (n1 + n2) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2)) AS z FROM c),
    p AS (SELECT 2 * {normal_tail("abs(z)")} AS p FROM z, nodes)
    SELECT n1, n2, round(x1 / n1, 6) AS share1, round(x2 / n2, 6) AS share2, round(z, 4) AS z, round(p, 6) AS p_value FROM z, p""",
)
def two_proportions(spark, sf):
    df = table(spark, sf, "lineitem")
    return rounded(
        compare.two_proportions(df, "l_linestatus", "F", "O", F.col("l_returnflag") == "R"), 6
    )


def adjusted_sql(expression: str) -> str:
    base = chi_sql(LOAN_LONG, "(nr - 1) * (nc - 1) = 1")
    return f"""WITH base AS (SELECT "column", p_value FROM ({base})), a AS (SELECT *, {expression} AS p_adjusted FROM base)
    SELECT "column", p_value, round(p_adjusted, 6) AS p_adjusted, p_adjusted < 0.05 AS significant_adjusted FROM a"""


def _adjusted(spark, sf, method):
    tests = association.chi_square_tests(loan(spark, sf), LOAN_CATEGORIES, "Loan_Status")
    return rounded(compare.adjust_p_values(tests.select("column", "p_value"), method), 6)


@query("bonferroni", adjusted_sql("least(1.0, p_value * count(*) OVER ())"))
def bonferroni(spark, sf):
    return _adjusted(spark, sf, "bonferroni")


@query(
    "false_discovery_rate",
    adjusted_sql(
        "least(1.0, (SELECT min(b.p_value * (SELECT count(*) FROM base)"
        " / (SELECT count(*) FROM base c WHERE c.p_value <= b.p_value)) FROM base b WHERE b.p_value >= base.p_value))"
    ),
)
def false_discovery_rate(spark, sf):
    return _adjusted(spark, sf, "fdr")
