"""Descriptive profiles, listings and plot data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.operators import association, plotdata, profile, selectors
from tallystone.plans.catalog.registry import (
    LINE_NUMBERS,
    LINEITEM_HOLES,
    LOAN,
    LOAN_NUMBERS,
    lineitem_holes,
    loan,
    long_texts,
    long_values,
    per_column,
    query,
    rounded,
    table,
)

PROFILE_SQL = """count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max, round(max({c}) - min({c}), 4) AS range,
round(stddev_samp({c}) / avg({c}), 4) AS cv"""


@query("numeric_profile", per_column(LINE_NUMBERS, PROFILE_SQL, "lineitem"))
def numeric_profile(spark, sf):
    return rounded(profile.numeric_profile(table(spark, sf, "lineitem"), LINE_NUMBERS))


@query(
    "numeric_profile_with_nulls",
    per_column(["l_tax_n", "l_quantity_n"], PROFILE_SQL, "src", f"WITH src AS ({LINEITEM_HOLES})\n"),
)
def numeric_profile_with_nulls(spark, sf):
    return rounded(profile.numeric_profile(lineitem_holes(spark, sf), ["l_tax_n", "l_quantity_n"]))


@query(
    "basic_stats",
    "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns,"
    " 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns FROM orders",
)
def basic_stats(spark, sf):
    return profile.basic_stats(table(spark, sf, "orders"))


@query(
    "column_info",
    per_column(
        ["l_tax_n", "l_quantity_n", "l_returnflag_n"],
        "CASE WHEN '{c}' = 'l_returnflag_n' THEN 'string' ELSE 'double' END AS dtype, count({c}) AS non_null",
        "src",
        f"WITH src AS ({LINEITEM_HOLES})\n",
    ),
)
def column_info(spark, sf):
    df = lineitem_holes(spark, sf).select("l_tax_n", "l_quantity_n", "l_returnflag_n")
    return selectors.column_info(df)


@query("min_max", per_column(LINE_NUMBERS, "min({c}) AS min, max({c}) AS max", "lineitem"))
def min_max(spark, sf):
    return profile.min_max(table(spark, sf, "lineitem"), LINE_NUMBERS)


@query("numeric_projection", "SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric_projection(spark, sf):
    return selectors.select_numeric(table(spark, sf, "part"))


@query("categorical_projection", "SELECT p_name, p_brand, p_type FROM part")
def categorical_projection(spark, sf):
    return selectors.select_categorical(table(spark, sf, "part"))


@query(
    "threshold_filter",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 400000",
)
def threshold_filter(spark, sf):
    return selectors.filter_rows(
        table(spark, sf, "orders"),
        F.col("o_totalprice") > 400000,
        ["o_orderkey", "o_totalprice", "o_orderstatus"],
    )


@query("drop_columns", "SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_columns(spark, sf):
    reasons = {"c_custkey": "an identifier", "c_name": "an identifier", "c_phone": "not in the table"}
    return selectors.drop_columns(table(spark, sf, "customer"), reasons)[0]


@query("mask_columns", "SELECT c_custkey, sha256(c_name) AS c_name, c_acctbal FROM customer")
def mask_columns(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return selectors.mask_columns(df, ["c_name", "absent"])


FLAGS = ["l_returnflag", "l_linestatus"]
COUNTS = "counts AS (SELECT \"column\", value, count(*) AS n FROM long GROUP BY 1, 2)"
RANKED = (
    'ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS position FROM counts)'
)


@query(
    "categorical_profile",
    f"""WITH long AS ({long_texts([*FLAGS, "l_returnflag_n"], f"({LINEITEM_HOLES})")}), {COUNTS}, {RANKED}
    SELECT "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS unique_count,
      max(CASE WHEN position = 1 THEN value END) AS most_frequent,
      CAST(max(CASE WHEN position = 1 THEN n END) AS BIGINT) AS most_frequent_count
    FROM ranked GROUP BY "column" """,
)
def categorical_profile(spark, sf):
    return profile.categorical_profile(lineitem_holes(spark, sf), [*FLAGS, "l_returnflag_n"])


@query(
    "top_values",
    f"""WITH long AS ({long_texts(["p_brand", "p_type", "p_name"], "part")}), {COUNTS}, {RANKED}
    SELECT "column", value, n AS value_count, CAST(position AS INT) AS position FROM ranked WHERE position <= 5""",
)
def top_values(spark, sf):
    return profile.top_values(table(spark, sf, "part"), ["p_brand", "p_type", "p_name"])


@query(
    "value_counts",
    f"""WITH long AS ({long_texts(["o_orderstatus", "o_orderpriority"], "orders")})
    SELECT "column", value, count(*) AS value_count FROM long GROUP BY 1, 2""",
)
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "distinct_counts",
    f"""WITH long AS ({long_texts(["text", "lang", "source"], "documents")})
    SELECT "column", count(DISTINCT value) AS unique_count FROM long GROUP BY 1""",
)
def distinct_counts(spark, sf):
    return profile.distinct_counts(table(spark, sf, "documents"), ["text", "lang", "source"])


@query(
    "unique_sample",
    f"""WITH long AS ({long_texts(["p_brand", "p_type"], "part")}),
    u AS (SELECT DISTINCT "column", value FROM long),
    r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) AS position FROM u)
    SELECT "column", value, CAST(position AS INT) AS position FROM r WHERE position <= 6""",
)
def unique_sample(spark, sf):
    return profile.unique_sample(table(spark, sf, "part"), ["p_brand", "p_type"])


@query(
    "class_distribution",
    "SELECT o_orderstatus, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS percent"
    " FROM orders GROUP BY 1",
)
def class_distribution(spark, sf):
    return rounded(profile.class_distribution(table(spark, sf, "orders"), "o_orderstatus"))


@query(
    "class_distribution_by_split",
    "SELECT l_linestatus, l_returnflag, count(*) AS n,"
    " round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY l_linestatus), 4) AS percent"
    " FROM lineitem GROUP BY 1, 2",
)
def class_distribution_by_split(spark, sf):
    return rounded(
        profile.class_distribution(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    )


@query("skewness", per_column(LOAN_NUMBERS, "round(skewness({c}), 6) AS skewness", "loan", f"WITH loan AS ({LOAN})\n"))
def skewness(spark, sf):
    return rounded(profile.skewness(loan(spark, sf), LOAN_NUMBERS), 6)


@query(
    "log_profile",
    per_column(
        ["Applicant_Income", "Coapplicant_Income"],
        "round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(avg({c}), 4) AS mean,"
        " round(skewness({c}), 4) AS skewness, bool_or({c} = 0) AS has_zeros, bool_or({c} < 0) AS has_negatives",
        "loan",
        f"WITH loan AS ({LOAN})\n",
    ),
)
def log_profile(spark, sf):
    return rounded(profile.log_profile(loan(spark, sf), ["Applicant_Income", "Coapplicant_Income"]))


@query(
    "group_means",
    "\nUNION ALL\n".join(
        f"SELECT l_returnflag AS \"group\", '{c}' AS \"column\", round(avg({c}), 4) AS mean FROM lineitem GROUP BY 1"
        for c in LINE_NUMBERS
    ),
)
def group_means(spark, sf):
    return rounded(profile.group_means(table(spark, sf, "lineitem"), LINE_NUMBERS, "l_returnflag"))


@query(
    "crosstab",
    """WITH pairs AS (SELECT p_brand AS value, p_type AS target, count(*) AS n FROM part GROUP BY 1, 2),
    grid AS (SELECT a.value, b.target FROM (SELECT DISTINCT p_brand AS value FROM part) a
             CROSS JOIN (SELECT DISTINCT p_type AS target FROM part) b)
    SELECT g.value, g.target, coalesce(n, 0) AS n FROM grid g LEFT JOIN pairs USING (value, target)""",
)
def crosstab(spark, sf):
    return association.crosstab(table(spark, sf, "part"), "p_brand", "p_type")


# ---- plot data ------------------------------------------------------------------------------

HISTOGRAM = """
WITH long AS ({long}),
shape AS (SELECT "column", min(value) AS low, max(value) AS high, {bins} AS bins FROM long GROUP BY 1),
binned AS (
  SELECT "column", least(CAST(floor((value - low) * bins / (high - low)) AS BIGINT), bins - 1) AS bin, count(*) AS n
  FROM long JOIN shape USING ("column") GROUP BY 1, 2),
every AS (SELECT "column", low, (high - low) / bins AS width, unnest(generate_series(0, CAST(bins AS BIGINT) - 1)) AS bin FROM shape)
SELECT "column", CAST(bin AS INT) AS bin, round(low + bin * width, 4) AS left_edge,
  round(low + (bin + 1) * width, 4) AS right_edge, coalesce(n, 0) AS n
FROM every LEFT JOIN binned USING ("column", bin)
"""


@query("histogram", HISTOGRAM.format(long=long_values(["value"], "events"), bins="20"))
def histogram(spark, sf):
    return rounded(plotdata.histogram(table(spark, sf, "events"), ["value"], bins=20))


AUTO_BINS = """CAST(greatest(1, ceil((max(value) - min(value)) / least(
  (max(value) - min(value)) / (log2(count(*)) + 1),
  2 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / pow(count(*), 1.0 / 3.0)))) AS BIGINT)"""


@query(
    "histogram_auto",
    HISTOGRAM.format(long=long_values(["l_quantity", "l_extendedprice"], "lineitem"), bins=AUTO_BINS),
)
def histogram_auto(spark, sf):
    return rounded(plotdata.histogram(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query(
    "density",
    """WITH s AS (SELECT count(*) AS n, min(value) AS low, max(value) AS high, stddev_samp(value) AS sd FROM events),
    grid AS (SELECT i AS point, low + i * (high - low) / 199 AS x, n, sd * pow(n, -0.2) AS h
             FROM s, generate_series(0, 199) t(i))
    SELECT 'value' AS "column", CAST(point AS INT) AS point, round(x, 4) AS x,
      round(sum(exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 7) AS density
    FROM grid, events GROUP BY point, x""",
)
def density(spark, sf):
    out = plotdata.density(table(spark, sf, "events"), ["value"])
    return rounded(rounded(out, 4, ["x"]), 7, ["density"])


BOX = """
WITH long AS ({long}),
q AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
      quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1)
"""


@query(
    "box_stats",
    BOX.format(long=long_values(["value"], "events"))
    + """SELECT "column", round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
      round(avg(value), 4) AS mean,
      round(min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END), 4) AS whisker_low,
      round(max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END), 4) AS whisker_high,
      count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
    FROM long JOIN q USING ("column") GROUP BY 1""",
)
def box_stats(spark, sf):
    return rounded(plotdata.box_stats(table(spark, sf, "events"), ["value"]))


@query(
    "box_outliers",
    BOX.format(long=long_values(["value"], "events"))
    + """SELECT "column", value, count(*) AS n FROM long JOIN q USING ("column")
    WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) GROUP BY 1, 2""",
)
def box_outliers(spark, sf):
    return plotdata.box_outliers(table(spark, sf, "events"), ["value"])


@query("preview", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return selectors.preview(orders.orderBy("o_orderkey"), 5)
