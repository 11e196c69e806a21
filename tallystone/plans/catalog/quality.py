"""Missing values, duplicates, outliers and range checks."""

from __future__ import annotations

from tallystone.operators import quality, selectors
from tallystone.plans.catalog.registry import (
    LINE_NUMBERS,
    LINEITEM_HOLES,
    lineitem_holes,
    long_values,
    per_column,
    query,
    rounded,
    table,
)

HOLES = ["l_tax_n", "l_quantity_n", "l_returnflag_n", "l_tax"]


@query(
    "missing_report",
    f"""WITH m AS ({per_column(HOLES, "count(*) - count({c}) AS missing_count, count(*) AS total", f"({LINEITEM_HOLES})")})
    SELECT "column", missing_count, round(missing_count / total, 4) AS missing_fraction,
      CASE WHEN round(missing_count / total, 4) >= 0.30 THEN 'CRITICAL'
           WHEN round(missing_count / total, 4) >= 0.05 THEN 'WARNING' ELSE 'INFO' END AS severity
    FROM m WHERE missing_count > 0""",
)
def missing_report(spark, sf):
    return rounded(quality.missing_report(lineitem_holes(spark, sf), HOLES))


@query(
    "duplicate_report",
    """WITH g AS (SELECT text, count(*) AS n FROM documents GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
      round(sum(n - 1) * 100.0 / sum(n), 4) AS duplicate_percent, sum(n - 1) > 0 AS has_duplicates FROM g""",
)
def duplicate_report(spark, sf):
    return rounded(quality.duplicate_report(table(spark, sf, "documents"), ["text"]))


@query(
    "duplicate_report_times",
    """WITH g AS (SELECT ts, user_id, count(*) AS n FROM events GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
      round(sum(n - 1) * 100.0 / sum(n), 4) AS duplicate_percent, sum(n - 1) > 0 AS has_duplicates FROM g""",
)
def duplicate_report_times(spark, sf):
    return rounded(quality.duplicate_report(table(spark, sf, "events"), ["ts", "user_id"]))


@query(
    "duplicate_report_nullable_key",
    f"""WITH g AS (SELECT l_tax_n, l_quantity_n, l_returnflag_n, count(*) AS n FROM ({LINEITEM_HOLES}) GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
      round(sum(n - 1) * 100.0 / sum(n), 4) AS duplicate_percent, sum(n - 1) > 0 AS has_duplicates FROM g""",
)
def duplicate_report_nullable_key(spark, sf):
    return rounded(quality.duplicate_report(lineitem_holes(spark, sf), ["l_tax_n", "l_quantity_n", "l_returnflag_n"]))


@query(
    "duplicate_rows",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
    SELECT doc_id, text, lang, source, n_chars FROM r WHERE rn > 1""",
)
def duplicate_rows(spark, sf):
    return quality.duplicate_rows(table(spark, sf, "documents"), "doc_id", ["text"])


QUARTILES = """
WITH long AS ({long}),
q AS (SELECT "column", count(*) AS total, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
      FROM long GROUP BY 1),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
"""


@query(
    "iqr_outliers",
    QUARTILES.format(
        long=long_values(["value"], "events") + "\nUNION ALL\n" + long_values(["user_id"], "events")
    )
    + """SELECT "column", count(*) FILTER (WHERE value < lo OR value > hi) AS outlier_count,
      round(count(*) FILTER (WHERE value < lo OR value > hi) * 100.0 / any_value(total), 2) AS outlier_percent,
      round(any_value(lo), 2) AS lower_bound, round(any_value(hi), 2) AS upper_bound,
      round(any_value(q1), 2) AS q1, round(any_value(q3), 2) AS q3,
      round(round(any_value(q3), 2) - round(any_value(q1), 2), 2) AS iqr
    FROM long JOIN b USING ("column") GROUP BY 1""",
)
def iqr_outliers(spark, sf):
    columns = ["event_id", "value", "user_id"]
    return rounded(quality.iqr_outliers(table(spark, sf, "events"), columns, id_column="event_id"))


@query(
    "zscore_outliers",
    f"""WITH long AS ({long_values(["value"], "events")}),
    s AS (SELECT "column", count(*) AS total, avg(value) AS m, stddev_samp(value) AS s FROM long GROUP BY 1)
    SELECT "column", count(*) FILTER (WHERE value < m - 3 * s OR value > m + 3 * s) AS outlier_count,
      round(count(*) FILTER (WHERE value < m - 3 * s OR value > m + 3 * s) * 100.0 / any_value(total), 2) AS outlier_percent,
      round(any_value(m - 3 * s), 2) AS lower_bound, round(any_value(m + 3 * s), 2) AS upper_bound,
      round(any_value(m), 2) AS mean, round(any_value(s), 2) AS std
    FROM long JOIN s USING ("column") GROUP BY 1""",
)
def zscore_outliers(spark, sf):
    return rounded(quality.zscore_outliers(table(spark, sf, "events"), ["value"]))


@query(
    "range_check",
    """SELECT 'c_acctbal' AS "column", count(*) FILTER (WHERE c_acctbal < 0) AS n_below,
      count(*) FILTER (WHERE c_acctbal > 9000) AS n_above, min(c_acctbal) AS observed_min,
      max(c_acctbal) AS observed_max, bool_and(c_acctbal BETWEEN 0 AND 9000) AS passed FROM customer
    UNION ALL
    SELECT 'c_nationkey', count(*) FILTER (WHERE c_nationkey < 0), count(*) FILTER (WHERE c_nationkey > 24),
      CAST(min(c_nationkey) AS DOUBLE), CAST(max(c_nationkey) AS DOUBLE), bool_and(c_nationkey BETWEEN 0 AND 24)
    FROM customer""",
)
def range_check(spark, sf):
    bounds = {"c_acctbal": (0, 9000), "c_nationkey": (0, 24), "absent": (0, 1)}
    return selectors.range_check(table(spark, sf, "customer"), bounds)


@query("validate", "SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def validate(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", *LINE_NUMBERS)
    return selectors.validate(
        df,
        expected=["l_orderkey", *LINE_NUMBERS],
        numeric=LINE_NUMBERS,
        bounds={"l_quantity": (1, 50), "l_discount": (0, 1), "l_tax": (0, None)},
    )


WANTED = ["l_orderkey", "l_quantity", "l_tax", "l_colour", "l_weight"]


@query(
    "schema_check",
    f"""WITH have AS (SELECT column_name AS c FROM (DESCRIBE lineitem)), want AS (SELECT unnest({WANTED}) AS c)
    SELECT 'schema' AS "check", c AS "column", 'error' AS severity, 'missing column' AS detail FROM want ANTI JOIN have USING (c)
    UNION ALL SELECT 'schema', c, 'warning', 'extra column' FROM have ANTI JOIN want USING (c)""",
)
def schema_check(spark, sf):
    return selectors.schema_report(table(spark, sf, "lineitem"), WANTED)


@query(
    "dtype_check",
    """WITH have AS (SELECT column_name AS c, CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS kind FROM (DESCRIBE lineitem))
    SELECT 'dtype' AS "check", c AS "column", 'error' AS severity, 'expected numeric, got ' || kind AS detail
    FROM have WHERE c IN ('l_returnflag', 'l_tax', 'l_linestatus') AND kind = 'string'
    UNION ALL SELECT 'dtype', c, 'warning', 'expected categorical, got ' || kind
    FROM have WHERE c IN ('l_orderkey', 'l_linestatus', 'l_discount') AND kind <> 'string'""",
)
def dtype_check(spark, sf):
    df = table(spark, sf, "lineitem")
    return selectors.dtype_report(df, ["l_returnflag", "l_tax", "l_linestatus"], ["l_orderkey", "l_linestatus", "l_discount"])
