"""Registration and the input views shared by the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.functions.columns import is_float, ref

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 4, columns: Sequence[str] | None = None) -> DataFrame:
    """Round double columns so that both engines print the same digits."""
    names = [f.name for f in df.schema.fields if is_float(f.dataType)]
    picked = names if columns is None else columns
    # adding 0.0 turns -0.0 into 0.0
    return df.withColumns({c: F.round(ref(c), digits) + F.lit(0.0) for c in picked})


def sql_view(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """Run a fixture statement with the named tables in place."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables})


# The loan-shaped view: every order becomes an application. The Spark text differs from the
# SQL text only in that table names are placeholders.
LOAN_SELECT = """
SELECT o_orderkey AS Customer_ID,
  CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS Gender,
  CASE WHEN o_custkey % 3 = 0 THEN 'No' ELSE 'Yes' END AS Married,
  CAST(o_orderkey % 4 AS INT) AS Dependents,
  CASE WHEN c_mktsegment IN ('HOUSEHOLD','BUILDING') THEN 'Not Graduate' ELSE 'Graduate' END AS Education,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'Yes' ELSE 'No' END AS Self_Employed,
  abs(c_acctbal) AS Applicant_Income,
  CASE WHEN c_acctbal > 5000 THEN c_acctbal - 5000 ELSE 0 END AS Coapplicant_Income,
  o_totalprice / 1000 AS Loan_Amount,
  CAST(12 * (1 + o_orderkey % 30) AS INT) AS Loan_Amount_Term,
  CASE o_orderkey % 3 WHEN 0 THEN 'Rural' WHEN 1 THEN 'Semiurban' ELSE 'Urban' END AS Property_Area,
  CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE 1 END AS Credit_History,
  CASE WHEN o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS Loan_Status
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""
LOAN = LOAN_SELECT.format(orders="orders", customer="customer")

# Classification scores: quality is the label, the length of the text the score.
SCORED_SELECT = """
SELECT l.doc_id, d.lang, l.quality AS y,
  least(CAST(d.n_chars AS DOUBLE) / 5000, CAST(0.999 AS DOUBLE)) AS p,
  CASE WHEN d.n_chars >= 2500 THEN 1 ELSE 0 END AS pred
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id
"""
SCORED = SCORED_SELECT.format(labels="labels", documents="documents")

# A second score on the same documents, so that there are two models to compare.
RIVAL_SELECT = """
SELECT l.doc_id, d.lang, l.quality AS y,
  least(CAST(d.n_chars AS DOUBLE) / 1000, CAST(0.99 AS DOUBLE)) AS p,
  CASE WHEN d.n_chars >= 200 THEN 1 ELSE 0 END AS pred
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id
"""
RIVAL = RIVAL_SELECT.format(labels="labels", documents="documents")

LINEITEM_HOLES_SELECT = """
SELECT *, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax_n,
  CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END AS l_quantity_n,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag_n
FROM {lineitem}
"""
LINEITEM_HOLES = LINEITEM_HOLES_SELECT.format(lineitem="lineitem")

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LOAN_NUMBERS = ["Applicant_Income", "Coapplicant_Income", "Loan_Amount", "Loan_Amount_Term", "Dependents"]
LOAN_CATEGORIES = ["Gender", "Married", "Education", "Self_Employed", "Property_Area"]


def loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_view(spark, sf_dir, LOAN_SELECT, "orders", "customer")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_view(spark, sf_dir, SCORED_SELECT, "labels", "documents")


def rival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_view(spark, sf_dir, RIVAL_SELECT, "labels", "documents")


def lineitem_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_view(spark, sf_dir, LINEITEM_HOLES_SELECT, "lineitem")


def per_column(columns: Sequence[str], body: str, source: str, prefix: str = "") -> str:
    """``UNION ALL`` of one statement per column; ``{c}`` stands for the column."""
    parts = [f"SELECT '{c}' AS \"column\", {body.format(c=c)} FROM {source}" for c in columns]
    return prefix + "\nUNION ALL\n".join(parts)


def long_values(columns: Sequence[str], source: str, extra: str = "") -> str:
    """Rows ``(column, value, extra…)`` of the non-null cells."""
    more = f", {extra}" if extra else ""
    parts = [
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value{more} FROM {source} WHERE {c} IS NOT NULL"
        for c in columns
    ]
    return "\nUNION ALL\n".join(parts)


def long_texts(columns: Sequence[str], source: str, extra: str = "") -> str:
    more = f", {extra}" if extra else ""
    parts = [
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value{more} FROM {source} WHERE {c} IS NOT NULL"
        for c in columns
    ]
    return "\nUNION ALL\n".join(parts)


# Midpoint nodes on (0, 1); a tail integral from a to infinity maps to x = a + u / (1 - u).
NODES = "nodes AS (SELECT (i + 0.5) / 40000 AS u FROM generate_series(0, 39999) t(i))"
TAIL_X = "({a} + u / (1 - u))"
TAIL_W = "(1 / ((1 - u) * (1 - u)) / 40000)"


def normal_tail(a: str) -> str:
    x = TAIL_X.format(a=a)
    return f"sum(exp(-0.5 * {x} * {x}) / sqrt(2 * pi()) * {TAIL_W})"


def t_tail(a: str, v: str) -> str:
    x = TAIL_X.format(a=a)
    return (
        f"sum(exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2) - 0.5 * ln({v} * pi())"
        f" - ({v} + 1) / 2 * ln(1 + {x} * {x} / {v})) * {TAIL_W})"
    )


def chi2_tail(a: str, k: str) -> str:
    """Upper tail of chi-square, through the density of its square root."""
    y = TAIL_X.format(a=f"sqrt({a})")
    return (
        f"sum(exp((1 - {k} / 2.0) * ln(2) - lgamma({k} / 2.0) + ({k} - 1) * ln({y}) - {y} * {y} / 2)"
        f" * {TAIL_W})"
    )


def f_tail(a: str, d1: str, d2: str) -> str:
    x = TAIL_X.format(a=a)
    return (
        f"sum(exp(lgamma(({d1} + {d2}) / 2.0) - lgamma({d1} / 2.0) - lgamma({d2} / 2.0)"
        f" + {d1} / 2.0 * ln({d1} / CAST({d2} AS DOUBLE)) + ({d1} / 2.0 - 1) * ln({x})"
        f" - ({d1} + {d2}) / 2.0 * ln(1 + {d1} * {x} / {d2})) * {TAIL_W})"
    )
