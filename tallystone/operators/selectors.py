"""Column selection, schema/type/range checks and threshold filters."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.functions.columns import (
    categorical_columns,
    column_aggregates,
    double_literal,
    is_float,
    is_numeric,
    missing_sql,
    numeric_columns,
    quoted,
    ref,
    text_literal,
)


class CheckFailed(ValueError):
    """A table failed a schema, type, range or feature check."""


CHECK_SCHEMA = "check string, column string, severity string, detail string"


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*[ref(c) for c in numeric_columns(df, exclude)])


def select_categorical(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*[ref(c) for c in categorical_columns(df, exclude)])


def drop_columns(df: DataFrame, reasons: Mapping[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """Drop the listed columns that exist; also return the reasons of those dropped."""
    dropped = {c: why for c, why in reasons.items() if c in df.columns}
    return df.drop(*[ref(c) for c in dropped]), dropped


def mask_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace personal values by their SHA-256 digest; equal values stay equal, missing stays missing."""
    return df.withColumns({c: F.sha2(ref(c).cast("string"), 256) for c in columns if c in df.columns})


def filter_rows(df: DataFrame, condition: Column | str, columns: Sequence[str] | None = None) -> DataFrame:
    kept = df.where(condition)
    return kept.select(*[ref(c) for c in columns]) if columns else kept


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def column_info(df: DataFrame) -> DataFrame:
    """Name, type and non-missing count of every column."""
    dtypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    fields = {
        "dtype": lambda c: f"any_value({text_literal(dtypes[c])})",
        "non_null": lambda c: f"count_if(NOT {missing_sql(df, c)})",
    }
    return column_aggregates(df, df.columns, fields, value=missing_sql)


def schema_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """A missing column is an error, an extra one a warning. Works on names, no data is read."""
    rows = [("schema", c, "error", "missing column") for c in expected if c not in df.columns]
    rows += [("schema", c, "warning", "extra column") for c in df.columns if c not in set(expected)]
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


def dtype_report(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> DataFrame:
    """Numeric expected but not numeric is an error; categorical that is numeric a warning."""
    types: dict[str, T.DataType] = {f.name: f.dataType for f in df.schema.fields}
    rows = [
        ("dtype", c, "error", f"expected numeric, got {types[c].simpleString()}")
        for c in numeric
        if c in types and not is_numeric(types[c])
    ]
    rows += [
        ("dtype", c, "warning", f"expected categorical, got {types[c].simpleString()}")
        for c in categorical
        if c in types and is_numeric(types[c])
    ]
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


def range_check(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Values outside inclusive bounds, for all columns in one aggregate. Missing values pass.

    Whole-number and decimal columns are compared in their own type, so that large keys keep all digits.
    """
    columns = [c for c in bounds if c in df.columns]

    def beyond(side: int, sign: str):
        def text(c: str) -> str:
            limit = bounds[c][side]
            if limit is None:
                return "count_if(false)"
            if is_float(df.schema[c].dataType) or math.isinf(limit) or int(limit) != limit:
                return f"count_if({{v}} {sign} {double_literal(float(limit))})"
            return f"count_if({quoted(c)} {sign} {int(limit)}BD)"

        return text

    fields = {
        "n_below": beyond(0, "<"),
        "n_above": beyond(1, ">"),
        "observed_min": "min({v})",
        "observed_max": "max({v})",
    }
    report = column_aggregates(df, columns, fields)
    return report.withColumn("passed", (F.col("n_below") == 0) & (F.col("n_above") == 0))


def validate(
    df: DataFrame,
    expected: Sequence[str] | None = None,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Schema, type and range checks in that order; any error raises. Returns the table unchanged."""
    reports = []
    if expected:
        reports.append(schema_report(df, expected))
    reports.append(dtype_report(df, numeric, categorical))
    errors = [tuple(r) for rep in reports for r in rep.where("severity = 'error'").collect()]
    if not errors and bounds:
        errors = [tuple(r) for r in range_check(df, bounds).where("not passed").collect()]
    if errors:
        raise CheckFailed("; ".join(str(e) for e in errors))
    return df


def alias_all(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{quoted(c)} AS {quoted(names.get(c, c))}" for c in df.columns])
