"""Column helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """Reference a column by its exact name, whatever characters it holds."""
    return F.col(quoted(name))


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if not is_numeric(f.dataType) and f.name not in skip]


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that NULL is the only missing value."""
    c = ref(name)
    return F.nanvl(c, F.lit(None)) if is_float(df.schema[name].dataType) else c


def missing(df: DataFrame, name: str) -> Column:
    return present(df, name).isNull()


def number(df: DataFrame, name: str) -> Column:
    return present(df, name).cast("double")


def finite_or_zero(c: Column) -> Column:
    """Inf, NaN and NULL become 0; NaN sorts above Inf, so one comparison finds them all."""
    return F.when(F.abs(c) < float("inf"), c).otherwise(0.0)


def long_numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows ``(keep…, column, value)``: one per non-missing numeric cell."""
    wide = df.select(*[ref(k) for k in keep], *[number(df, c).alias(c) for c in columns])
    long = wide.unpivot([ref(k) for k in keep], [ref(c) for c in columns], "column", "value")
    return long.where(F.col("value").isNotNull())


def long_strings(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows ``(keep…, column, value)``: one per non-missing cell, values as text."""
    wide = df.select(
        *[ref(k) for k in keep], *[present(df, c).cast("string").alias(c) for c in columns]
    )
    long = wide.unpivot([ref(k) for k in keep], [ref(c) for c in columns], "column", "value")
    return long.where(F.col("value").isNotNull())


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double_literal(value: float) -> str:
    return f"double('{value!r}')"


def number_sql(df: DataFrame, name: str) -> str:
    """SQL text of :func:`number`."""
    cast = f"CAST({quoted(name)} AS DOUBLE)"
    return f"nanvl({cast}, CAST(NULL AS DOUBLE))" if is_float(df.schema[name].dataType) else cast


def missing_sql(df: DataFrame, name: str) -> str:
    """SQL text of :func:`missing`."""
    q = quoted(name)
    return f"({q} IS NULL OR isnan({q}))" if is_float(df.schema[name].dataType) else f"({q} IS NULL)"


def column_aggregates(
    df: DataFrame,
    columns: Sequence[str],
    fields: Mapping[str, str | Callable[[str], str]],
    by: Mapping[str, str] | None = None,
    value: Callable[[DataFrame, str], str] = number_sql,
) -> DataFrame:
    """One aggregate over all columns, turned into one row ``(by…, column, field…)`` per column.

    A field is an aggregate in SQL with ``{v}`` for the column's value, or a
    function from the column name to such a text. ``by`` maps group names to
    their SQL. Text keeps building the plan cheap when tables are wide.
    """
    by = by or {}
    aggs = []
    for i, c in enumerate(columns):
        v = value(df, c)
        for f, template in fields.items():
            text = template if isinstance(template, str) else template(c)
            aggs.append(f"{text.replace('{v}', v)} AS `{i}|{f}`")
    if by:
        groups = [F.expr(text).alias(name) for name, text in by.items()]
        wide = df.groupBy(*groups).agg(*[F.expr(a) for a in aggs])
    else:
        wide = df.selectExpr(*aggs)
    structs = [
        f"named_struct('column', {text_literal(c)}, "
        + ", ".join(f"{text_literal(f)}, `{i}|{f}`" for f in fields)
        + ")"
        for i, c in enumerate(columns)
    ]
    return wide.selectExpr(*[quoted(b) for b in by], f"inline(array({', '.join(structs)}))")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the table: {absent}")


def order_key(name: str, seed: int) -> Column:
    """A reproducible pseudo-random order over rows: md5 of key and seed, as hex text."""
    return F.md5(F.concat(ref(name).cast("string"), F.lit(f"-{seed}")))
