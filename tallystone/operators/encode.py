"""One-hot and label encoding with categories taken from the fitted table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.columns import long_strings, ref
from tallystone.operators.selectors import CheckFailed

OTHER = "other"

#: Categories of a column that are allowed without asking for more: each becomes a column of the result.
MOST_CATEGORIES = 1000

ONE_HOT_SCHEMA = "column string, position int, category string, grouped boolean"


def fit_one_hot(
    df: DataFrame,
    columns: Sequence[str],
    max_categories: int | None = None,
    limit: int = MOST_CATEGORIES,
) -> DataFrame:
    """Sorted categories per column; position 0 is the dropped level.

    ``max_categories`` keeps the most frequent ones and folds the rest into
    ``other``. Without it every category becomes a column, and a column with more categories than ``limit`` is refused; the
    driver sees one level more than that at most.
    """
    counts = long_strings(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    keep = max_categories if max_categories is not None else limit
    # the rank filter leaves at most keep + 1 rows per column
    w = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    top = counts.withColumn("at", F.row_number().over(w)).where(F.col("at") <= keep + 1).collect()
    rows: list[tuple] = []
    for c in columns:
        found = sorted((r for r in top if r["column"] == c), key=lambda r: (-r["n"], r["value"]))
        over = len(found) > keep
        if over and max_categories is None:
            raise ValueError(f"{c} has more than {limit} categories")
        names = sorted(r["value"] for r in found[:keep])
        if over and OTHER not in names:
            names = sorted([*names, OTHER])
        rows += [(c, i, name, over) for i, name in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, ONE_HOT_SCHEMA)


def apply_one_hot(df: DataFrame, params: DataFrame, drop_first: bool = True) -> DataFrame:
    """Replace each fitted column by 0/1 columns ``{column}_{category}`` at the end of the row.

    A missing or unseen value gives all zeros, unless the column has an ``other`` level.
    """
    fitted: dict[str, list] = {}
    for r in sorted(params.collect(), key=lambda r: r["position"]):
        fitted.setdefault(r["column"], []).append(r)
    fitted = {c: fitted[c] for c in fitted if c in df.columns}
    new = []
    for c in [c for c in df.columns if c in fitted]:
        names = [r["category"] for r in fitted[c]]
        value = ref(c).cast("string")
        if fitted[c][0]["grouped"]:
            value = F.when(value.isNull() | value.isin(names), value).otherwise(OTHER)
        for name in names[1 if drop_first else 0 :]:
            hit = F.coalesce(value == name, F.lit(False))
            new.append(hit.cast("int").alias(f"{c}_{name}"))
    rest = [ref(c) for c in df.columns if c not in fitted]
    return df.select(*rest, *new)


def label_encode(df: DataFrame, column: str, positive: str, negative: str) -> DataFrame:
    """Map two values to 1 and 0; anything else becomes NULL."""
    v = ref(column).cast("string")
    return df.withColumn(column, F.when(v == positive, 1).when(v == negative, 0))


def unmapped_labels(df: DataFrame, column: str, positive: str, negative: str) -> DataFrame:
    """The values label encoding would lose, with their row counts."""
    v = ref(column).cast("string")
    bad = df.where(v.isNull() | ~v.isin(positive, negative))
    return bad.groupBy(v.alias("value")).agg(F.count("*").alias("n"))


def align_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring a table to the given columns and order: absent ones are 0, extra ones dropped."""
    return df.select(*[ref(c) if c in df.columns else F.lit(0).alias(c) for c in columns])


def require_same_features(train: DataFrame, other: DataFrame) -> None:
    """Names and order must agree, not only the number of columns."""
    if train.columns != other.columns:
        odd = sorted(set(train.columns) ^ set(other.columns)) or "same names in another order"
        raise CheckFailed(f"feature columns differ: {odd}")
