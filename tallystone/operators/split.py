"""Exact, reproducible splits, folds and under-sampling without sorting a class in one task.

Rows are ordered by an md5 of key and seed. Instead of numbering the rows, the
order value at each wanted position is found: a histogram over the first digits
of the hash locates its bucket, and only that bucket (1/65536 of a class) is
sorted. Applying a split is then a comparison with constants, with no shuffle,
and gives the same answer on every read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.columns import (
    double_literal,
    order_key,
    quoted,
    ref,
    require_columns,
    text_literal,
)
from tallystone.operators.ranks import running
from tallystone.session import materialize

PREFIX = 4  # hex digits of the histogram: 65536 buckets per class


@dataclass(frozen=True)
class Cutoffs:
    """Per class the order values at the wanted positions, ascending."""

    key: str
    seed: int
    label: str | None
    by_class: dict[str | None, list[str | None]]

    def below(self, index: int) -> Column:
        """True for the rows at or before the cut ``index`` of their class."""
        order = f"md5(concat(CAST({quoted(self.key)} AS STRING), '-{self.seed}'))"
        # a cut at position 0 has no order value: nothing lies before it
        cuts = {c: v[index] for c, v in self.by_class.items() if v[index] is not None}
        if not cuts:
            return F.lit(False)
        if self.label is None:
            return F.expr(f"coalesce({order} <= '{cuts[None]}', false)")
        label = f"CAST({quoted(self.label)} AS STRING)"
        whens = " ".join(
            f"WHEN {label} <=> {'NULL' if c is None else text_literal(c)} THEN '{v}'" for c, v in cuts.items()
        )
        return F.expr(f"coalesce({order} <= CASE {whens} END, false)")

    def fold(self) -> Column:
        """The number of cuts before the row: folds 0 … k-1."""
        n_cuts = max((len(c) for c in self.by_class.values()), default=0)
        return sum((1 - self.below(i).cast("int") for i in range(n_cuts)), F.lit(0))


Counts = dict[str | None, int]

NO_CLASS = "\0"  # stands for a missing class, so that joins on the class need no null handling


def class_counts(df: DataFrame, label: str) -> Counts:
    counts = df.groupBy(ref(label).cast("string").alias("cls")).agg(F.count("*").alias("n"))
    return _counts(counts)


def _counts(rows: DataFrame) -> Counts:
    """Rows per class from ``(cls, n)``, sorted by class."""
    found = rows.collect()  # one row per class
    return _named_counts(found)


def _named_counts(found: Sequence) -> Counts:
    named = {None if r["cls"] == NO_CLASS else r["cls"]: r["n"] for r in found}
    return dict(sorted(named.items(), key=lambda item: (item[0] is None, item[0] or "")))


def fit_cutoffs(
    df: DataFrame,
    key: str,
    label: str | None,
    choose: Callable[[Counts], dict[str | None, list[int]]],
    seed: int,
) -> Cutoffs:
    """Find the order value of the row at each wanted position of its class.

    ``choose`` turns the class sizes into 1-based positions per class; position 0
    lies before all rows. Two scans of key and label, no row is shuffled but those
    in a bucket that holds a cut.
    """
    spark = df.sparkSession
    cls = ref(label).cast("string") if label is not None else F.lit(None).cast("string")
    rows = df.select(F.coalesce(cls, F.lit(NO_CLASS)).alias("cls"), order_key(key, seed).alias("order"))
    rows = rows.withColumn("bucket", F.substring("order", 1, PREFIX))
    # at most 16^PREFIX rows per class
    histogram = materialize(rows.groupBy("cls", "bucket").agg(F.count("*").alias("n")), "buckets")
    sizes = histogram.groupBy("cls").agg(F.sum("n").alias("n"), F.sum(F.when(F.isnull("bucket"), F.col("n"))).alias("keyless"))
    found = sizes.collect()  # one row per class
    if any(r["keyless"] for r in found):
        raise ValueError(f"{key} has missing values: every row needs a key to be placed")
    counts = _named_counts(found)
    positions = choose(counts)
    wanted = spark.createDataFrame(
        [(NO_CLASS if c is None else c, ps) for c, ps in positions.items()], "cls string, wanted array<long>"
    )
    upto = F.sum("n").over(Window.partitionBy("cls").orderBy("bucket"))
    before = F.col("upto") - F.col("n")
    hits = (
        histogram.withColumn("upto", upto)
        .join(F.broadcast(wanted), "cls")  # one row per class
        .select(
            "cls",
            "bucket",
            before.alias("before"),
            F.filter("wanted", lambda p: (p > before) & (p <= F.col("upto"))).alias("positions"),
        )
        .where(F.size("positions") > 0)
    )
    cuts = spark.createDataFrame(hits.collect(), hits.schema)  # at most one row per cut
    numbered = (
        rows.join(F.broadcast(cuts), ["cls", "bucket"])
        .withColumn("rn", F.row_number().over(Window.partitionBy("cls", "bucket").orderBy("order")))
        .select("cls", (F.col("rn") + F.col("before")).alias("position"), "order", "positions")
        .where(F.array_contains("positions", F.col("position")))
    )
    found = {(r["cls"], r["position"]): r["order"] for r in numbered.collect()}
    by_class = {
        c: [found[NO_CLASS if c is None else c, p] if p > 0 else None for p in ps]
        for c, ps in positions.items()
    }
    return Cutoffs(key, seed, label, by_class)


def proportional(counts: Counts, wanted: int) -> Counts:
    """Share ``wanted`` rows over the classes in proportion, largest remainders first."""
    total = sum(counts.values())
    exact = {c: n * wanted / total for c, n in counts.items()}
    share = {c: math.floor(x) for c, x in exact.items()}
    left = wanted - sum(share.values())
    by_remainder = sorted(counts, key=lambda c: (-(exact[c] - share[c]), c is None, c or ""))
    for c in by_remainder[:left]:
        share[c] += 1
    return share


def stratified_split(
    df: DataFrame,
    key: str,
    target: str,
    train_size: float = 0.8,
    test_size: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
    shuffle: bool = True,
    column: str = "split",
) -> DataFrame:
    """Add ``split`` = train/test. The test part has ceil(test_size · n) rows; with ``stratify``
    every class keeps its share. ``shuffle=False`` cuts in key order, whatever the key's type. Keys
    must be unique and present."""
    if not math.isclose(train_size + test_size, 1.0):
        raise ValueError(f"split sizes must sum to 1.0, got {train_size + test_size}")
    require_columns(df, [key, target])
    if not shuffle:
        if stratify:
            raise ValueError("an ordered cut cannot be stratified")
        cut = _ordered_cut(df, key, test_size)
        if cut is None:
            return df.withColumn(column, F.lit("test"))
        train = ref(key) <= F.lit(cut).cast(df.schema[key].dataType)
    else:

        def sizes(counts: Counts) -> dict[str | None, list[int]]:
            n = sum(counts.values())
            return {c: [k] for c, k in proportional(counts, n - math.ceil(test_size * n)).items()}

        train = fit_cutoffs(df, key, target if stratify else None, sizes, seed).below(0)
    return df.withColumn(column, F.when(train, "train").otherwise("test"))


def _ordered_cut(df: DataFrame, key: str, test_size: float):
    """The key of the last train row, in its own type; None when there is no train row."""
    cells = df.groupBy(ref(key).alias("_v")).agg(F.count("*").alias("n"))
    upto = running(cells, [], ["_v"], ["n"])
    size = upto.agg(F.sum("n").alias("n"), F.count_if(F.isnull("_v")).alias("keyless")).first()
    if size["keyless"]:
        raise ValueError(f"{key} has missing values: every row needs a key to be placed")
    n_train = (size["n"] or 0) - math.ceil(test_size * (size["n"] or 0))
    at = upto.where((F.col("n_upto") >= n_train) & (F.col("n_upto") - F.col("n") < n_train)).first()
    return at["_v"] if at else None


def stratified_folds(
    df: DataFrame, key: str, target: str, folds: int = 10, seed: int = 42, column: str = "fold"
) -> DataFrame:
    """Add a fold number 0 … folds-1; every class is spread over the folds as evenly as possible."""

    def even(counts: Counts) -> dict[str | None, list[int]]:
        return {c: [n * i // folds for i in range(1, folds)] for c, n in counts.items()}

    return df.withColumn(column, fit_cutoffs(df, key, target, even, seed).fold())


def under_sample(df: DataFrame, key: str, target: str, seed: int = 42) -> DataFrame:
    """Keep as many rows of each class as the smallest class has."""

    def smallest(counts: Counts) -> dict[str | None, list[int]]:
        return {c: [min(counts.values())] for c in counts}

    return df.where(fit_cutoffs(df, key, target, smallest, seed).below(0))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights ``n / (k · n_class)``, one row per class."""
    counts = df.where(ref(target).isNotNull()).groupBy(ref(target).alias("class")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(F.lit(0))  # one row per class
    return counts.withColumn(
        "weight", F.sum("n").over(w) / (F.count("*").over(w) * F.col("n"))
    )


def with_class_weight(df: DataFrame, target: str, column: str = "weight") -> DataFrame:
    """Add the balanced class weight to every row."""
    counts = {c: n for c, n in class_counts(df, target).items() if c is not None}
    total = sum(counts.values())
    label = f"CAST({quoted(target)} AS STRING)"
    whens = " ".join(
        f"WHEN {label} = {text_literal(c)} THEN {double_literal(total / (len(counts) * n))}" for c, n in counts.items()
    )
    return df.withColumn(column, F.expr(f"CASE {whens} END"))


def split_summary(df: DataFrame, columns: Sequence[str], target: str, split: str = "split") -> DataFrame:
    """Rows, class and feature counts per split."""
    return df.groupBy(split, ref(target).alias("class")).agg(F.count("*").alias("n")).withColumn(
        "n_features", F.lit(len(columns)).cast("bigint")
    )
