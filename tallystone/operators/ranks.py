"""Running counts and average ranks without moving a column into one task.

Every rank test, ECDF, ROC curve and exact quantile rests on :func:`running`.
Raw rows are first reduced to one row per distinct value (map-side combined, so
a value held by a third of all rows costs nothing extra). The distinct values
are range-partitioned; each partition is summed, the few partition totals are
turned into offsets, and the running count is taken inside each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.columns import long_numbers, ref
from tallystone.session import materialize

#: Rows of a range partition: a task sorts some of these, whatever the size of the table and the shuffle settings.
ROWS_PER_RANGE = 500_000


def running(
    cells: DataFrame,
    part: Sequence[str],
    order: Sequence[str | Column],
    counts: Sequence[str],
    bounded: bool = False,
) -> DataFrame:
    """Add ``<count>_upto``: the sum over all rows of ``part`` ordered at or before this one.

    Rows that tie on ``order`` are peers and get the same running sum. Pass
    ``bounded=True`` only when each ``part`` is known to be small; it then uses
    one plain window. ``order`` takes columns or ``Column`` orderings.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]

    def summed(window):
        return {f"{c}_upto": F.sum(c).over(window) for c in counts}

    if bounded:
        w = Window.partitionBy(*part).orderBy(*order)
        return cells.withColumns(summed(w.rangeBetween(Window.unboundedPreceding, 0)))

    cells = materialize(cells, "cells")  # counted, sampled and dealt below
    ranges = max(1, -(-cells.count() // ROWS_PER_RANGE))
    # The partition id is stored as data, so later passes cannot see another partitioning.
    tagged = materialize(
        cells.repartitionByRange(ranges, *[F.col(p) for p in part], *order).withColumn(
            "_pid", F.spark_partition_id()
        ),
        "ranges",
    )
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*part, "_pid")
        .agg(*[F.sum(c).alias(f"_{c}") for c in counts])
        .select(
            *part, "_pid", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in counts]
        )
    )
    # one row per range partition and column
    joined = tagged.join(F.broadcast(offsets), [*part, "_pid"]).repartition(ranges, *[F.col(p) for p in part], "_pid")
    w = Window.partitionBy(*part, "_pid").orderBy(*order)
    w = w.rangeBetween(Window.unboundedPreceding, 0)
    return joined.withColumns(
        {f"{c}_upto": F.col(f"_{c}") + F.sum(c).over(w) for c in counts}
    ).drop("_pid", *[f"_{c}" for c in counts])


def value_cells(df: DataFrame, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """``(column, value[, group], n)``: how often each distinct value occurs."""
    keys = ["column", "value"]
    if group is None:
        return long_numbers(df, columns).groupBy(*keys).agg(F.count("*").alias("n"))
    rows = df.where(ref(group).isNotNull())
    long = long_numbers(rows.withColumn("_group", ref(group).cast("string")), columns, ["_group"])
    return long.groupBy(*keys, F.col("_group").alias("group")).agg(F.count("*").alias("n"))


def average_ranks(cells: DataFrame, part: Sequence[str] = ("column",)) -> DataFrame:
    """Add ``ties`` (rows sharing the value) and ``rank`` (their mean rank) to value cells."""
    cum = running(cells, part, ["value"], ["n"])
    # peers are the groups holding the same value: few rows per window
    ties = F.sum("n").over(Window.partitionBy(*part, "value"))
    return cum.withColumn("ties", ties).withColumn(
        "rank", F.col("n_upto") - (F.col("ties") - 1) / F.lit(2.0)
    )


def tie_term() -> Column:
    """Sum over distinct values of t^3 - t, for cells that carry ``n`` and ``ties``."""
    t = F.col("ties").cast("double")
    return F.sum((t * t - 1.0) * F.col("n"))
