"""Pearson and Spearman correlation matrices."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions.columns import (
    column_aggregates,
    double_literal,
    long_numbers,
    number,
    quoted,
    ref,
    text_literal,
)
from tallystone.operators.ranks import average_ranks, value_cells
from tallystone.session import materialize

HOT_SHARE = 1000  # a value held by at least 1/HOT_SHARE of a column's rows is joined by broadcast
PAIRS_PER_AGG = 100  # pairs of one aggregate
CELLS_PER_PART = 1_000_000  # cells that a task ranks, joins or groups, whatever the splits and shuffle settings
NO_HOLES = ""

Pair = tuple[str, str]


def correlation(
    df: DataFrame, columns: Sequence[str], method: str = "spearman", key: str | None = None
) -> DataFrame:
    """Rows ``(x, y, correlation)`` for every pair with x listed before y, pairwise complete.

    ``spearman`` brings the ranks of a row together by ``key``, which must be unique.
    Without one the tested columns are written once with a row number of their own.
    """
    pairs = list(combinations(columns, 2))
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown correlation method: {method}")
    row_key = F.monotonically_increasing_id() if key is None else ref(key)
    keyed = [row_key.alias("_key")] if method == "spearman" else []
    wide = df.select(*keyed, *[number(df, c).alias(c) for c in columns])
    if method == "spearman" and key is None:
        wide = materialize(wide, "keyed")
    if method == "pearson":
        return _pair_correlations(wide, {p: p for p in pairs})
    patterns = _hole_patterns(wide, columns)
    sources: dict[Pair, Pair] = {}
    masked: dict[str, Pair] = {}
    for x, y in pairs:
        # each pair is judged over the rows where both are present: a column is ranked once for each
        # hole pattern that it meets, however many columns share the pattern
        sides = []
        for c, other in ((x, y), (y, x)):
            if patterns[other] in (NO_HOLES, patterns[c]):
                sides.append(c)
            else:
                sides.append(f"{c}\0{patterns[other]}")
                masked[sides[-1]] = (c, other)
        sources[x, y] = (sides[0], sides[1])
    needed = sorted({c for s in sources.values() for c in s})
    shaped = wide.select(
        "_key",
        *[
            (F.when(ref(masked[c][1]).isNotNull(), ref(masked[c][0])) if c in masked else ref(c)).alias(c)
            for c in needed
        ],
    )
    ranked = _ranked(shaped, needed)
    if len(pairs) > PAIRS_PER_AGG:  # read once for each group of pairs
        ranked = materialize(ranked, "matrix")
    return _pair_correlations(ranked, sources)


def _hole_patterns(wide: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """A name for the set of rows in which a column is missing; equal sets have equal names."""
    fields = {
        "n": "count_if({v} IS NULL)",
        "code": "coalesce(bit_xor(CASE WHEN {v} IS NULL THEN xxhash64(`_key`) END), 0L)",
    }
    found = column_aggregates(wide, columns, fields).collect()  # one row per column
    return {r["column"]: f"{r['n']}:{r['code']}" if r["n"] else NO_HOLES for r in found}


def _ranked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per key with each column replaced by its average rank.

    Ranks are looked up by value. Values frequent enough to make a join task hot
    number at most ``HOT_SHARE`` per column and are joined by broadcast; their
    rows are spread over salted keys, so no join partition holds a hot value.
    Every step is dealt into parts of about ``CELLS_PER_PART`` cells.
    """
    totals = column_aggregates(df, columns, {"n": "count({v})"}).collect()
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-sum(n for _, n in totals) // CELLS_PER_PART))
    df = df.repartition(parts, "_key")
    ranks = materialize(  # read twice below
        average_ranks(value_cells(df, columns)).select("column", "value", "ties", "rank"), "ranks"
    )
    floor = F.expr(
        "CASE "
        + " ".join(
            f"WHEN `column` = {text_literal(c)} THEN {double_literal(max(2.0, n / HOT_SHARE))}" for c, n in totals
        )
        + " END"
    )
    hot = ranks.where(F.col("ties") >= floor).select("column", "value", F.col("rank").alias("hot_rank"))
    cells = long_numbers(df, columns, ["_key"]).join(F.broadcast(hot), ["column", "value"], "left")
    is_hot = F.col("hot_rank").isNotNull()
    salted = cells.select(
        "_key",
        "column",
        "hot_rank",
        F.when(~is_hot, F.col("value")).alias("value"),
        F.when(is_hot, F.pmod(F.xxhash64("_key"), F.lit(HOT_SHARE))).otherwise(F.lit(-1)).alias("salt"),
    )
    found = salted.repartition(parts, "column", "value", "salt").join(
        ranks.select("column", "value", "rank", F.lit(-1).cast("long").alias("salt")),
        ["column", "value", "salt"],
        "left",
    )
    rank = F.coalesce("hot_rank", "rank")
    return found.repartition(parts, "_key").groupBy("_key").agg(
        *[F.max(F.when(F.col("column") == c, rank)).alias(c) for c in columns]
    )


def _pair_correlations(wide: DataFrame, sources: dict[Pair, Pair]) -> DataFrame:
    """Pearson per pair; the two sides of a pair are missing together. No spread gives no value."""

    def corr(a: str, b: str) -> str:
        both = f"{quoted(a)} IS NOT NULL AND {quoted(b)} IS NOT NULL"
        x, y = (f"CASE WHEN {both} THEN {quoted(c)} END" for c in (a, b))
        # by the extremes: merged partial deviations of a constant may differ from 0 by rounding
        spread = f"min({x}) < max({x}) AND min({y}) < max({y})"
        return f"CASE WHEN {spread} THEN try_divide(covar_pop({x}, {y}), stddev_pop({x}) * stddev_pop({y})) END"

    items = list(sources.items())
    out = None
    for start in range(0, len(items), PAIRS_PER_AGG):
        chunk = items[start : start + PAIRS_PER_AGG]
        row = wide.selectExpr(*[f"{corr(*src)} AS p{i}" for i, (_, src) in enumerate(chunk)])
        structs = [
            f"named_struct('x', {text_literal(x)}, 'y', {text_literal(y)}, 'correlation', p{i})"
            for i, ((x, y), _) in enumerate(chunk)
        ]
        part = row.selectExpr(f"inline(array({', '.join(structs)}))")
        out = part if out is None else out.unionByName(part)
    return out


def heatmap_cells(df: DataFrame, columns: Sequence[str], method: str = "spearman", key: str | None = None) -> DataFrame:
    """The full square of a correlation matrix as ``(x, y, correlation)``, 2 decimals."""
    upper = correlation(df, columns, method, key)
    flipped = upper.select(F.col("y").alias("x"), F.col("x").alias("y"), "correlation")
    diagonal = df.sparkSession.createDataFrame(
        [(c, c, 1.0) for c in columns], "x string, y string, correlation double"
    )
    return (
        upper.unionByName(flipped)
        .unionByName(diagonal)
        .withColumn("correlation", F.round("correlation", 2))
    )
