"""Exact nearest neighbours by a tree of blocks: work that a bound can rule out is never sent to a task.

Donors are dealt into blocks of even size by cuts along their widest axes; the cuts come from a sample, the bounding boxes of the
blocks from all donors. Every query first searches the block that it falls into, which gives a bound on its k-th nearest distance, and
then only those other blocks whose box is not farther than that. Inside a block the same cuts go on down to small leaves, which are
searched nearest first and left out by the same rule. So the pairs measured for a query depend on ``k`` and on the shape of the data, not
on the number of donors. The result is that of comparing all pairs.

Groups ``g`` are searched each by itself, with vectors of their own length.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.session import materialize

#: Donors of a block that the cuts are taken from.
SAMPLED = 64
#: Donors of a leaf inside a block.
LEAF = 50
#: Queries that are measured at once.
BATCH = 1000
#: Relative slack of the bounds, far above the rounding of distances.
SLACK = 1e-9


@dataclass
class Neighbours:
    """``found``: ``(g, x, d, distance, v)``, the k nearest donors of every query vector, by distance and then key.

    ``work``: ``(g, queries, donors, pairs)``, the distances that were measured, after equal vectors were merged.
    """

    found: DataFrame
    work: DataFrame


def nearest_donors(
    queries: DataFrame, donors: DataFrame, k: int, queries_per_block: int = 20_000, donors_per_block: int = 20_000
) -> Neighbours:
    """The ``k`` nearest donors ``(g, d, x, v)`` of every query vector ``(g, x)``; ``v`` is handed on.

    Vectors are arrays of doubles without holes. Equal distances go to the lower ``d``. Of equal donor vectors only the ``k`` lowest
    keys can be among the nearest, equal query vectors are searched once. A task holds a block of donors (about ``donors_per_block``) and
    at most about ``queries_per_block`` queries at a time.
    """
    spark = queries.sparkSession
    first = Window.partitionBy("g", "x").orderBy("d")
    donors = donors.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= k).drop("_at")
    donors = materialize(donors, "donors")
    queries = materialize(queries.select("g", "x").distinct(), "queries")
    sizes = {r["g"]: r["count"] for r in donors.groupBy("g").count().collect()}  # one row per group
    kind = lambda c: donors.schema[c].dataType.simpleString()
    trees = spark.sparkContext.broadcast(_trees(donors, sizes, donors_per_block))

    def deal(batches):
        for pdf in batches:
            cell = np.full(len(pdf), -1, np.int32)  # stays for a group without donors
            for g, rows, x in _by_group(pdf):
                if g in trees.value:
                    cell[rows] = _place(trees.value[g], x)
            yield pdf.assign(cell=cell)

    schema = f"g {kind('g')}, d {kind('d')}, x array<double>, v {kind('v')}"
    cells = materialize(donors.select("g", "d", "x", "v").mapInPandas(deal, f"{schema}, cell int"), "cells")
    axes = cells.select("g", "cell", F.posexplode("x").alias("axis", "c")).groupBy("g", "cell", "axis")
    facts = axes.agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).collect()  # one row a block and axis
    boxes = spark.sparkContext.broadcast(_boxes(facts))

    def search(asked: DataFrame, at_home: bool) -> DataFrame:
        """Queries ``(g, x, cell)`` against the donors of their block."""
        blocks = asked.groupBy("g", "cell").agg(F.ceil(F.count("*") / queries_per_block).cast("int").alias("qn"))
        blocks = F.broadcast(materialize(blocks, "blocks"))  # one row a block
        left = asked.join(blocks, ["g", "cell"]).withColumn("qb", F.pmod(F.xxhash64("x"), F.col("qn")).cast("int")).drop("qn")
        right = cells.join(blocks, ["g", "cell"]).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qn") - 1))).drop("qn")
        block = ["g", "cell", "qb"]
        return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(
            lambda a, b: _measure(a, b, k, boxes.value if at_home else None), f"{schema}, distance double, pairs long, more boolean, visits array<int>"
        )

    home = queries.mapInPandas(deal, f"g {kind('g')}, x array<double>, cell int").where("cell >= 0")
    home = materialize(search(materialize(home, "home"), True), "nearest")
    visits = home.where("visits IS NOT NULL").select("g", "x", F.explode("visits").alias("cell"))
    away = materialize(search(materialize(visits, "visits"), False), "tried")
    best = Window.partitionBy("g", "x").orderBy("distance", "d")
    met = home.where("more").unionByName(away).withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= k)
    columns = ["g", "x", "d", "distance", "v"]
    found = home.where("NOT more").select(*columns).unionByName(met.select(*columns))
    counted = queries.groupBy("g").agg(F.count("*").alias("queries"))
    all_sizes = spark.createDataFrame(list(sizes.items()), f"g {kind('g')}, donors long")
    pairs = home.select("g", "pairs").unionByName(away.select("g", "pairs")).groupBy("g").agg(F.sum("pairs").alias("pairs"))
    work = counted.join(F.broadcast(all_sizes), "g").join(pairs, "g", "left")
    return Neighbours(found, work.na.fill(0, ["pairs"]))


def _trees(donors: DataFrame, sizes: dict, donors_per_block: int) -> dict[object, object]:
    """Cuts of every group into blocks of about ``donors_per_block`` donors, from those of the lowest hashes."""
    share = min(1.0, SAMPLED / donors_per_block)
    place = F.shiftrightunsigned(F.xxhash64("x"), 11) / F.lit(float(2**53))
    large = [g for g, n in sizes.items() if n > donors_per_block]
    some = donors.where(F.col("g").isin(large) & (place < share)).select("g", "x").collect() if large else []  # SAMPLED a block
    found = defaultdict(list)
    for r in some:
        found[r["g"]].append(r["x"])
    most = max(1, int(donors_per_block * share))
    return {g: _cut(np.array(found[g], float), most)[0] if g in found else 0 for g in sizes}


def _cut(x: np.ndarray, most: int) -> tuple[object, list[np.ndarray]]:
    """A tree ``(axis, cut, below, above)`` with the numbers of its leaves at the ends, and the rows of each leaf: ``most``, or all equal."""
    leaves: list[np.ndarray] = []

    def halve(rows: np.ndarray):
        spread = np.ptp(x[rows], axis=0) if len(rows) > most and x.shape[1] else np.zeros(1)
        axis = int(spread.argmax())
        if not spread[axis] > 0:
            leaves.append(rows)
            return len(leaves) - 1
        c = x[rows, axis]
        cut = np.partition(c, (len(c) - 1) // 2)[(len(c) - 1) // 2]
        if cut == c.max():
            cut = c[c < cut].max()
        low = c <= cut
        return axis, cut, halve(rows[low]), halve(rows[~low])

    return halve(np.arange(len(x))), leaves


def _place(tree, x: np.ndarray) -> np.ndarray:
    """The leaf that each row falls into."""
    out, left = np.zeros(len(x), np.int32), [(tree, np.arange(len(x)))]
    while left:
        node, rows = left.pop()
        if isinstance(node, tuple):
            axis, cut, below, above = node
            low = x[rows, axis] <= cut
            left += [(below, rows[low]), (above, rows[~low])]
        else:
            out[rows] = node
    return out


def _by_group(pdf: pd.DataFrame):
    """Group, its row numbers and its vectors as a matrix."""
    for g, rows in pdf.groupby("g", sort=False).indices.items():
        yield g, rows, np.stack(pdf["x"].to_numpy()[rows]).astype(float)


def _boxes(facts: list) -> dict:
    """Per group: the numbers of its blocks, their donors, and the least and greatest value of each block and axis."""
    found = defaultdict(lambda: defaultdict(dict))
    for r in facts:
        found[r["g"]][r["cell"]][r["axis"]] = (r["n"], r["low"], r["high"])
    out = {}
    for g, blocks in found.items():
        numbers = np.array(sorted(blocks), np.int32)
        rows = np.array([[blocks[c][j] for j in sorted(blocks[c])] for c in numbers.tolist()], float)
        out[g] = (numbers, rows[:, 0, 0], rows[:, :, 1], rows[:, :, 2])
    return out


def _gaps(x: np.ndarray, low: np.ndarray, high: np.ndarray, far: bool = False) -> np.ndarray:
    """Distance of each row to the nearest (or farthest) point of each box."""
    out = np.zeros((len(x), len(low)))
    for j in range(x.shape[1]):
        above, below = x[:, j, None] - high[None, :, j], low[None, :, j] - x[:, j, None]
        gap = np.maximum(-above, -below) if far else np.maximum(np.maximum(above, below), 0)
        out += gap * gap
    return np.sqrt(out)


def _search(x: np.ndarray, points: np.ndarray, k: int):
    """For each row of ``x`` the distances and numbers of the ``k`` nearest points, by distance and then number (-1: there are fewer), and
    how many were measured."""
    _, leaves = _cut(points, LEAF)
    low, high = (np.stack([f(points[rows], axis=0) for rows in leaves]) for f in (np.min, np.max))
    width = max(map(len, leaves))
    members = np.full((len(leaves), width), -1)
    for i, rows in enumerate(leaves):
        members[i, : len(rows)] = rows
    best, who, pairs = np.full((len(x), k), np.inf), np.full((len(x), k), -1), np.zeros(len(x), np.int64)

    def measure(rows: np.ndarray, leaf: np.ndarray) -> None:
        some = members[leaf]
        gap = points[some] - x[rows][:, None, :]
        away = np.where(some >= 0, np.sqrt((gap * gap).sum(axis=2)), np.inf)
        pairs[rows] += (some >= 0).sum(axis=1)
        away, some = np.hstack([best[rows], away]), np.hstack([who[rows], some])
        # those not nearer than the k-th distance found so far sink; ties at it are settled by number
        near = np.lexsort((np.where(some < 0, len(points), some), away), axis=1)[:, :k]
        best[rows], who[rows] = np.take_along_axis(away, near, 1), np.take_along_axis(some, near, 1)

    for start in range(0, len(x), BATCH):
        rows = np.arange(start, min(start + BATCH, len(x)))
        away = _gaps(x[rows], low, high)
        own = away.argmin(axis=1)
        measure(rows, own)
        away[np.arange(len(rows)), own] = np.nan  # done
        with np.errstate(invalid="ignore"):
            at, leaf = np.nonzero(away <= best[rows, k - 1, None] * (1 + SLACK))
        gap = away[at, leaf]
        order = np.lexsort((gap, at))
        at, leaf, gap = at[order], leaf[order], gap[order]
        turn = np.arange(len(at)) - np.searchsorted(at, at)  # nearest leaf first
        by_turn = np.argsort(turn, kind="stable")
        ends = np.searchsorted(turn[by_turn], np.arange(turn.max(initial=-1) + 2))
        for i in range(len(ends) - 1):
            now = by_turn[ends[i] : ends[i + 1]]
            now = now[gap[now] <= best[rows[at[now]], k - 1] * (1 + SLACK)]
            if len(now):
                measure(rows[at[now]], leaf[now])
    return best, who, pairs


def _measure(queries: pd.DataFrame, donors: pd.DataFrame, k: int, boxes: dict | None = None) -> pd.DataFrame:
    """The ``k`` nearest donors of one block for each query; the pairs of a query stand in its first row.

    With ``boxes`` the other blocks that may hold nearer donors stand there too, and ``more`` marks all rows of such a query.
    """
    columns = ["g", "d", "x", "v", "distance", "pairs", "more", "visits"]
    if queries.empty or donors.empty:
        return pd.DataFrame(columns=columns)
    donors = donors.sort_values("d", kind="stable")
    points, x = (np.stack(side["x"].to_numpy()).astype(float) for side in (donors, queries))
    best, who, pairs = _search(x, points, k)
    at, nth = np.nonzero(who >= 0)
    first = nth == 0
    g = queries["g"].iloc[0]
    out = pd.DataFrame({
        "g": queries["g"].to_numpy()[at], "d": donors["d"].to_numpy()[who[at, nth]], "x": queries["x"].to_numpy()[at],
        "v": donors["v"].to_numpy()[who[at, nth]], "distance": best[at, nth], "pairs": np.where(first, pairs[at], 0),
    })
    visits = np.full(len(queries), None, object)
    if boxes is not None and g in boxes:  # vectors without axes have one block
        numbers, sizes, low, high = boxes[g]
        others = numbers != donors["cell"].iloc[0]
        for start in range(0, len(x) if others.any() else 0, BATCH):
            some = slice(start, start + BATCH)
            reach = best[some, k - 1]
            if np.isinf(reach).any():  # fewer than k donors here: boxes that hold k lie within this distance
                far = _gaps(x[some], low, high, far=True)
                order = far.argsort(axis=1)
                enough = (sizes[order].cumsum(axis=1) >= k).argmax(axis=1)
                bound = np.where(sizes.sum() >= k, np.take_along_axis(far, order, 1)[np.arange(len(far)), enough], np.inf)
                reach = np.minimum(reach, bound)
            near = (_gaps(x[some], low, high) <= reach[:, None] * (1 + SLACK)) & others[None, :]
            for i in np.flatnonzero(near.any(axis=1)):
                visits[start + i] = numbers[near[i]].tolist()
    more = np.array([v is not None for v in visits], bool)
    out["more"] = more[at]
    out["visits"] = np.where(first, visits[at], None)
    return out[columns]
