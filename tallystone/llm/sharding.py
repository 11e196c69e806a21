"""Reproducible shuffle into shards: a Feistel permutation over global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm.common import materialize, pick, power_of_two

ROUNDS = 6
MOST_WALKS = 64


def number_rows(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` (a written table) with a gapless ``row_number`` from 0, and their count.

    Rows are dealt to about sqrt(n) buckets by a hash of ``order`` and numbered inside each; the
    buckets' starts are one running sum over the sqrt(n) counts. The number depends on the rows
    alone, not on files or partitions; rows equal in ``order`` cannot be told apart.
    """
    total = rows.count()
    buckets = power_of_two(math.sqrt(max(1, total)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy(*order)) - 1
    numbered = rows.withColumn("inside", inside).join(F.broadcast(starts), "bucket")
    return numbered.withColumn("row_number", F.col("start") + F.col("inside")).drop("bucket", "inside", "start"), total


def feistel(number: Column, left: int, right: int, seed: int) -> Column:
    """One pass of the network over 0 .. left*right-1, a permutation whatever the round function.

    A number is the pair (number div right, number mod right); rounds add a hash of one half to the
    other, in turn, each modulo its own size.
    """
    b = F.pmod(number, F.lit(right))
    a = ((number - b) / F.lit(right)).cast("long")
    for k in range(ROUNDS):
        if k % 2 == 0:
            a = F.pmod(a + F.pmod(F.xxhash64(b, F.lit(seed), F.lit(k)), F.lit(left)), F.lit(left))
        else:
            b = F.pmod(b + F.pmod(F.xxhash64(a, F.lit(seed), F.lit(k)), F.lit(right)), F.lit(right))
    return a * F.lit(right) + b


def permute(number: Column, total: int, seed: int = 0) -> Column:
    """A permutation of 0 .. total-1: the network over the next rectangle, walked until it lands inside.

    The rectangle left*right exceeds ``total`` by less than ``left`` (about sqrt(total)), so a walk
    needs more than one step for about one row in sqrt(total). A walk can meet each outside number
    once at most; where the rectangle has over 64 of them, a longer walk has a chance below
    total**-32 and raises an error instead of a wrong place.
    """
    right = max(1, math.isqrt(max(0, total - 1)) + 1)
    left = max(1, -(-total // right))
    outside = left * right - total
    first = feistel(number, left, right, seed)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(outside, MOST_WALKS) + 1)),
        first,
        lambda x, _: F.when(x < total, x).otherwise(feistel(x, left, right, seed)),
    )
    return F.when(first < total, first).when(walked < total, walked).otherwise(
        F.raise_error(F.lit("a walk left the rectangle too often")).cast("long")
    )


def shard(
    docs: DataFrame, shards: int = 8, seed: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Deal all rows to ``shards`` in a shuffled order that can be computed again.

    The place of a row is the permuted row number p: shard = p mod shards, slot = p div shards. So
    shard sizes in rows differ by one at most, and slots are gapless. Only hashes and sizes of
    the texts are kept between the passes.

    Returns ``doc_id, size, text_crc32, row_number, shard, slot``. NULL text counts as empty (size 1,
    CRC 0); rows with a NULL or repeated key each get a place of their own; an empty table gives none;
    other columns are not read.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(docs, **{key: "doc_id", text: "text"}).select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    numbered, total = number_rows(materialize(rows, "shard-rows"), ["doc_id", "text_crc32", "size"])
    placed = numbered.withColumn("place", permute(F.col("row_number").cast("long"), total, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", "row_number",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"),
    )
