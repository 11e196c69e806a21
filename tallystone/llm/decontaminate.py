"""Benchmark passages in documents, found by winnowed word k-grams.

Of every 13 words in a row the smallest k-gram hash is kept as their fingerprint. Two equal runs
of 13 words have the same fingerprint, so every shared run of that length is met; a fingerprint
that a document shares with an item is extended to the whole run by comparing the run's hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import (
    ALNUM_BREAK, chunks, materialize, ngram_hashes, pick, row_mark, scan, signed, split_words,
)
from tallystone.llm.filters import bit_filter, in_filter

WINDOW, K = 13, 5


def _windows(words: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run of ``window`` words: the smallest hash of its k-grams, and the hash of the run."""
    grams = ngram_hashes(words, k)
    count = max(0, len(words) - window + 1)
    least = grams[:count].copy()
    for j in range(1, window - k + 1):
        np.minimum(least, grams[j : j + count], out=least)
    return least, ngram_hashes(words, window)


def item_windows(items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """``item_id, fingerprint, run, size``: the runs of each item; shorter items are one run of their own size."""

    def work(got, n):
        ids, prints, runs, sizes = [], [], [], []
        texts = [t or b"" for t in got["text"]]
        for lo, hi in chunks(texts):
            words, begins = split_words(texts[lo:hi], ALNUM_BREAK)
            for i in range(hi - lo):
                own = words[begins[i] : begins[i + 1]]
                if not len(own):
                    continue
                if len(own) >= window:
                    least, run = _windows(own, window, k)
                else:
                    least = run = ngram_hashes(own, len(own))
                ids += [got["item_id"][lo + i]] * len(run)
                prints.append(signed(least))
                runs.append(signed(run))
                sizes += [min(window, len(own))] * len(run)
        if not ids:
            return None
        ids = [x.decode() if isinstance(x, bytes) else x for x in ids]
        return [pa.array(ids, pa.string()), pa.array(np.concatenate(prints)), pa.array(np.concatenate(runs)), pa.array(sizes, pa.int32())]

    return scan(items, work, "item_id string, fingerprint long, run long, size int", ["item_id", "text"]).distinct()


HITS = "array<struct<fingerprint:bigint,run:bigint,at:int>>"
_HIT = pa.struct([("fingerprint", pa.int64()), ("run", pa.int64()), ("at", pa.int32())])


def candidate_runs(docs: DataFrame, table, sizes: list[int], window: int = WINDOW, k: int = K) -> DataFrame:
    """Per row its word count, and the runs whose fingerprint may be one of an item.

    ``sizes`` are the lengths of items shorter than a window: runs of those lengths are tried as a whole.
    """

    def work(got, n):
        counts = np.zeros(n, np.int64)
        texts = [t or b"" for t in got["text"]]
        rows, prints, runs, ats = [], [], [], []
        known = table.value
        for lo, hi in chunks(texts):
            words, begins = split_words(texts[lo:hi], ALNUM_BREAK)
            counts[lo:hi] = np.diff(begins)
            ends = np.repeat(begins[1:], np.diff(begins))  # of each word's text
            for size in [window, *sizes]:
                if size == window:
                    least, run = _windows(words, window, k)
                else:
                    least = run = ngram_hashes(words, size)
                if not len(least):
                    continue
                at = np.flatnonzero(in_filter(known, least) & (np.arange(len(least)) + size <= ends[: len(least)]))
                if len(at):
                    row = np.searchsorted(begins, at, side="right") - 1
                    rows.append(row + lo)
                    prints.append(least[at])
                    runs.append(run[at])
                    ats.append(at - begins[row])
        if rows:
            row = np.concatenate(rows)
            order = np.argsort(row, kind="stable")
            offsets = np.searchsorted(row[order], np.arange(n + 1))
            parts = [np.concatenate(x)[order] for x in (prints, runs, ats)]
        else:
            offsets, parts = np.zeros(n + 1, np.int64), [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        hits = pa.StructArray.from_arrays(
            [pa.array(signed(parts[0])), pa.array(signed(parts[1])), pa.array(parts[2].astype(np.int32))], fields=list(_HIT)
        )
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), hits)
        return [pa.array(got["doc_id"], key), pa.array(got["mark"], pa.int64()), pa.array(counts), lists]

    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    key = to_arrow_type(kind)
    rows = docs.select("doc_id", row_mark().alias("mark"), "text")
    schema = f"doc_id {kind.simpleString()}, mark long, n_words long, hits {HITS}"
    return scan(rows, work, schema, ["doc_id", "mark", "text"])


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Which words of each document lie in a run of ``window`` words of an item.

    Items of fewer words, but not none, count as one run. Texts are read once; only runs whose
    fingerprint passes a bit map of the items' fingerprints are shuffled, and joined on (fingerprint, run).

    Returns one row per document: ``doc_id, mark`` (hash of key and text), ``n_words, n_hit, items`` (sorted ids of
    the items found, as strings) and ``spans`` (sorted ``at, size`` in words). NULL text has no words; a NULL
    item id counts as the empty string; repeated rows and items with one id are fine; without items or
    documents nothing is hit; other columns are not read.
    """
    spark = docs.sparkSession
    rows = pick(docs, **{key: "doc_id", text: "text"})
    named = items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("item_id"), F.col(item_text).alias("text"))
    runs = materialize(item_windows(named, window, k), "item-runs")
    prints = runs.select("fingerprint").distinct()
    table = spark.sparkContext.broadcast(bit_filter(prints, lambda t: t["fingerprint"], prints.count()))
    sizes = sorted(r["size"] for r in runs.select("size").distinct().collect() if r["size"] < window)
    scanned = candidate_runs(rows, table, sizes, window, k).withColumn("row", F.monotonically_increasing_id())
    scanned = materialize(scanned, "candidate-runs")
    found = (
        scanned.filter(F.size("hits") > 0).select("row", F.inline("hits"))
        .join(runs, ["fingerprint", "run"])
        .groupBy("row")
        .agg(
            F.sort_array(F.collect_set(F.struct("at", "size"))).alias("spans"),
            F.sort_array(F.collect_set("item_id")).alias("items"),
        )
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        "spans", zero,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["at"] + s["size"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["at"] + s["size"] - F.greatest(a["end"], s["at"]))).alias("n"),
        ),
    )["n"]
    joined = scanned.drop("hits").join(found, "row", "left")
    return joined.select(
        "doc_id", "mark", "n_words",
        F.when(F.col("spans").isNull(), F.lit(0).cast("long")).otherwise(covered).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "spans",
    )


def contaminated(share: int = 20) -> Column:
    """A document is contaminated when hit words are one in ``share`` or more."""
    return (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))
