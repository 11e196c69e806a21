"""Quality scores of documents: logistic regression on hashed word n-grams, trained by FTRL."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import _BASE, WORD_BREAK, chunks, materialize, mix, pick, row_mark, scan, split_words

#: Features are hashed to 2**18 places; the last two orders of words count, in two views.
BITS = 18
SIZE = 1 << BITS
#: Values are shares of the text's n-grams times this, so that texts of any length weigh the same.
SCALE = 32.0
#: The labelled rows that are learnt from at most: a sample by hash of the key where there are more.
MOST_LABELLED = 20_000
#: Models trained side by side and then averaged.
PARTS = 8


def _shape_bits() -> np.ndarray:
    """What a byte says about the look of its word."""
    bits = np.zeros(256, np.int64)
    bits[97:123] = 1
    bits[65:91] = 2
    bits[48:58] = 4
    bits[128:] = 8
    for k, group in enumerate((".,;:", "!?", "*#$%&", "|/\\<>=_{}[]", "'\"()-", "@+~^`")):
        for c in group.encode():
            bits[c] = 16 << k
    return bits


_SHAPE = _shape_bits()


def _places(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind)) & np.uint64(SIZE - 1)).astype(np.int64)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams of some texts, and where each text's begin (one more entry at the end).

    Per word: the word, the pair with the word before, and its look (kinds of characters, repeated or not) alone
    and with the looks of one and two words before. A text's first word has no pair.
    """
    words, begins = split_words(texts, WORD_BREAK)
    blob = np.frombuffer(b" ".join(texts), np.uint8)
    inside = np.zeros(len(blob) + 1, np.int8)
    inside[1:] = ~WORD_BREAK[blob]
    starts = np.flatnonzero(np.diff(inside) == 1)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    look = np.bitwise_or.reduceat(_SHAPE[blob], starts).astype(np.uint64)
    first = np.zeros(n, bool)
    first[begins[:-1][begins[:-1] < begins[1:]]] = True
    before = np.concatenate([words[:1], words[:-1]])
    again = (before == words) & ~first
    look = look * np.uint64(2) + again
    blank = np.uint64(1 << 20)
    one = np.where(first, blank, np.concatenate([look[:1], look[:-1]]))
    two = np.where(first, blank, np.concatenate([one[:1], one[:-1]]))
    pair = np.where(first, words, before * _BASE + words)
    views = (words, pair, look, look * _BASE + one, (look * _BASE + one) * _BASE + two)
    places = np.stack([_places(v, k) for k, v in enumerate(views)], axis=1).ravel()
    return places, begins * len(views)


class Follower:
    """Follow-the-regularised-leader (proximal, per coordinate) for logistic loss."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _sparse(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places with their values; the intercept is the place after the last."""
    at, counts = np.unique(places, return_counts=True)
    return np.append(at, SIZE), np.append(counts * (SCALE / max(1, len(places))), 1.0)


def is_held_out(key: Column, of: int = 5, remainder: int = 0) -> Column:
    """By the CRC-32 of the key as text; a NULL key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(of)) == remainder


def train(labelled: DataFrame, epochs: int = 4, seed: int = 7) -> np.ndarray:
    """Weights from rows of ``doc_id, text, y``; ``labelled`` is bounded by the caller.

    Rows are dealt to ``PARTS`` learners by a hash of the key; their weights, at most 2**18 + 1 places, are averaged in Spark.
    """

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "text"])
        seen = []
        for t, y in zip(rows["text"], rows["y"], strict=True):
            seen.append((*_sparse(features([t.encode()])[0]), int(y)))
        model, rng = Follower(), np.random.default_rng(seed)
        for _ in range(epochs):
            for i in rng.permutation(len(seen)):
                model.learn(*seen[i])
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        return pd.DataFrame({"place": at, "w": w[at]})

    order = F.xxhash64("doc_id", F.lit(seed))
    dealt = labelled.select("text", "y", order.alias("order"), F.pmod(order, F.lit(PARTS)).alias("part"))
    parts = dealt.groupBy("part").applyInPandas(learn, "place long, w double")
    used = dealt.select("part").distinct().count()
    found = parts.groupBy("place").agg((F.sum("w") / F.lit(max(1, used))).alias("w")).toArrow()
    weights = np.zeros(SIZE + 1)
    weights[found["place"].to_numpy()] = found["w"].to_numpy()
    return weights


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """``doc_id, text, y`` of labelled rows outside the held-out fifth, a hash sample of ``most`` at most.

    A key with several labels takes the lowest. Only the sampled keys are broadcast.
    """
    y = labels.filter("doc_id IS NOT NULL AND y IS NOT NULL AND NOT isnan(y)").filter(~is_held_out(F.col("doc_id")))
    y = y.groupBy("doc_id").agg(F.min("y").cast("int").alias("y"))
    sample = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.join(F.broadcast(sample), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y")


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, mark`` (hash of key and text) and ``score`` of rows of ``doc_id, text``: sparse dot products in tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def work(got, n):
        w = shared.value
        out = np.full(n, w[SIZE])
        texts = [t or b"" for t in got["text"]]
        for lo, hi in chunks(texts):
            places, begins = features(texts[lo:hi])
            sums = np.concatenate([[0.0], np.cumsum(w[places])])
            size = np.diff(begins)
            out[lo:hi] += (sums[begins[1:]] - sums[begins[:-1]]) * (SCALE / np.maximum(1, size))
        p = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
        return [pa.array(got["doc_id"], key), pa.array(got["mark"], pa.int64()), pa.array(np.round(p, 9))]

    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    key = to_arrow_type(kind)
    rows = docs.select("doc_id", row_mark().alias("mark"), "text")
    return scan(rows, work, f"doc_id {kind.simpleString()}, mark long, score double", ["doc_id", "mark", "text"])


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The probability of label 1 for each document, from its whole text alone.

    Learns from ``labels`` (``key`` and a 0/1 column) of rows whose key's CRC-32 is not divisible by
    five; at most ``most`` of them, chosen by hash of the key.

    Returns ``doc_id, mark, held_out, score``. NULL and empty texts get the intercept's score; without
    labels every score is 0.5; NULL keys are scored and never learnt from; repeated rows are scored
    each; other columns are not read.
    """
    rows = pick(docs, **{key: "doc_id", text: "text"})
    known = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("double").alias("y"))
    learnt = materialize(labelled_rows(rows, known, most), "labelled")
    scored = score(rows, train(learnt))
    return scored.withColumn("held_out", is_held_out(F.col("doc_id")))
