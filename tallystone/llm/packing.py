"""Best-fit packing of tokenised documents into fixed-length sequences.

How full a sequence gets depends only on piece lengths, and there are at most ``capacity`` of those.
So the packing is decided on the histogram of lengths, exactly as it would be piece by piece, and the
pieces then find their places by their rank within their length.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm.common import materialize, pick, power_of_two, scan

PIECES = "doc_id {key}, piece int, start long, length int, ids_crc32 long"
#: Words, and pieces of words, that a worker keeps with their ids; it starts afresh beyond these numbers.
WORDS_KEPT, PARTS_KEPT = 400_000, 400_000
#: Fixed rule of the vocabulary: how it splits a lower-case word before it is coded, for words of ASCII and
#: Latin letters up to U+024F (others go through the whole tokenizer).
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u024f]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u024f0-9]+")
PLAIN = re.compile("[!-~\u00df-\u00f6\u00f8-\u024f]+")
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Fixed rule: bytes are coded as the characters of their number, or from U+0100 on where that is not printable.
BYTES_AS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
_tokenizers: dict[str, Words] = {}


class Words(dict):
    """Ids of white-space-free words, 4 bytes each, coded when they are first asked for.

    Neither the vocabulary's normaliser, its splitting rule nor a special token reaches across white space, so
    a text's ids are those of its words in order. A word of plain letters and signs is put together from its parts, which
    are far fewer than words; any other goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model, self.parts = self.whole.model, {}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        low = text.lower()
        if PLAIN.fullmatch(low) and "<|" not in low and "\u03a3" not in text:
            parts = self.parts
            ids = b"".join([parts.get(p) or self._part(p) for p in PARTS.findall(low)])
        else:
            ids = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        shown = part.encode().decode("latin-1").translate(BYTES_AS)
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
        self.parts[part] = ids
        return ids

    def trim(self) -> None:
        if len(self) > WORDS_KEPT:
            self.clear()
        if len(self.parts) > PARTS_KEPT:
            self.parts.clear()


def _words_to_ids(path: str) -> Words:
    if path not in _tokenizers:
        _tokenizers[path] = Words(path)
    return _tokenizers[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """One row per piece: a document's ids and then ``end_id``, cut every ``capacity`` ids.

    NULL and empty texts give one piece of length 1. ``docs`` has ``doc_id`` and ``text``.
    """
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def work(got, n):
        known = _words_to_ids(tokenizer)
        known.trim()
        out = ([], [], [], [], [])
        for key, text in zip(got["doc_id"], got["text"], strict=True):
            ids = b"".join(map(known.__getitem__, (text or b"").split())) + end
            for k, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                for column, value in zip(out, (key, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                    column.append(value)
        kinds = (key_type, pa.int32(), pa.int64(), pa.int32(), pa.int64())
        return [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]

    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    key_type = to_arrow_type(kind)
    return scan(docs, work, PIECES.format(key=kind.simpleString()), ["doc_id", "text"])


@dataclass
class _Bins:
    """``count`` equal bins: runs of (length, how many) in order, and the room left."""

    count: int
    gap: int
    runs: list[tuple[int, int]] = field(default_factory=list)

    def split(self, n: int) -> _Bins:
        self.count -= n
        return _Bins(n, self.gap, list(self.runs))

    def put(self, length: int, k: int) -> None:
        self.runs.append((length, k))
        self.gap -= length * k


class _Left:
    """How many pieces of each length are left, and the largest length that still fits."""

    def __init__(self, counts: dict[int, int]):
        self.counts = dict(counts)
        self.lengths = sorted(counts)

    def largest(self, room: int) -> int | None:
        at = bisect.bisect_right(self.lengths, room)
        return self.lengths[at - 1] if at else None

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.lengths.remove(length)


def pack_lengths(histogram: dict[int, int], capacity: int) -> list[_Bins]:
    """Bins for a histogram of lengths; all bins of one kind are handled as one.

    Pieces over a third of the capacity fit at most twice into a bin: from the longest down, each is
    matched with the longest partner that still fits. Shorter pieces, longest first, go to the bin with the
    least room that takes them, so a bin once chosen is filled as far as they fit; a new bin opens only when none has room. Apart from
    the last of its length, a step uses up a kind of bin or a length, so kinds stay few.
    """
    third = capacity // 3
    large = _Left({x: n for x, n in histogram.items() if x > third})
    bins: list[_Bins] = []
    while large.lengths:
        a = large.lengths[-1]
        n = large.counts[a]
        large.take(a, n)
        while n:
            b = large.largest(capacity - a)
            if a <= capacity - a:  # two of the same length fit, and none is longer
                pairs, n = n // 2, n % 2
                if pairs:
                    bins.append(_Bins(pairs, capacity - 2 * a, [(a, 2)]))
                if not n:
                    break
                b = large.largest(capacity - a)
            if b is None:
                bins.append(_Bins(n, capacity - a, [(a, 1)]))
                break
            k = min(n, large.counts[b])
            bins.append(_Bins(k, capacity - a - b, [(a, 1), (b, 1)]))
            large.take(b, k)
            n -= k
    by_gap: dict[int, list[_Bins]] = defaultdict(list)
    for x in bins:
        by_gap[x.gap].append(x)
    gaps = sorted(by_gap)
    done: list[_Bins] = []

    def keep(x: _Bins) -> None:
        if x.gap not in by_gap or not by_gap[x.gap]:
            bisect.insort(gaps, x.gap)
        by_gap[x.gap].append(x)

    for length in sorted((x for x in histogram if x <= third), reverse=True):
        n = histogram[length]
        while n:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                whole, rest = divmod(n, each)
                for count, k in ((whole, each), (1, rest)):
                    if count and k:
                        x = _Bins(count, capacity)
                        x.put(length, k)
                        keep(x)
                break
            gap = gaps[at]
            x = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps.pop(at)
            each = gap // length
            whole = min(x.count, n // each)
            if whole:
                full = x.split(whole)
                full.put(length, each)
                keep(full)
                n -= whole * each
            if n and x.count:  # fewer are left than one bin takes
                last = x.split(1)
                last.put(length, n)
                keep(last)
                n = 0
            if x.count:
                keep(x)
    done.extend(x for same in by_gap.values() for x in same)
    return done


def _slots(bins: list[_Bins]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, pieces side by side, first bin, offset)."""
    used: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for x in bins:
        offset = 0
        for length, k in x.runs:
            lo = used[length]
            used[length] = lo + k * x.count
            rows.append((length, lo, used[length], k, first, offset))
            offset += length * k
        first += x.count
    return rows


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pack the token pieces of all documents into sequences of at most ``capacity`` tokens.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Pieces of equal length are
    interchangeable: ranks follow (key, piece, CRC) inside hash buckets, so that a length shared by most
    pieces is ranked by many tasks. Repeated rows are packed as often as they occur; rows with a NULL key are packed
    too; an empty table gives none; other columns are not read.
    """
    spark = docs.sparkSession
    rows = pick(docs, **{key: "doc_id", text: "text"})
    pieces = materialize(token_pieces(rows, tokenizer, capacity, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    bins = pack_lengths(histogram, capacity)
    slots = spark.createDataFrame(
        _slots(bins), "length int, low long, high long, side long, bin long, base long"
    )
    buckets = power_of_two(math.sqrt(max(1, sum(histogram.values()))) / 4)
    order = ["doc_id", "piece", "ids_crc32"]
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = pieces.withColumn("inside", inside).join(starts, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("inside"))
    # at most some thousand slots: their number depends on the capacity, not on the rows
    places = F.broadcast(slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("low", "high", "side", "bin", "base"))).alias("slots")))
    at = F.element_at(F.filter("slots", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"])), 1)
    nth = F.col("rank") - F.col("slot.low")
    return ranked.join(places, "length").withColumn("slot", at).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("slot.bin") + F.floor(nth / F.col("slot.side"))).cast("long").alias("sequence_id"),
        (F.col("slot.base") + F.pmod(nth, F.col("slot.side")) * F.col("length")).cast("long").alias("offset"),
    )
