"""Repeated lines: a sharded minimal perfect hash of all distinct lines, which documents probe.

Each line has a 64-bit hash and a 32-bit fingerprint. Lines are dealt into shards by hash; a shard numbers its distinct lines by
a minimal perfect hash (a few levels of bit arrays, in which a bit is set where one line alone falls) and keeps, by number, their
fingerprints, the number of documents that hold them and the largest key of these. Shards are rows of a written
table. Documents send the hashes of their lines, packed, to the shards and get back the places of the lines to drop.

A line that very many documents hold would fill its shard with probes. Such lines are counted in the index, told to all tasks
and settled where they are read: with more than a ``HOT_SHARE`` of all probes each, there are few of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallystone.llm.common import _LOWER, WORD_BREAK, chunks, materialize, mix, pick, prefix_hash, range_hash, row_mark, scan

#: Lines with more than this share of all probes are told to all tasks (4096 at most).
HOT_SHARE = 1 / 4096
#: Bytes of text for each shard.
SHARD_BYTES = 16_000_000
#: Bytes of text that a worker hashes at one time.
TEXT_AT_ONCE = 1_000_000
#: Bits a line in each level of the perfect hash.
GAMMA = 2
#: The key of a row without one: before all others.
NO_KEY = -(2**63)


def line_keys(texts: list[bytes], least: int) -> tuple[np.ndarray, ...]:
    """Hash, fingerprint, text and place in it of each line with ``least`` code points once trimmed and lower-cased."""
    parts = [(lo, _line_keys(texts[lo:hi], least)) for lo, hi in chunks(texts, TEXT_AT_ONCE)]
    hashed, mark, text, place = (np.concatenate(c) for c in zip(*((h, m, lo + t, p) for lo, (h, m, t, p) in parts), strict=True))
    return hashed, mark, text, place


def _line_keys(texts: list[bytes], least: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"\n".join(texts).translate(_LOWER), np.uint8)
    breaks = np.flatnonzero(data == 10)
    begins, ends = np.append(0, breaks + 1), np.append(breaks, len(data))
    sizes = np.array([t.count(b"\n") + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(begins)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    solid = np.append(np.flatnonzero(~WORD_BREAK[data]), len(data))  # places of what is not white space
    first = np.minimum(solid[np.searchsorted(solid, begins)], ends)
    last = np.searchsorted(solid, ends) - 1
    last = np.where(last >= 0, solid[last] + 1, 0)
    last = np.maximum(last, first)
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    long = np.flatnonzero(points[last] - points[first] >= least)
    first, last = first[long], last[long]
    sums = prefix_hash(data)
    hashed = range_hash(sums, first, last)
    # a second, independent sum: bytes weighed by their neighbours
    pairs = prefix_hash(data ^ np.append(data[1:], 0).astype(np.uint8) * np.uint8(167))
    mark = mix(range_hash(pairs, first, last - 1) ^ (last - first).astype(np.uint64))
    return hashed, (mark >> np.uint64(32)).astype(np.uint32), text[long], place[long]


class PerfectHash:
    """Numbers ``n`` distinct pairs of hash and fingerprint 0 to n - 1, in about three bits each."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # bits as bytes, a multiple of eight of them a level
        self.before = [np.append(0, np.cumsum(np.bitwise_count(x.view(np.uint64)), dtype=np.int64)) for x in levels]
        self.offsets = np.append(0, np.cumsum([b[-1] for b in self.before], dtype=np.int64)).astype(np.int64)

    @staticmethod
    def _spots(hashed: np.ndarray, mark: np.ndarray, level: int, bits: int) -> np.ndarray:
        turned = mix(hashed + mix(mark.astype(np.uint64) + np.uint64(level << 32)))
        return (turned % np.uint64(bits)).astype(np.int64)

    @classmethod
    def of(cls, hashed: np.ndarray, mark: np.ndarray) -> PerfectHash:
        levels = []
        while len(hashed):
            bits = -(-GAMMA * len(hashed) // 64) * 64
            spots = cls._spots(hashed, mark, len(levels), bits)
            times = np.bincount(spots, minlength=bits)
            levels.append(np.packbits(times == 1, bitorder="little"))
            again = times[spots] > 1
            hashed, mark = hashed[again], mark[again]
        return cls(levels)

    def number(self, hashed: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """The number of each pair; -1 or any number for pairs that are not there."""
        found = np.full(len(hashed), -1, np.int64)
        left = np.arange(len(hashed))
        for level, bits in enumerate(self.levels):
            spots = self._spots(hashed[left], mark[left], level, len(bits) * 8)
            hit = (bits[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 == 1
            at = spots[hit]
            words = bits.view(np.uint64)[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            found[left[hit]] = self.offsets[level] + self.before[level][at >> 6] + np.bitwise_count(words).astype(np.int64)
            left = left[~hit]
        return found


def _shard(hashed: np.ndarray, shards: int) -> np.ndarray:
    return ((hashed >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _by_shard(shards: int, hashed: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    """Rows ``shard, hashed, columns`` as bytes."""
    shard = _shard(hashed, shards)
    by = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[by], np.arange(shards + 1, dtype=np.uint64))
    return [
        (s, hashed[by[a:b]].tobytes(), *(c[by[a:b]].tobytes() for c in columns))
        for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b
    ]


def _bytes(table: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in table[column].to_pylist())])


def _keys(values: list) -> np.ndarray:
    return np.array([NO_KEY if v is None else v for v in values], np.int64)


class LineIndex:
    """Rows ``shard, bits, marks, counts, last`` of a written table, and the lines that all tasks are told."""

    def __init__(self, table: DataFrame, shards: int, told: tuple[np.ndarray, ...]):
        self.table, self.shards, self.told = table, shards, told

    @staticmethod
    def build(rows: DataFrame, least: int) -> LineIndex:
        """Of the lines of ``rows`` (``key, text``) with ``least`` code points; each row counts as a document."""
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        shards = max(8, -(-int(size) // SHARD_BYTES))

        def gather(got, n):
            """What a batch holds of each line: documents and the largest key, one entry a line."""
            hashed, mark, text, _ = line_keys([t or b"" for t in got["text"]], least)
            if not len(hashed):
                return None
            by = np.lexsort((text, mark, hashed))
            hashed, mark, text = hashed[by], mark[by], text[by]
            line = np.append(True, (hashed[1:] != hashed[:-1]) | (mark[1:] != mark[:-1]))
            seen = line | np.append(True, text[1:] != text[:-1])
            first = np.flatnonzero(line)
            counts = np.add.reduceat(seen.astype(np.int64), first)
            out = _by_shard(shards, hashed[first], mark[first], counts, np.maximum.reduceat(_keys(got["key"])[text], first))
            return [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int32(), *[pa.binary()] * 4], strict=True)]

        def number(table: pa.Table) -> pa.Table:
            hashed, mark = _bytes(table, "hashed", np.uint64), _bytes(table, "marks", np.uint32)
            counts, last = _bytes(table, "counts", np.int64), _bytes(table, "last", np.int64)
            by = np.lexsort((mark, hashed))
            hashed, mark = hashed[by], mark[by]
            first = np.flatnonzero(np.append(True, (hashed[1:] != hashed[:-1]) | (mark[1:] != mark[:-1])))
            counts, last = np.add.reduceat(counts[by], first), np.maximum.reduceat(last[by], first)
            hashed, mark = hashed[first], mark[first]
            numbers = PerfectHash.of(hashed, mark)
            order = np.argsort(numbers.number(hashed, mark))
            often = np.argsort(-counts, kind="stable")[:4096]  # candidates for the lines that are told
            return pa.table(
                {
                    "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
                    "bits": pa.array([[x.tobytes() for x in numbers.levels]], pa.list_(pa.binary())),
                    "marks": pa.array([mark[order].tobytes()], pa.binary()), "counts": pa.array([counts[order].tobytes()], pa.binary()),
                    "last": pa.array([last[order].tobytes()], pa.binary()), "probes": pa.array([int(counts.sum())], pa.int64()),
                    "often": pa.array([[{"hashed": h, "mark": m, "n": n, "last": k} for h, m, n, k in zip(hashed[often].view(np.int64).tolist(), mark[often].tolist(), counts[often].tolist(), last[often].tolist(), strict=True)]], pa.list_(pa.struct([("hashed", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("last", pa.int64())]))),
                }
            )

        packed = scan(rows, gather, "shard int, hashed binary, marks binary, counts binary, last binary", ["key", "text"])
        schema = "shard int, bits array<binary>, marks binary, counts binary, last binary, probes long, often array<struct<hashed:bigint,mark:bigint,n:bigint,last:bigint>>"
        table = materialize(packed.groupBy("shard").applyInArrow(number, schema), "line-index")
        total = table.agg(F.coalesce(F.sum("probes"), F.lit(0))).first()[0]
        # more than a share of all probes: no more than one over the share
        hot = table.select(F.inline("often")).filter(F.col("n") > F.lit(total * HOT_SHARE)).orderBy("hashed", "mark").toArrow()
        told = tuple(hot[c].to_numpy() for c in ("hashed", "mark", "n", "last"))
        return LineIndex(table.drop("probes", "often"), shards, told)

    def probe(self, rows: DataFrame, least: int, documents: int) -> DataFrame:
        """``mark, places``: by row mark, the lines of ``rows`` (``mark, key, text``) that ``documents`` documents or more hold
        and a larger key than the row's as well. Places go from 0."""
        shards, shared = self.shards, rows.sparkSession.sparkContext.broadcast(self.told)

        def ask(got, n):
            """Probes by shard; lines that are told are settled here, as rows of shard -1."""
            hot, hot_mark, hot_n, hot_last = shared.value
            hot = hot.view(np.uint64)
            by = np.argsort(hot, kind="stable")
            hot, hot_mark, hot_n, hot_last = hot[by], hot_mark[by], hot_n[by], hot_last[by]
            hashed, mark, text, place = line_keys([t or b"" for t in got["text"]], least)
            key, row = _keys(got["key"])[text], np.array(got["mark"], np.int64)[text]
            known = np.zeros(len(hashed), bool)
            drop = np.zeros(len(hashed), bool)
            at = np.searchsorted(hot, hashed)
            for step in range(int(np.unique(hot, return_counts=True)[1].max(initial=0))):
                spot = np.minimum(at + step, len(hot) - 1)
                same = (hot[spot] == hashed) & (hot_mark[spot] == mark)
                known |= same
                drop |= same & (hot_n[spot] >= documents) & (hot_last[spot] > key)
            left = ~known
            out = _by_shard(shards, hashed[left], mark[left], key[left], row[left], place[left].astype(np.int64))
            if drop.any():
                out.append((-1, b"", b"", b"", row[drop].tobytes(), place[drop].astype(np.int64).tobytes()))
            if not out:
                return None
            return [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int32(), *[pa.binary()] * 5], strict=True)]

        def answer(asked: pa.Table, index: pa.Table) -> pa.Table:
            rows, places = [], []
            if asked.num_rows and index.num_rows:
                held = {c: index[c][0].as_py() for c in ("bits", "marks", "counts", "last")}
                numbers = PerfectHash([np.frombuffer(x, np.uint8) for x in held["bits"]])
                marks, counts, last = (np.frombuffer(held[c], t) for c, t in (("marks", np.uint32), ("counts", np.int64), ("last", np.int64)))
                hashed, mark = _bytes(asked, "hashed", np.uint64), _bytes(asked, "marks", np.uint32)
                at = numbers.number(hashed, mark)
                there = (at >= 0) & (marks[at] == mark)
                drop = there & (counts[at] >= documents) & (last[at] > _bytes(asked, "keys", np.int64))
                rows, places = _bytes(asked, "row", np.int64)[drop], _bytes(asked, "places", np.int64)[drop]
            return pa.table({"mark": pa.array(rows, pa.int64()), "place": pa.array(places, pa.int64())})

        def settled(got, n):
            rows, places = (np.concatenate([np.frombuffer(x, np.int64) for x in got[c]]) if n else [] for c in ("row", "places"))
            return [pa.array(rows, pa.int64()), pa.array(places, pa.int64())]

        schema = "shard int, hashed binary, marks binary, keys binary, row binary, places binary"
        asked = materialize(scan(rows, ask, schema, ["mark", "key", "text"]), "line-probes")
        by_shard = asked.filter("shard >= 0").groupBy("shard").cogroup(self.table.groupBy("shard"))
        found = by_shard.applyInArrow(answer, "mark long, place long")
        found = found.unionByName(scan(asked.filter("shard < 0"), settled, "mark long, place long", ["row", "places"]))
        return found.groupBy("mark").agg(F.collect_set("place").alias("places"))


def drop_lines(
    docs: DataFrame, least: int = 20, documents: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Texts without the lines that many documents hold; the document with the largest key keeps them.

    Lines end at line feeds and are compared without white space at both ends and with A-Z in lower case, by 96 bits of
    hashes. Those of ``least`` code points or more, held by ``documents`` rows or more, go from all rows but those with the
    largest key of a holder, which keep all their copies. The other lines stay as they are, joined by line feeds.

    Returns one row per input row: ``doc_id, n_lines, n_dropped, kept_sha256, kept`` (the text that stays). NULL and empty texts
    are one empty line; the key must be integral, a NULL key comes before all others; each row counts as a document, repeated
    rows too; an empty table gives none; other columns are not read.
    """
    rows = pick(docs, **{key: "doc_id", text: "text"})
    kind = rows.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"the key must be integral, not {kind.simpleString()}")
    rows = rows.select("doc_id", row_mark().alias("mark"), F.col("doc_id").cast("long").alias("key"), "text")
    index = LineIndex.build(rows.select("key", "text"), least)
    dropped = index.probe(rows.select("mark", "key", "text"), least, documents)
    short = F.octet_length(F.coalesce("text", F.lit(""))) < least  # nothing to drop: empty rows are not brought together
    both = rows.filter(~short).join(dropped, "mark", "left")
    both = both.unionByName(rows.filter(short), allowMissingColumns=True)

    def cut(got, n):
        out = ([], [], [], [])
        for text, places in zip(got["text"], got["places"], strict=True):
            lines = (text or b"").split(b"\n")
            gone = set(places or ())
            kept = b"\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text or b""
            for column, value in zip(out, (len(lines), len(gone), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                column.append(value)
        return [pa.array(got["key"], pa.int64()), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True))]

    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept binary"
    told = scan(both, cut, schema, ["key", "text", "places"])
    return told.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("kept", F.col("kept").cast("string"))
