"""Exact duplicates by an index of cuckoo filters over stored digests."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm.common import materialize, pick, row_mark

SLOTS = 4
KICKS = 200
#: Digests that one bucket of the index is laid out for.
PER_BUCKET = 20_000
#: Batches that the rows of a table are inserted in, one after the other within each bucket.
BATCHES = 4


class CuckooFilter:
    """Fingerprints of 16 bits in rows of four; a digest has two possible rows.

    The second row follows from the first and the fingerprint, so a fingerprint can be moved and
    deleted without its digest. ``insert`` says False when no place is found after ``KICKS`` moves;
    the owner then builds a filter twice the size from its stored digests.
    """

    def __init__(self, rows: int, table: np.ndarray | None = None):
        self.rows = rows
        self.table = [[0] * SLOTS for _ in range(rows)] if table is None else table.reshape(rows, SLOTS).tolist()

    @classmethod
    def for_size(cls, n: int) -> CuckooFilter:
        return cls(1 << max(2, math.ceil(math.log2(max(1, n) / SLOTS / 0.85))))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16)
        return cls(len(table) // SLOTS, table)

    def dump(self) -> bytes:
        return np.array(self.table, np.uint16).tobytes()

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") % self.rows
        return mark, first, self._other(first, mark)

    def _other(self, row: int, mark: int) -> int:
        return row ^ ((mark * 0x5BD1E995) % self.rows)

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.table[a] or mark in self.table[b]

    def insert(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for row in (a, b):
            if 0 in self.table[row]:
                self.table[row][self.table[row].index(0)] = mark
                return True
        row, undo = a, []
        for k in range(KICKS):
            slot = k % SLOTS
            undo.append((row, slot))
            self.table[row][slot], mark = mark, self.table[row][slot]
            row = self._other(row, mark)
            if 0 in self.table[row]:
                self.table[row][self.table[row].index(0)] = mark
                return True
        for row, slot in reversed(undo):
            self.table[row][slot], mark = mark, self.table[row][slot]
        return False

    def delete(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for row in (a, b):
            if mark in self.table[row]:
                self.table[row][self.table[row].index(mark)] = 0
                return True
        return False


def _order(first: tuple) -> tuple:
    """NULL keys come last."""
    late, key, row = first
    return (late, row) if late else (late, key, row)


class Bucket:
    """One bucket of the index: the filter, and the digests it stands for with what is known of each."""

    def __init__(self, stored: dict[bytes, tuple] | None = None, filter_bytes: bytes | None = None):
        self.stored = stored or {}
        self.hits = 0  # digests met again and verified
        if filter_bytes:
            self.filter = CuckooFilter.load(filter_bytes)
        else:
            self.filter = CuckooFilter.for_size(len(self.stored))
            self._fill()

    def _fill(self) -> None:
        for d in self.stored:
            if not self.filter.insert(d):
                return self._grow()

    def _grow(self) -> None:
        self.filter = CuckooFilter(self.filter.rows * 2)
        self._fill()

    def lookup(self, digest: bytes) -> tuple | None:
        """What is stored of a digest: the filter answers most misses, a hit is verified."""
        return self.stored.get(digest) if digest in self.filter else None

    def insert(self, digest: bytes, first: tuple, copies: int) -> None:
        found = self.lookup(digest)
        if found is not None:
            self.hits += 1
            self.stored[digest] = (min(found[0], first, key=_order), found[1] + copies)
            return
        self.stored[digest] = (first, copies)
        if not self.filter.insert(digest):
            self._grow()

    def delete(self, digest: bytes) -> bool:
        if self.lookup(digest) is None:
            return False
        del self.stored[digest]
        self.filter.delete(digest)
        return True


ENTRY = "bucket int, digest binary, late boolean, first_id {key}, first_row long, copies long, filter binary"


class CuckooIndex:
    """An index of live digests as a written table; each change writes a new one.

    A digest belongs to one of ``buckets``; every bucket keeps one row per digest, and its filter in a row
    without a digest (whose ``copies`` are the hits of the last change). Batches are reduced to one row per digest before they are
    shuffled, so copies of one text never meet in a task; what is in an earlier batch too is found by the filter.
    """

    def __init__(self, table: DataFrame, buckets: int):
        self.table, self.buckets = table, buckets

    @classmethod
    def empty(cls, batch: DataFrame, expected: int) -> CuckooIndex:
        key = batch.schema["doc_id"].dataType.simpleString()
        table = batch.sparkSession.createDataFrame([], ENTRY.format(key=key))
        return cls(table, max(1, math.ceil(expected / PER_BUCKET)))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int")

    def _apply(self, batch: DataFrame, change: Callable[[Bucket, list[dict]], None]) -> CuckooIndex:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.table.schema)

        def run(old: pa.Table, new: pa.Table) -> pa.Table:
            entries, rows = old.to_pylist(), new.to_pylist()
            stored = {x["digest"]: ((x["late"], x["first_id"], x["first_row"]), x["copies"]) for x in entries if x["digest"] is not None}
            bucket = Bucket(stored, next((x["filter"] for x in entries if x["digest"] is None), None))
            change(bucket, rows)
            number = (rows or entries)[0]["bucket"]
            out = [(number, d, *first, n, None) for d, (first, n) in bucket.stored.items()]
            out.append((number, None, None, None, None, bucket.hits, bucket.filter.dump()))
            return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        batch = batch.withColumn("bucket", self._bucket())
        both = self.table.groupBy("bucket").cogroup(batch.groupBy("bucket"))
        return CuckooIndex(materialize(both.applyInArrow(run, self.table.schema), "cuckoo"), self.buckets)

    def insert(self, rows: DataFrame, batches: int = 1) -> CuckooIndex:
        """Add rows of ``doc_id, row, digest`` in so many batches; the smallest (key, row) of a digest is remembered."""
        first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row"))
        dealt = rows.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int"))
        batch = dealt.groupBy("digest", "batch").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
        batch = batch.select("digest", "batch", "first.late", F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("first_row"), "copies")

        def change(bucket: Bucket, new: list[dict]) -> None:
            for x in sorted(new, key=lambda x: x["batch"]):
                bucket.insert(x["digest"], (x["late"], x["first_id"], x["first_row"]), x["copies"])

        return self._apply(batch, change)

    def delete(self, digests: DataFrame) -> CuckooIndex:
        """Forget the given ``digest`` rows (a text is then unknown, whatever its copies)."""

        def change(bucket: Bucket, new: list[dict]) -> None:
            for x in new:
                bucket.delete(x["digest"])

        return self._apply(digests.select("digest").distinct(), change)

    def hits(self) -> int:
        """Digests of the last insertion that an earlier batch, or the index before, held already."""
        return self.table.filter("digest IS NULL").agg(F.sum("copies")).first()[0] or 0

    def entries(self) -> DataFrame:
        return self.table.filter("digest IS NOT NULL").select("digest", "late", "first_id", "first_row", "copies")


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space replaced by one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row, digest`` as a written table: texts are read once, and row numbers stay the same."""
    rows = pick(docs, **{key: "doc_id", text: "text"})
    digest = F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256))
    number = F.monotonically_increasing_id().alias("row")
    return materialize(rows.select("doc_id", number, row_mark().alias("mark"), digest.alias("digest")), "digests")


def find_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row, the row of its equal texts that stays: the one with the smallest key.

    Digests go into a cuckoo index in ``BATCHES`` batches (each reduced to one row per text before the shuffle); then each row
    looks its digest up in the index by an equi-join, whose large groups Spark can split, as only the row side
    is large.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256, mark`` (hash of key and text), one row per input row. NULL text is the
    empty text. A NULL key comes after all others; of rows with the same key and text one is kept. An
    empty table gives none; other columns are not read.
    """
    rows = digest_rows(docs, key, text)
    index = CuckooIndex.empty(rows, rows.count()).insert(rows, BATCHES)
    joined = rows.join(index.entries(), "digest")
    return joined.select(
        "doc_id",
        F.col("first_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("first_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "mark",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that ``find_copies`` keeps.

    NULL and empty texts are equal and one row of them stays; a NULL key comes after all others; of rows equal in key and text one
    stays; an empty table gives none. Other columns come back as they are, whatever their names but those that begin with ``_``.
    """
    found = find_copies(docs, key, text)
    columns = docs.columns
    kept = found.filter("kept").select(F.col("mark").alias("_mark_of_row"))
    marked = docs.withColumn("_mark_of_row", row_mark(key, text)).join(kept, "_mark_of_row", "left_semi")
    # rows equal in key and text share a mark, and one of them stays; the join has brought them together
    again = F.row_number().over(Window.partitionBy("_mark_of_row").orderBy("_mark_of_row"))
    return marked.withColumn("_nth_of_mark", again).filter("_nth_of_mark = 1").select(*[F.col(f"`{c}`") for c in columns])
