"""Helpers shared by the text operators: input columns, scratch tables, worker-side word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.session import materialize, shared_dir



def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the needed columns (given as ``column="own name"``), under the operator's own names, so other columns cannot clash."""
    return df.select([F.col(f"`{old}`").alias(new) for old, new in names.items()])


def discard(table: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote, when all that reads it is written itself."""
    spark = table.sparkSession
    ours = f"{shared_dir(spark).split('://')[-1].removeprefix('file:')}/tallystone/"
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if ours not in folder:
            raise ValueError(f"{folder} is no intermediate table")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of a table that is written as soon as it is; otherwise they stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(df: DataFrame, label: str, *used: DataFrame) -> DataFrame:
    """``materialize`` that leaves nothing on disk but the table: its shuffles go, and so do tables that only it has read."""
    with shuffles_dropped(df.sparkSession):
        table = materialize(df, label)
    for t in used:
        discard(t)
    return table


def power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, n)))))


#: Rows that a worker holds as Python values at one time.
ROWS_AT_ONCE = 2_500


def scan(df: DataFrame, work: Callable, schema: str, columns: list[str], per_task: bool = False) -> DataFrame:
    """``mapInArrow`` over rows: ``work`` gets lists of values (text as bytes) and their number, and gives columns or None.

    With ``per_task`` a task calls ``work`` once, without arguments, for the function that it then calls for its rows.
    """
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = work() if per_task else work
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            got = {}
            for c in columns:
                col = batch.column(c)
                if pa.types.is_string(col.type):
                    col = col.cast(pa.binary())
                elif pa.types.is_large_string(col.type):
                    col = col.cast(pa.large_binary())
                got[c] = col.to_pylist()
            out = mine(got, batch.num_rows)
            if out is not None:
                yield pa.RecordBatch.from_arrays(out, names=names)

    return df.select(columns).mapInArrow(run, schema)


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Bytes that end a word: white space, or every ASCII character but letters and digits.
WORD_BREAK = _class((0x20, 0x20), (0x09, 0x0D))
ALNUM_BREAK = _class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BYTE_VALUE = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = power_of_two(n)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any byte range follows (see ``range_hash``)."""
    up, _ = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _power_table(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def chunks(texts: list[bytes], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together hold about ``limit`` bytes (one text is never cut)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def split_words(texts: list[bytes], breaks: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts in order, and where each text's words begin (one more entry at the end)."""
    blob = b" ".join(texts)
    if lower:
        blob = blob.translate(_LOWER)
    data = np.frombuffer(blob, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~breaks[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    hashes = range_hash(prefix_hash(data), starts, ends)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return hashes, np.searchsorted(starts, begins)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total = total * _BASE + words[j : j + count]
    return mix(total + np.uint64(n))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's ``long``."""
    return x.view(np.int64)


def row_mark(key: str = "doc_id", text: str = "text") -> Column:
    """A row's identity where its key may be NULL or repeated: a hash of key and text."""
    return F.xxhash64(F.col(key), F.col(text))


def without(docs: DataFrame, marks: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (all its columns) without the rows of the given ``mark``."""
    columns = docs.columns
    marked = docs.withColumn("_mark_of_row", row_mark(key, text))
    left = marked.join(marks.select(F.col("mark").alias("_mark_of_row")), "_mark_of_row", "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in columns])
