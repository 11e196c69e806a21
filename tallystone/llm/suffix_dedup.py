"""Repeated passages by families of sparse suffix arrays that grow and merge geometrically.

Every string of ``length`` bytes chooses one place in it by its content alone, so equal strings choose the
same place and are met through the suffixes that start at chosen places, about one in fifty. Suffixes are dealt to shards by
the hash of their first bytes. A shard takes them in batches: each batch becomes a suffix array (its order is
by hashes of the head and of the span around it), is scanned against the arrays the shard holds, and arrays
of like size are merged. A suffix whose span is met twice makes a whole run of strings repeated; one of which only the
head is met leaves its strings to be compared one by one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm.common import chunks, materialize, mix, pick, prefix_hash, range_hash, scan, signed
from tallystone.llm.filters import bit_filter, in_filter

#: Bytes at the head of a suffix by which arrays are ordered.
HEAD = 100
#: Bits that tell places of one chunk apart; the rest of a key is a hash.
PLACE_BITS = 30


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by running minima inside blocks from both ends."""
    n = len(x)
    if n < width:
        return x[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def runs_of(texts: list[bytes], length: int, head: int = HEAD) -> tuple[np.ndarray, ...]:
    """Sampled suffixes of some texts: ``text, start hash, first, last, span hash``.

    Each string of ``length`` bytes chooses the place in it where the hash of ``head`` bytes is least
    (the first of equals), so equal strings choose alike. Neighbouring strings that choose one place form a run: it starts at
    ``first`` .. ``last``, and its span is the bytes from the first start to the end of the last string.
    """
    blob = b"\0".join(texts)
    data = np.frombuffer(blob, np.uint8)
    none = np.zeros(0, np.int64)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    if len(data) < length:
        return none, none.view(np.uint64), none, none, none.view(np.uint64)
    sums = prefix_hash(data)
    at = np.arange(len(data) - head + 1)
    heads = range_hash(sums, at, at + head)
    keys = (heads >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | at.view(np.uint64)
    chosen = (sliding_least(keys, length - head + 1) & np.uint64((1 << PLACE_BITS) - 1)).view(np.int64)
    count = len(chosen)
    # texts that are long enough have strings at begin .. end - length
    sizes = np.diff(begins) - 1
    inside = np.zeros(count + 1, np.int8)
    long_enough = np.flatnonzero(sizes >= length)
    inside[begins[long_enough]] += 1
    np.add.at(inside, begins[long_enough] + sizes[long_enough] - length + 1, -1)
    ok = np.cumsum(inside[:count]) > 0
    new = ok.copy()
    new[1:] &= (chosen[1:] != chosen[:-1]) | ~ok[:-1]
    new[begins[long_enough]] = True
    first = np.flatnonzero(new)
    stop = ok.copy()
    stop[:-1] &= new[1:] | ~ok[1:]
    last = np.flatnonzero(stop)
    text = np.searchsorted(begins, first, side="right") - 1
    spans = range_hash(sums, first, last + length)
    return text, heads[chosen[first]], first - begins[text], last - begins[text], spans


SIZE_BITS = 12
RUN = "head long, span long, row long, place long"


def pack(first: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """First start, number of starts and state in one long.

    States: 0 unknown, 1 head met twice, 2 span met twice, 3 the same, and its strings are to be compared
    with those of runs in state 1.
    """
    return (first << (SIZE_BITS + 2)) | (size << 2) | state


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> (SIZE_BITS + 2), (place >> 2) & ((1 << SIZE_BITS) - 1), place & 3


def _times(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each value occurs, and whether a value is the first of its kind."""
    _, first, inverse, n = np.unique(x, return_index=True, return_inverse=True, return_counts=True)
    new = np.zeros(len(x), bool)
    new[first] = True
    return n[inverse], new


def sampled_runs(docs: DataFrame, length: int, head: int = HEAD) -> DataFrame:
    """``head, span, row, place, spread`` for the runs of rows of ``row, text``.

    What a batch of rows shows by itself is settled there: of equal spans only one goes to its head's
    shard, and heads met often send one suffix there; the others (``spread``) go anywhere, so no shard gets a frequent head's
    suffixes. ``hot`` marks the one that stands for others of its head.
    """

    def work(got, n):
        texts = [t or b"" for t in got["text"]]
        ids = np.array(got["row"], np.int64)
        parts = []
        for lo, hi in chunks(texts):
            text, heads, first, last, spans = runs_of(texts[lo:hi], length, head)
            parts.append((ids[text + lo], heads, first, last - first + 1, spans))
        if not parts:
            return None
        row, heads, first, size, spans = (np.concatenate(x) for x in zip(*parts, strict=True))
        span_times, span_new = _times(heads ^ mix(spans))
        head_times, head_new = _times(heads)
        state = np.where(span_times > 1, 2, np.where(head_times > 1, 1, 0))
        beside = (head_times > 8) & ~head_new
        state[beside & span_new & (state == 2)] = 3
        spread = ((span_times > 1) & ~span_new) | beside
        hot = (head_times > 8) & head_new
        return [pa.array(signed(heads)), pa.array(signed(spans)), pa.array(row), pa.array(pack(first, size, state)), pa.array(spread), pa.array(hot)]

    return scan(docs, work, RUN + ", spread boolean, hot boolean", ["row", "text"])


class SuffixArray:
    """Suffixes in the order of their heads, and of head and span together."""

    def __init__(self, heads: np.ndarray, spans: np.ndarray, payload: np.ndarray, state: np.ndarray, hot: np.ndarray):
        by = np.argsort(heads, kind="stable")
        self.heads, self.spans, self.payload, self.state, self.hot = heads[by], spans[by], payload[by], state[by], hot[by]
        keys = self.heads ^ mix(self.spans)
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]

    def __len__(self) -> int:
        return len(self.heads)

    def _raise(self, at: np.ndarray, state: int) -> None:
        self.state[at] = np.maximum(self.state[at], state)

    def scan_itself(self) -> None:
        """Neighbours in the order that agree."""
        same = np.flatnonzero(self.heads[1:] == self.heads[:-1])
        self._raise(np.concatenate([same, same + 1]), 1)
        same = np.flatnonzero(self.keys[1:] == self.keys[:-1])
        self._raise(self.by_key[np.concatenate([same, same + 1])], 2)

    def scan_against(self, other: SuffixArray) -> None:
        """Both arrays walked in order: suffixes with a partner in the other array are raised on both sides."""
        for mine, theirs, state in ((self.heads, other.heads, 1), (self.keys, other.keys, 2)):
            for a, x, b, y in ((self, mine, other, theirs), (other, theirs, self, mine)):
                at = np.minimum(np.searchsorted(y, x), max(0, len(y) - 1))
                hit = np.flatnonzero(y[at] == x) if len(y) else np.zeros(0, np.int64)
                a._raise(hit if state == 1 else a.by_key[hit], state)

    def merged(self, other: SuffixArray) -> SuffixArray:
        join = lambda c: np.concatenate([getattr(self, c), getattr(other, c)])
        return SuffixArray(join("heads"), join("spans"), join("payload"), join("state"), join("hot"))

    def settle(self) -> None:
        """Where a head has runs in state 1, one run of each repeated span of that head goes to state 3."""
        if not len(self):
            return
        groups = np.flatnonzero(np.append(True, self.heads[1:] != self.heads[:-1]))
        wanted = np.logical_or.reduceat((self.state == 1) | self.hot, groups)
        wanted = np.repeat(wanted, np.diff(np.append(groups, len(self))))
        first = self.by_key[np.append(True, self.keys[1:] != self.keys[:-1])]
        first = first[wanted[first] & (self.state[first] == 2)]
        self.state[first] = 3


class Family:
    """A shard's arrays, largest first; each is over twice the size of the next."""

    def __init__(self):
        self.levels: list[SuffixArray] = []

    def add(self, batch: SuffixArray) -> None:
        batch.scan_itself()
        for level in self.levels:
            batch.scan_against(level)
        self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            last = self.levels.pop()
            self.levels.append(self.levels.pop().merged(last))

    def settled(self) -> list[SuffixArray]:
        while len(self.levels) > 1:
            last = self.levels.pop()
            self.levels.append(self.levels.pop().merged(last))
        for level in self.levels:
            level.settle()
        return self.levels


def repeated_runs(runs: DataFrame, shards: int) -> DataFrame:
    """``row, place`` of the runs whose head or span was met twice, by one family per shard."""
    where = F.when(F.col("spread"), F.xxhash64("head", "span", "row")).otherwise(F.col("head"))

    def run(batches):
        family, waiting, n = Family(), [], 0

        def settle():
            columns = [np.concatenate(x) for x in zip(*waiting, strict=True)]
            head, span, row, place, hot = columns
            family.add(SuffixArray(head.view(np.uint64), span.view(np.uint64), np.stack([row, place], axis=1), place & 3, hot))

        for batch in batches:
            known = batch.column("spread").to_numpy(zero_copy_only=False)
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("head", "span", "row", "place", "hot")]
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(columns[2][known]), pa.array(columns[3][known])], names=["row", "place"])
                columns = [c[~known] for c in columns]
            waiting.append(columns)
            n += len(columns[0])
            if n >= 100_000:
                settle()
                waiting, n = [], 0
        if n:
            settle()
        for level in family.settled():
            met = level.state > 0
            row, place = level.payload[met].T
            place = (place & ~np.int64(3)) | level.state[met]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(row)), pa.array(place)], names=["row", "place"])

    return runs.repartition(shards, where).mapInArrow(run, "row long, place long")


def texts_of(docs: DataFrame, wanted) -> DataFrame:
    """``row, text`` of rows that pass a bit map."""

    def work(got, n):
        ids = np.array(got["row"], np.int64)
        take = np.flatnonzero(in_filter(wanted.value, mix(ids.view(np.uint64))))
        return [pa.array(ids[take]), pa.array([got["text"][i] for i in take], pa.binary())]

    return scan(docs, work, "row long, text binary", ["row", "text"])


def open_strings(texts: DataFrame, length: int) -> DataFrame:
    """``string, row, at, known, spread`` for each string of the open runs of rows of ``row, text, places``.

    As with suffixes, of strings that a batch holds twice one is sent on by its hash and the others anywhere.
    """

    def work(got, n):
        row, at, strings = [], [], []
        for lo, hi in chunks(got["text"]):
            blob = np.frombuffer(b"".join(got["text"][lo:hi]), np.uint8)
            begins = np.append(0, np.cumsum([len(t) for t in got["text"][lo:hi]]))
            sums = prefix_hash(blob)
            for i in range(lo, hi):
                first, size, _ = unpack(np.array(got["places"][i], np.int64))
                ends = np.cumsum(size)
                starts = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
                row.append(np.full(len(starts), got["row"][i]))
                at.append(starts)
                starts = starts + begins[i - lo]
                strings.append(range_hash(sums, starts, starts + length))
        if not row:
            return None
        row, at, strings = np.concatenate(row), np.concatenate(at), np.concatenate(strings)
        times, new = _times(strings)
        return [pa.array(signed(strings)), pa.array(row), pa.array(at.astype(np.int32)), pa.array(times > 1), pa.array((times > 1) & ~new)]

    return scan(texts, work, "string long, row long, at int, known boolean, spread boolean", ["row", "text", "places"])


def remove_repeats(
    docs: DataFrame, length: int = 200, head: int = HEAD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Remove each byte that lies in a string of ``length`` bytes which also starts anywhere else.

    Texts are UTF-8 bytes; matches stay inside a row's text, may overlap, and are judged on the input. Strings
    and suffix heads are compared by 64-bit hashes. Whole texts are read three times; only those with an open
    run or a removed byte are shuffled.

    Returns one row per input row: ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs),
    ``kept_sha256`` (of the bytes that stay) and ``spans`` (starts and ends of what goes). NULL text is empty; texts shorter
    than ``length`` stay whole; repeated rows repeat each other; an empty table gives none; other columns
    are not read.
    """
    spark = docs.sparkSession
    rows = pick(docs, **{key: "doc_id", text: "text"})
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    weight = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a shard gets about 4 MB of text in suffixes, or half a million of them
    shards = max(1, -(-weight // (500_000 * (length - head) // 2)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = materialize(repeated_runs(sampled_runs(rows.select("row", "text"), length, head), shards), "repeated-runs")
    state = F.col("place").bitwiseAND(3)

    open_runs = found.filter((state == 1) | (state == 3)).groupBy("row").agg(F.collect_set("place").alias("places"))
    ids = open_runs.select("row")
    by_row = lambda t: mix(t["row"])
    wanted = spark.sparkContext.broadcast(bit_filter(ids, by_row, ids.count()))
    texts = texts_of(rows.select("row", "text"), wanted).join(open_runs, "row")
    strings = open_strings(texts, length)
    where = F.when(F.col("spread"), F.col("row")).otherwise(F.col("string"))
    strings = strings.withColumn("string", where)
    twice = strings.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("string")))
    twice = twice.filter((F.col("n") > 1) | F.col("known"))

    starts = found.filter(state >= 2).select("row", F.shiftright("place", 2).alias("starts")).unionByName(
        twice.select("row", (F.shiftleft(F.col("at").cast("long"), SIZE_BITS) + 1).alias("starts"))
    )
    starts = materialize(starts.groupBy("row").agg(F.collect_list("starts").alias("starts")), "repeats")
    removed = spark.sparkContext.broadcast(bit_filter(starts.select("row"), by_row, starts.count()))
    return _cut(rows, removed, starts, length)


def _cut(rows: DataFrame, removed, starts: DataFrame, length: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["doc_id"].dataType
    key = to_arrow_type(kind)

    def split(got, n):
        ids = np.array(got["row"], np.int64)
        hit = in_filter(removed.value, mix(ids.view(np.uint64)))
        whole = [None if h else hashlib.sha256(t).hexdigest() for h, t in zip(hit, got["text"], strict=True)]
        return [
            pa.array(got["doc_id"], key), pa.array(ids), pa.array([len(t) for t in got["text"]], pa.int64()),
            pa.array(whole, pa.string()), pa.array([t if h else None for h, t in zip(hit, got["text"], strict=True)], pa.binary()),
        ]

    def cut(got, n):
        out = ([], [], [], [])
        for size, whole, text, starts in zip(got["n_bytes"], got["sha256"], got["text"], got["starts"], strict=True):
            spans = []
            if starts:
                packed = np.sort(np.array(starts, np.int64))
                first = packed >> SIZE_BITS
                end = np.maximum.accumulate(first + (packed & ((1 << SIZE_BITS) - 1)) - 1 + length)
                new = np.append(True, first[1:] > end[:-1])
                last = np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)
                spans = list(zip(first[new].tolist(), end[last].tolist(), strict=True))
            if text is not None:
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                whole = hashlib.sha256(b"".join(kept)).hexdigest()
            else:
                whole = whole.decode()
            for column, value in zip(out, (sum(b - a for a, b in spans), len(spans), whole, [{"start": a, "end": b} for a, b in spans]), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return [pa.array(got["doc_id"], key), pa.array(got["n_bytes"], pa.int64()), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))]

    name = kind.simpleString()
    parts = scan(rows, split, f"doc_id {name}, row long, n_bytes long, sha256 string, text binary", ["doc_id", "row", "text"])
    both = parts.join(starts, "row", "left")
    schema = f"doc_id {name}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
    return scan(both, cut, schema, ["doc_id", "n_bytes", "sha256", "text", "starts"])
