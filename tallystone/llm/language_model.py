"""Language-model scores by a weighted backoff automaton of smoothed n-grams.

States are the empty history and the word and word pair histories that have n-grams of their own; an arc
to the next word carries its discounted log-probability, a failure arc the backoff weight to the next
shorter history. Every pair and triple seen twice in training is an arc, whatever the size of the corpus.

Texts are written once as batches of word numbers. Each batch sends its distinct n-grams, and hears how often each was seen in
training. A batch that holds an n-gram holds all its shorter ones, so it knows the weights of all arcs it walks, and tells the parts
that hold the histories what the arcs it was chosen for weigh. From these sums a part has the failure weights, and adds up those that texts pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import _BASE, ROWS_AT_ONCE, WORD_BREAK, chunks, discard, materialize, mix, pick, split_words
from tallystone.llm.quality import is_held_out

#: Times that a pair or triple is seen in training to be an arc; a share of the tokens below which none is (none is asked for).
LEAST, SHARE = 2, 0.0
#: Not read any more, as no words are told to all tasks; a test still sets it.
WORD_SHARE = 2e-7
#: Tokens of a batch, and tokens for each part of the keys, which one task counts.
TOKENS_AT_ONCE, PART_TOKENS = 600_000, 1_500_000
#: Ranges of the keys that are counted one after the other, and shares of the batches that are walked so: the disk holds the shuffle of one.
ROUNDS = 2
#: Parts of a range, however few the tokens.
LEAST_PARTS = 16
#: Bytes of text that are split into words together.
BYTES_AT_ONCE = 1_000_000
#: What is taken off every count of an arc, and left to shorter histories.
DISCOUNT = 0.5
END = mix(np.array([0x656E64], np.uint64))[0]


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and of its end, and the place of each text's first token."""
    words, begins = split_words(texts, WORD_BREAK)
    tokens = np.insert(words, begins[1:], END)
    return tokens, begins[:-1] + np.arange(len(texts))


class Grams:
    """Hashes of the pairs and triples that end at each token; 0 where the text has no such words before."""

    def __init__(self, tokens: np.ndarray, first: np.ndarray):
        n = len(tokens)
        self.pair, self.triple = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.pair[1:] = mix(tokens[:-1] * _BASE + tokens[1:])
        self.triple[2:] = mix(mix(tokens[:-2] * _BASE + tokens[1:-1]) * _BASE + tokens[2:])
        self.pair[first] = 0
        self.triple[first] = 0
        second = first[first + 1 < n] + 1
        self.triple[second] = 0
        self.first = first

    @property
    def pair_before(self) -> np.ndarray:
        """The pair that ends one token earlier."""
        before = np.zeros(len(self.pair), np.uint64)
        before[1:] = self.pair[:-1]
        before[self.first] = 0
        return before


def _laid(values: np.ndarray) -> bytes:
    """Sorted keys, or small numbers, by bytes of the same place, which compresses."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _edges(parts: int) -> np.ndarray:
    """The first key of each part but the first."""
    return np.array([-(-(p << 24) // parts) for p in range(1, parts)], np.uint64) << np.uint64(40)


def _unpacked(laid: bytes, kind: type = np.uint64) -> np.ndarray:
    return np.frombuffer(laid, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers in few bytes."""
    laid = _laid(values) if len(values) else b""
    return len(laid).to_bytes(8, "little") + pa.compress(laid, codec="zstd", asbytes=True) if laid else b""


def _eased(squeezed: bytes, kind: type = np.uint64) -> np.ndarray:
    if not squeezed:
        return np.zeros(0, kind)
    return _unpacked(pa.decompress(squeezed[8:], int.from_bytes(squeezed[:8], "little"), "zstd", asbytes=True), kind)


def _squeezed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as steps from one to the next."""
    return _squeezed(np.diff(keys, prepend=np.uint64(0)))


def _eased_keys(squeezed: bytes) -> np.ndarray:
    return np.cumsum(_eased(squeezed), dtype=np.uint64)


def _kinds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, where one of each is, and the place of every key among them."""
    by = np.argsort(keys)
    found = keys[by]
    first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    place = np.empty(len(keys), np.int32)
    place[by] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(keys))))
    return found[first], by[first], place


def _dealt(parts: int, key: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    """Rows ``part, keys, columns`` of sorted distinct keys, for each part that has any."""
    cuts = [0, *np.searchsorted(key, _edges(parts)), len(key)]
    return [(p, _squeezed_keys(key[a:b]), *(_squeezed(c[a:b]) for c in columns)) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written; the shuffle files behind it go at once, not when the driver happens to collect its garbage."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return materialize(df, label)
    finally:
        conf.set(name, before)


ENCODED = "batch long, held boolean, tokens long, words binary, places binary, lengths binary, ids array<{key}>"
SENT = "part int, batch long, kind tinyint, keys binary, times binary"
COUNTED = "batch long, part int, kind tinyint, fresh long, counts binary"
WALKED = "part int, batch long, kind tinyint, keys binary, first binary, second binary, third binary, ids array<{key}>, lengths binary, there binary, base binary, walk binary"
FAILED = "batch long, at binary, sums binary"
SCORED = "doc_id {key}, n_tokens long, there long, base double, walk double"


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _columns(rows: list[tuple], schema: pa.Schema) -> list[pa.Array]:
    return [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema, strict=True)]


def encoded(rows: DataFrame) -> DataFrame:
    """``batch, held, tokens, words, places, lengths, ids``: the tokens of some texts, all held out or none, as places in a list of their words.

    ``rows`` has ``doc_id, text, held``. Frequent words come first in the list, so most places are small numbers.
    """
    schema = ENCODED.format(key=rows.schema["doc_id"].dataType.simpleString())
    arrow = _arrow(schema)
    id_list = arrow.field("ids").type

    def run(batches):
        task, made = TaskContext.get().partitionId() << 32, 0
        held = {False: [], True: []}
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            for flag, open_ in held.items():
                some = batch.filter(pa.array(batch.column("held").to_numpy(zero_copy_only=False).astype(bool) == flag))
                texts = [t or b"" for t in some.column("text").cast(pa.large_binary()).to_pylist()]
                ids = some.column("doc_id").cast(id_list.value_type)
                for lo, hi in chunks(texts, BYTES_AT_ONCE):
                    tokens, first = tokens_of(texts[lo:hi])
                    open_.append((tokens, np.diff(np.append(first, len(tokens))), ids.slice(lo, hi - lo)))
                    if sum(len(x[0]) for x in open_) >= TOKENS_AT_ONCE:
                        yield out(task + made, flag, open_)
                        made += 1
                        open_.clear()
        for flag, open_ in held.items():
            if open_:
                yield out(task + made, flag, open_)
                made += 1

    def out(batch, flag, texts):
        tokens, lengths = (np.concatenate([x[k] for x in texts]) for k in (0, 1))
        ids = pa.concat_arrays([x[2] for x in texts])
        words, code, n = np.unique(tokens, return_inverse=True, return_counts=True)
        by = np.argsort(-n, kind="stable")
        place = np.empty(len(by), np.uint32)
        place[by] = np.arange(len(by), dtype=np.uint32)
        row = (batch, flag, len(tokens), _squeezed(words[by]), _squeezed(place[code]), _squeezed(lengths.astype(np.uint32)))
        columns = [pa.array([x], f.type) for x, f in zip(row, arrow)]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids, type=id_list)], names=arrow.names)

    return rows.select("doc_id", "text", "held").mapInArrow(run, schema)


def _tokens(words: bytes, places: bytes, lengths: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a batch's tokens, the place of each text's first one, and the texts' numbers of tokens."""
    lengths = _eased(lengths, np.uint32).astype(np.int64)
    return _eased(words)[_eased(places, np.uint32)], np.cumsum(lengths) - lengths, lengths


def grams_sent(batches: DataFrame, parts: int, low: int, high: int) -> DataFrame:
    """``part, batch, kind, keys, times``: distinct words (1), pairs (2) and triples (3) of each batch whose keys are of the parts
    from ``low`` to before ``high``; no times where the texts are held out."""
    edges, arrow = [0, *(int(e) for e in _edges(parts)), 1 << 64], _arrow(SENT)
    least_key, most_key = np.uint64(edges[low]), np.uint64(edges[high] - 1)

    def run(got):
        for table in got:
            for at in range(table.num_rows):  # one batch at a time is held as Python values
                batch, held, *packed = (table.column(c)[at].as_py() for c in ("batch", "held", "words", "places", "lengths"))
                tokens, first, _ = _tokens(*packed)
                g, rows = Grams(tokens, first), []
                for kind, keys in ((1, tokens), (2, g.pair), (3, g.triple)):
                    own = keys[(keys >= least_key) & (keys <= most_key)]
                    key, n = (np.unique(own), None) if held else np.unique(own, return_counts=True)
                    real = slice(int(kind > 1 and len(key) > 0 and key[0] == 0), None)
                    columns = [] if held else [n[real].astype(np.uint32)]
                    rows += [(p, batch, kind, *x, *[None] * held) for p, *x in _dealt(parts, key[real], *columns)]
                yield pa.RecordBatch.from_arrays(_columns(rows, arrow), names=arrow.names)

    return batches.select("batch", "held", "words", "places", "lengths").mapInArrow(run, SENT)


def gram_counts(sent: DataFrame, least: float) -> DataFrame:
    """``batch, part, kind, fresh, counts``: for each key that was sent twice the times it was seen in all training texts, 0 where a pair or triple
    has less than ``least``; one more where this batch is chosen to speak for the key. ``fresh`` tells how often it is."""
    arrow = _arrow(COUNTED)

    def count(table: pa.Table) -> pa.Table:
        kinds, part, rows = table["kind"].to_numpy(), table["part"][0].as_py(), []
        for kind in (1, 2, 3):
            some = table.filter(pa.array(kinds == kind))
            if not some.num_rows:
                continue
            keys = [_eased_keys(x.as_py()) for x in some["keys"]]
            n = [_eased(x.as_py(), np.uint32) if x.is_valid else np.zeros(len(k), np.uint32) for x, k in zip(some["times"], keys)]
            cuts = np.cumsum([0, *map(len, keys)])
            keys, n = np.concatenate(keys), np.concatenate(n)
            by = np.argsort(keys)
            keys, n = keys[by], n[by]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            del keys
            total = np.add.reduceat(n, first, dtype=np.int64)
            total[total < (least if kind > 1 else 1)] = 0
            group = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(n))))
            seen = np.flatnonzero((n > 0) & (total[group] > 0))
            chosen = seen[np.flatnonzero(np.diff(group[seen], prepend=-1))]
            counts = np.empty(len(by), np.uint64)
            counts[by] = (2 * total).view(np.uint64)[group]
            counts[by[chosen]] += np.uint64(1)
            for batch, a, b in zip(some["batch"].to_pylist(), cuts, cuts[1:]):
                rows.append((batch, part, kind, int((counts[a:b] & np.uint64(1)).sum()), _squeezed(counts[a:b])))
        return pa.table(_columns(rows, arrow), names=arrow.names)

    return sent.groupBy("part").applyInArrow(count, COUNTED)


def _asked(parts: int, batch: int, kind: int, key: np.ndarray, texts: np.ndarray, text: np.ndarray, times: np.ndarray) -> list[tuple]:
    """Rows of sorted distinct keys with the number of texts of each, and these texts and their times."""
    ends, rows = np.cumsum(texts), []
    cuts = [0, *np.searchsorted(key, _edges(parts)), len(key)]
    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            own = slice(ends[a] - texts[a], ends[b - 1])
            rows.append((p, batch, kind, _squeezed_keys(key[a:b]), _squeezed(text[own]), _squeezed(times[own]), _squeezed(texts[a:b].astype(np.uint32)), *[None] * 5))
    return rows


def walked(batches: DataFrame, counts: DataFrame, parts: int, z: float, least: float) -> DataFrame:
    """What each batch tells the part of a history: sums of its arcs' weights and of the shorter n-grams' (``kind`` 1 for words, 2 for pairs), and
    how often which text passes its failure arc (-1, -2); and of its texts (0) what they weigh without failure arcs."""
    schema = WALKED.format(key=batches.schema["ids"].dataType.elementType.simpleString())
    arrow = _arrow(schema)

    def walk(coded: pa.Table, counted: pa.Table) -> pa.Table:
        if not coded.num_rows:
            raise ValueError("counts of a batch that is not there")
        batch = coded["batch"][0].as_py()
        tokens, first, lengths = _tokens(*(coded[c][0].as_py() for c in ("words", "places", "lengths")))
        g = Grams(tokens, first)
        counted = counted.sort_by([("kind", "ascending"), ("part", "ascending")])
        kinds, key, place, seen, chosen = counted["kind"].to_numpy(), {}, {}, {}, {}
        for kind, keys in ((1, tokens), (2, g.pair), (3, g.triple)):
            said = [_eased(x.as_py()) for x in counted["counts"].filter(pa.array(kinds == kind))]
            key[kind], at, place[kind] = _kinds(keys)
            said = np.concatenate([np.zeros(int(kind > 1 and key[kind][0] == 0), np.uint64), *said])
            if len(said) != len(key[kind]):
                raise ValueError("counts of other n-grams than the batch holds")
            seen[kind] = (said >> np.uint64(1)).astype(np.int64)[place[kind]]
            chosen[kind] = at[(said & np.uint64(1)) == 1]
        one, two, three = seen[1], seen[2], seen[3]
        has_pair, has_triple = g.pair != 0, g.triple != 0
        del g, tokens, keys, key[3], place[3], at, said, seen, counted
        before = lambda x: np.append(0, x[:-1])  # noqa: E731  only read where the text has a token before
        p1 = (one + 0.5) / z
        p2 = np.where(two > 0, (two - DISCOUNT) / np.maximum(before(one), 1), 1.0)
        p3 = np.where(three > 0, (three - DISCOUNT) / np.maximum(before(two), 1), 1.0)
        rows = []
        row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        passed = {1: (two == 0) & has_pair & (before(one) >= least), 2: (three == 0) & has_triple & (before(two) > 0)}
        for kind, p, lower in ((1, p2, p1), (2, p3, p2)):
            at = chosen[kind + 1]
            arcs, *weights = (np.bincount(place[kind][at - 1], x, len(key[kind])) for x in (None, p[at], lower[at]))
            some = np.flatnonzero(arcs)
            rows += [(p, batch, kind, *x, *[None] * 6) for p, *x in _dealt(parts, key[kind][some], *(x[some] for x in weights))]
            at = np.flatnonzero(passed[kind])
            both, times = np.unique(place[kind][at - 1].astype(np.int64) * len(lengths) + row[at], return_counts=True)
            history, text = np.divmod(both, len(lengths))
            new = np.flatnonzero(np.diff(history, prepend=-1))
            texts = np.diff(np.append(new, len(both)))
            rows += _asked(parts, batch, -kind, key[kind][history[new]], texts, text.astype(np.int32), times.astype(np.uint32))
        base = np.log10(p1)
        weight = np.where(three > 0, np.log10(p3), np.where(two > 0, np.log10(p2), base))
        there, base, weight = (np.add.reduceat(x, first).astype(t) for x, t in (((one > 0).astype(np.int64), np.uint32), (base, float), (weight, float)))
        texts = [_squeezed(lengths.astype(np.uint32)), _squeezed(there), base.tobytes(), weight.tobytes()]
        out = pa.table(_columns(rows, arrow), names=arrow.names)
        own = [batch % parts, batch, 0, *[None] * 4, coded["ids"].combine_chunks(), *texts]
        own = pa.table([x if f.name == "ids" else pa.array([x], f.type) for x, f in zip(own, arrow, strict=True)], names=arrow.names)
        return pa.concat_tables([out, own.cast(out.schema)])

    return batches.groupBy("batch").cogroup(counts.groupBy("batch")).applyInArrow(walk, schema)


def _failures(table: pa.Table) -> pa.Table:
    """``batch, at, sums``: what the failure arcs of one part's histories add to the texts that pass them."""
    kinds, sums = table["kind"].to_numpy(), {}
    for kind in (1, 2):
        some = table.filter(pa.array(kinds == kind))
        asked = table.filter(pa.array(kinds == -kind))
        if not some.num_rows or not asked.num_rows:
            continue
        key = np.concatenate([_eased_keys(x.as_py()) for x in some["keys"]])
        key, place = np.unique(key, return_inverse=True)
        left, rest = (
            np.maximum(1 - np.bincount(place, np.concatenate([_eased(x.as_py(), np.float64) for x in some[c]]), len(key)), 1e-12) for c in ("first", "second")
        )
        fail = np.log10(left / rest)
        for batch, keys, at, times, texts in zip(*(asked[c].to_pylist() for c in ("batch", "keys", "first", "second", "third")), strict=True):
            where = np.repeat(_find(key, _eased_keys(keys)), _eased(texts, np.uint32))
            hit = where >= 0
            if hit.any():
                sums.setdefault(batch, []).append((_eased(at, np.int32)[hit], fail[where[hit]] * _eased(times, np.uint32)[hit]))
    rows = []
    for batch, added in sums.items():
        at, place = np.unique(np.concatenate([x for x, _ in added]), return_inverse=True)
        rows.append((batch, _squeezed(at), np.bincount(place, np.concatenate([x for _, x in added]), len(at)).tobytes()))
    return pa.table(_columns(rows, pa.schema([("batch", pa.int64()), ("at", pa.binary()), ("sums", pa.binary())])), names=["batch", "at", "sums"])


def _summed(texts: pa.Table, failed: pa.Table) -> pa.Table:
    """The texts of one batch, with the failure arcs of all parts."""
    lengths, there = (_eased(texts[c][0].as_py(), np.uint32).astype(np.int64) for c in ("lengths", "there"))
    base, walk = (np.frombuffer(texts[c][0].as_py()).copy() for c in ("base", "walk"))
    for at, sums in zip(failed["at"].to_pylist(), failed["sums"].to_pylist(), strict=True):
        walk[_eased(at, np.int32)] += np.frombuffer(sums)
    ids = texts["ids"].combine_chunks().flatten()
    return pa.table({"doc_id": ids, "n_tokens": lengths, "there": there, "base": base, "walk": walk})


def _all(tables: list[DataFrame]) -> DataFrame:
    found = tables[0]
    for more in tables[1:]:
        found = found.unionByName(more)
    return found


def score_texts(
    docs: DataFrame, of: int = 5, remainder: int = 1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Log10 probabilities of all texts under a word model and under the backoff automaton.

    Both learn from the rows whose key's CRC-32 modulo ``of`` is not ``remainder``. Tokens are lower-cased (A-Z)
    words between white space, and each text's end.

    Returns one row per input row: ``doc_id, held_out, n_tokens, n_known`` (tokens met in training), ``train_tokens,
    base_score, score``. NULL and empty texts are one end token; NULL keys count as the empty text for the split; without
    training rows every token is unknown; repeated rows are scored each; an empty table gives
    none; other columns are not read.
    """
    rows = pick(docs, **{key: "doc_id", text: "text"})
    held_out = is_held_out(F.col("doc_id"), of, remainder)
    batches = _settled(encoded(rows.withColumn("held", held_out)), "batches")
    all_tokens, train_tokens = (int(x or 0) for x in batches.agg(F.sum("tokens"), F.sum(F.when(~F.col("held"), F.col("tokens")))).first())
    parts, least = max(LEAST_PARTS * ROUNDS, -(-all_tokens // PART_TOKENS)), max(LEAST, SHARE * train_tokens)
    cuts = [parts * r // ROUNDS for r in range(ROUNDS + 1)]
    rounds = [_settled(gram_counts(grams_sent(batches, parts, low, high), least), "gram-counts") for low, high in zip(cuts, cuts[1:])]
    counts = _all(rounds)
    kinds = int(counts.filter("kind = 1").agg(F.sum("fresh")).first()[0] or 0)
    z, counts = train_tokens + 0.5 * (kinds + 1), counts.select("batch", "part", "kind", "counts")
    own = [F.pmod(F.xxhash64("batch"), F.lit(ROUNDS)) == r for r in range(ROUNDS)]
    walks = _all([_settled(walked(batches.filter(o), counts.filter(o), parts, z, least), "walks") for o in own])
    for used in (batches, *rounds):
        discard(used)
    failed = walks.filter("kind <> 0").select("part", "batch", "kind", "keys", "first", "second", "third").groupBy("part").applyInArrow(_failures, FAILED)
    texts = walks.filter("kind = 0").select("batch", "ids", "lengths", "there", "base", "walk")
    scored = SCORED.format(key=rows.schema["doc_id"].dataType.simpleString())
    summed = texts.groupBy("batch").cogroup(failed.groupBy("batch")).applyInArrow(_summed, scored)
    return summed.select(
        "doc_id", is_held_out(F.col("doc_id"), of, remainder).alias("held_out"), "n_tokens", F.col("there").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("walk").alias("score"),
    )


def _spelled(parts: int, part_kind: int, key: np.ndarray, codes: np.ndarray, vocabulary: np.ndarray) -> list[tuple]:
    """Rows ``part, kind, words, places``: the words of n-grams with sorted keys (``codes`` are places in ``vocabulary``), told once a row
    with the places of each n-gram's words among them. The key and all shorter n-grams follow from the words, in less than their own bytes. ``score_texts`` sends keys."""
    place, rows = np.zeros(len(vocabulary), np.uint32), []
    cuts = [0, *np.searchsorted(key, _edges(parts)), len(key)]
    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            some = codes[:, a:b]
            some = some[:, np.argsort(some[0] * len(vocabulary) + some[1])]  # equal first words side by side, which compresses
            there = np.zeros(len(vocabulary), bool)
            there[some] = True
            used = np.flatnonzero(there)
            place[used] = np.arange(len(used), dtype=np.uint32)
            rows.append((p, part_kind, vocabulary[used].tobytes(), _laid(place[some].ravel())))
    return rows


def _read_out(part_kind: int, words: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, histories and shorter n-grams of one row of ``_spelled``."""
    w = np.frombuffer(words, np.uint64)[_unpacked(places, np.uint32).reshape(part_kind, -1)]
    history, shorter = (w[0], w[1]) if part_kind == 2 else (mix(w[0] * _BASE + w[1]), mix(w[1] * _BASE + w[2]))
    return mix(history * _BASE + w[-1]), history, shorter
