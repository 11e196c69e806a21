"""Spelling variants, repeated lines and clusters, each against a plain version."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallystone.llm import clustering, line_dedup, queries, spelling

LOWER = {i: i + 32 for i in range(65, 91)}


def counted_words(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near_words(words):
    """Words one edit apart, by what is left of them without one letter."""
    less, near = defaultdict(set), {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            less[i, w[:i] + w[i + 1 :]].add(w)
    for (_, rest), some in less.items():
        for w in some:
            near[w] |= some - {w}
            if rest in near:
                near[w].add(rest)
                near[rest].add(w)
    return near


def spelling_rows(counts):
    near, form = near_words(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return Counter(rows)


def test_spelling_groups(docs, rows):
    got = Counter(map(tuple, spelling.spelling_groups(docs).collect()))
    want = spelling_rows(counted_words([(k, t) for k, t, _ in rows]))
    assert got == want and sum(1 for r in want if r[1]) > 100


def test_words_of_any_length_are_neighbours(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("abé") for _ in range(70))
    words = {base[:n] for n in (45, 46, 47, 48, 49, 70)} | {base[:30] + base[31:], base[1:48], base[:20] + "z" + base[21:47]}
    words |= {base[:10] + "z" + base[11:], base + "b", "q" * 3000, "q" * 3001, "q" * 2999 + "z", "z" + "q" * 2999, "a", "b", "ab", "ba", "aab"}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(120)}
    got = spelling.neighbours(spark.createDataFrame([(w,) for w in sorted(words)], "word string")).collect()
    want = {(a, b) for a, some in near_words(words).items() for b in some}
    assert Counter(map(tuple, got)) == Counter(want) and len(want) > 50


def test_a_trie_has_an_edge_for_each_way(spark):
    words = ["car", "cars", "care", "cat", "dog"]
    edges = spelling.trie(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    got = {(e["node"], e["label"], e["child"], e["ends"], e["nexts"]) for e in edges}
    assert got == {
        ("", "ca", "ca", False, "rt"), ("", "dog", "dog", True, ""), ("ca", "r", "car", True, "es"), ("ca", "t", "cat", True, ""),
        ("car", "e", "care", True, ""), ("car", "s", "cars", True, ""),
    }


def test_roots_follow_forms_to_the_last(spark):
    forms = [(f"w{i}", f"w{i // 2}") for i in range(1, 40)]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(forms[1:], "word string, form string")).collect()}
    assert got == {f"w{i}": "w1" for i in range(2, 40)}


def test_spelling_of_nothing(nothing, spark):
    assert spelling.spelling_groups(nothing).collect() == []
    none = spark.createDataFrame([(1, None), (2, ""), (3, "12 34"), (None, "two words")], "doc_id long, text string")
    assert spelling.spelling_groups(none).collect() == []


def plain_lines(rows):
    strip = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    order = lambda key: float("-inf") if key is None else key
    held, out = defaultdict(list), []
    for key, text in rows:
        for line in {strip(x) for x in (text or "").split("\n")}:
            if len(line) >= 20:
                held[line].append(order(key))
    for key, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(held.get(strip(x), ())) >= 3 and max(held[strip(x)]) > order(key))]
        out.append((key, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


LINES = [
    (1, "a line of twenty chars\nother"), (2, "  A LINE of twenty chars\t\r\nown line of this document\n"),
    (3, "x\n\na line of twenty chars\na line of twenty chars"), (None, "a line of twenty chars\nkept"), (None, None), (4, ""),
    (5, "ééééééééééééééééééé\n twenty with a hard space"), (6, "ééééééééééééééééééé"), (7, "ééééééééééééééééééé"), (8, "\x0b\x0c\x1c"),
    (9, "zwanzig Zeichen Übung"), (10, "zwanzig Zeichen Übung\nzwanzig zeichen übung"), (10, "zwanzig zeichen Übung"), (11, "\n" * 50),
]


def test_drop_lines(spark, docs, rows):
    table = spark.createDataFrame(LINES, "doc_id long, text string").repartition(5)
    for df, plain in ((table, LINES), (docs, [(k, t) for k, t, _ in rows])):
        got = line_dedup.drop_lines(df).collect()
        assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got) == plain_lines(plain)
        assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)
        assert sum(r["n_dropped"] for r in got) >= 4


@pytest.mark.parametrize("share", [0.0, 2.0])
def test_lines_told_and_lines_probed_are_dropped_alike(spark, docs, rows, monkeypatch, share):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", share)
    monkeypatch.setattr(line_dedup, "SHARD_BYTES", 20_000)
    got = line_dedup.drop_lines(docs).collect()
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got) == plain_lines([(k, t) for k, t, _ in rows])


def test_lines_of_nothing(nothing, spark):
    assert line_dedup.drop_lines(nothing).collect() == []
    with pytest.raises(TypeError, match="integral"):
        line_dedup.drop_lines(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_perfect_hash_numbers_each_key_once():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000, 50_000):
        hashed, mark = rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**32, n, dtype=np.uint32)
        hashed[: n // 10] = hashed[n // 10 : 2 * (n // 10)]  # told apart by their fingerprints
        numbers = line_dedup.PerfectHash.of(hashed, mark)
        assert np.array_equal(np.sort(numbers.number(hashed, mark)), np.arange(n))
        assert sum(len(x) * 8 for x in numbers.levels) <= 8 * n + 64 * 20
        strange = numbers.number(rng.integers(0, 2**63, 1000, dtype=np.uint64), rng.integers(0, 2**32, 1000, dtype=np.uint32))
        assert strange.min() >= -1 and strange.max() < max(n, 1)


def plain_clusters(rows, k=8, rounds=10, seed=3):
    kept = []
    for key, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((key, tuple(int(np.floor(1024 * float(x))) for x in v)))
    digest = lambda key: hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    packed = lambda v: np.array(v, "<i4").tobytes()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), packed(r[1])))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [tuple(sum(x) // len(groups[i]) for x in zip(*groups[i], strict=True)) if groups[i] else c for i, c in enumerate(centroids)]
    found = [(key, *reversed(nearest(v))) for key, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((key, c, d, inertia[c], sum(inertia.values()), name[c]) for key, c, d in found)


def shown(df):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return Counter(map(tuple, df.select(columns).collect()))


def test_cluster_vectors(spark, sf):
    some = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    nan, inf = float("nan"), float("inf")
    base = some[0][1]
    odd = [
        (None, base), (900_001, None), (900_002, []), (900_003, base[:63]), (900_004, [*base, 0.0]), (900_005, [None, *base[1:]]),
        (900_006, [nan, *base[1:]]), (900_007, [-inf, *base[1:]]), (900_008, base), (900_008, base), (900_009, [-x for x in base]), (900_010, [0.0] * 64),
    ]
    table = spark.createDataFrame([(k, v, "x", 1) for k, v in some + odd], "vec_id long, embedding array<float>, cluster string, v int").repartition(4)
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = clustering.cluster_vectors(table)
    assert shown(got) == plain_clusters(rows)
    assert got.agg({"measured": "avg"}).first()[0] < 8  # bounds cut some


def test_few_or_equal_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([(1, [0.5] * 64)], [(i, [0.25] * 64) for i in range(30)], [(i, [i / 8] * 64) for i in range(5)], [(i % 3, [1e4 * i] * 64) for i in range(9)]):
        assert shown(clustering.cluster_vectors(spark.createDataFrame(rows, schema))) == plain_clusters(rows)
    assert clustering.cluster_vectors(spark.createDataFrame([(1, None)], schema)).collect() == []
    other = spark.createDataFrame([(1, [0.0, 1.0])], "name long, x array<double>")
    assert clustering.cluster_vectors(other, components=2, key="name", vector="x").first()["distance"] == 0
    with pytest.raises(Exception, match="would not fit"):
        clustering.cluster_vectors(spark.createDataFrame([(1, [1e300] * 64)], schema)).collect()


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(6)
    v = rng.integers(-(1 << 26), 1 << 26, (400, 16))
    v[200:] = v[:200] + rng.integers(-2, 3, (200, 16))
    pivots, centroids = v[:5], v[100:108]
    d = np.sqrt(np.stack([clustering._exact(v, p) for p in pivots], axis=1).astype(float))
    bounds = clustering.Bounds(pivots, centroids)(d)
    exact = np.stack([clustering._exact(v, c) for c in centroids], axis=1)
    assert (bounds**2 * (1 - clustering.SLACK) <= exact).all() and (bounds > 0).mean() > 0.5
    cluster, best, measured = clustering.nearest(v, d, centroids, clustering.Bounds(pivots, centroids))
    assert np.array_equal(cluster, exact.argmin(axis=1)) and np.array_equal(best, exact.min(axis=1))


@pytest.mark.parametrize("name", ["op11_spelling", "op12_line_dedup", "op13_clustering"])
def test_queries_match_their_sql(spark, sf, name):
    from tools.check_oracles import connect

    got = queries.QUERIES[name](spark, sf)
    want = connect(sf).execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(want.fetchall())
