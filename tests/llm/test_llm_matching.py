"""Decontamination, near copies and repeated passages against brute force."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallystone.llm import common, decontaminate, graph, jaccard, suffix_dedup
from tallystone.session import shared_dir

ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def alnum(text):
    return ALNUM.findall((text or "").encode().lower())


def test_contamination(spark, docs, rows, sf, nothing):

    copied = next(t for k, t, _ in rows if k == 100_005)
    given = [("a", copied), ("b", "the the"), ("c", None), ("d", ""), ("a", "one"), (None, "a NULL key")]
    extra = spark.createDataFrame(given, "item_id string, text string").selectExpr("*", "1 AS run", "2 AS size")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").selectExpr("cast(item_id as string) item_id", "text", "0 AS run", "0 AS size")
    items = extra.unionByName(bench)
    runs = defaultdict(set)
    for r in items.collect():
        w = alnum(r["text"])
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            runs[tuple(w[i : i + n])].add(r["item_id"] or "")
    sizes = {len(x) for x in runs}
    want = Counter()
    for key, text, _ in rows:
        w, hit, ids = alnum(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in runs:
                    hit.update(range(i, i + n))
                    ids |= runs[tuple(w[i : i + n])]
        want[key, len(w), len(hit), tuple(sorted(ids))] += 1
    got = decontaminate.contamination(docs, items)
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got.collect()) == want
    assert sum(n for (_, _, hit, _), n in want.items() if hit) > 10
    assert decontaminate.contamination(nothing, items).collect() == []
    assert {r["n_hit"] for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}


def components_of(rows, words, size, percent):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = []
    for i, (_, text, _) in enumerate(rows):
        w = words(text)
        k = min(size, len(w))
        sets.append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset())
        parent[i] = i
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    for (a, b), n in Counter((a, b) for x in lists.values() for a in x for b in x if a < b).items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[find(b)] = find(a)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((k for k in keys if k is not None), default=None) for g, keys in groups.items()}
    return Counter((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), len(groups)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_near_copies(docs, rows, words, size, percent):
    want, groups = components_of(rows, words, size, percent)
    got = jaccard.near_copies(docs, size, percent).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    if size == 5:
        kept = jaccard.drop_near_copies(docs)
        once = len({(k, t) for k, t, _ in rows})  # rows equal in key and text share one mark
        assert kept.columns == docs.columns
        assert len({(r["doc_id"], r["text"]) for r in kept.collect()}) == groups
        assert once <= len(rows)


def test_near_copies_of_nothing(nothing):
    assert jaccard.near_copies(nothing).collect() == []


def test_large_clusters_are_compared_by_blocks(spark, words, monkeypatch):
    """Many near copies of one text: blocks, several levels and tree edges find the same components."""
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(150)]
    rows = []
    for i in range(160):
        w = list(base)
        for j in rng.choice(150, rng.integers(0, 5), replace=False):
            w[j] = f"e{i}_{j}"
        rows.append((i, " ".join(w), None))
    monkeypatch.setattr(jaccard, "BLOCK", 4000)
    want, groups = components_of(rows, words, 5, 80)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = jaccard.near_copies(docs).collect()
    assert 1 < groups < 160
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want


def test_near_copies_leave_little_on_disk(spark, docs, monkeypatch):
    """Shuffles go with the table they made, tables with the last that reads them; only what the result reads is left."""
    folder, names = f"{shared_dir(spark)}/tallystone", lambda d: {x.rsplit("-", 1)[0] for x in d}
    os.makedirs(folder, exist_ok=True)
    before, write, dropped = set(os.listdir(folder)), common.materialize, []

    def counted(df, label):
        dropped.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        return write(df, label)

    monkeypatch.setattr(common, "materialize", counted)
    found = jaccard.near_copies(docs)
    assert names(set(os.listdir(folder)) - before) == {"classes", "class-firsts", "stars"} and len(set(os.listdir(folder)) - before) == 3
    assert len(dropped) > 10 and set(dropped) == {"true"} and found.count() == docs.count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b}
    assert {x: find(x) for x in parent if x in got} == got and set(parent) - set(got) <= alone


def repeats(rows, length):
    texts = [(k, (t or "").encode()) for k, t, _ in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    want = Counter()
    for k, t in texts:
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = 1
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want[k, len(t), int(gone.sum()), int((np.diff(np.append(0, gone)) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return want


def test_remove_repeats(docs, rows, nothing):
    got = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == repeats(rows, 200)
    assert suffix_dedup.remove_repeats(nothing).collect() == []


def test_remove_repeats_with_a_passage_in_most_texts(spark):
    rng = np.random.default_rng(11)
    say = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    passage, rows = say(90), []
    for i in range(150):
        a, b = sorted(rng.integers(0, 90, 2))
        middle = passage if i % 3 else passage[a:b]
        rows.append((i, say(int(rng.integers(0, 60))) + middle + say(int(rng.integers(0, 60))) + ("xy" * 40 if i % 7 == 0 else ""), None))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, length=40, head=16).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == repeats(rows, 40)


def test_family_merges_geometrically():
    rng = np.random.default_rng(2)
    family, heads, spans = suffix_dedup.Family(), rng.integers(0, 4000, 6000, dtype=np.uint64), rng.integers(0, 3, 6000, dtype=np.uint64)
    for i in range(0, 6000, 500):
        part = slice(i, i + 500)
        family.add(suffix_dedup.SuffixArray(heads[part], spans[part], np.arange(i, i + 500), np.zeros(500, np.int64), np.zeros(500, bool)))
        sizes = [len(x) for x in family.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == i + 500
    n_head, n_both = Counter(heads.tolist()), Counter(zip(heads.tolist(), spans.tolist()))
    for level in family.levels:
        for i, state in zip(level.payload, level.state):
            assert state == (2 if n_both[int(heads[i]), int(spans[i])] > 1 else 1 if n_head[int(heads[i])] > 1 else 0)
