"""Packing, sharding and exact duplicates."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystone.llm import exact_dedup, packing, sharding
from tallystone.llm.queries import tokenizer_file


@given(st.lists(st.integers(1, 60), min_size=1, max_size=200), st.just(60))
@settings(max_examples=150, deadline=None)
def test_lengths_are_packed_like_single_pieces(lengths, capacity):
    bins = packing.pack_lengths(dict(Counter(lengths)), capacity)
    seen = Counter()
    for b in bins:
        used = sum(length * k for length, k in b.runs)
        assert b.count > 0 and used + b.gap == capacity and b.gap >= 0
        assert sum(k for length, k in b.runs if length > capacity // 3) <= 2
        for length, k in b.runs:
            seen[length] += k * b.count
    assert seen == Counter(lengths)
    # one by one: pairs of large pieces, longest first, then each smaller piece into the fullest bin
    left = sorted((x for x in lengths if x > capacity // 3), reverse=True)
    gaps = []
    while left:
        a = left.pop(0)
        b = next((x for x in left if x <= capacity - a), None)
        if b:
            left.remove(b)
        gaps.append(capacity - a - (b or 0))
    for x in sorted((x for x in lengths if x <= capacity // 3), reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - x)
    assert sum(b.count for b in bins) == len(gaps)


def test_pack(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    got = packing.pack(docs, path, capacity=64).collect()
    want = Counter()
    for key, text, _ in rows:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want[key, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 64
    assert len(bins) <= 1.02 * sum(r["length"] for r in got) / 64 + 1


def test_pack_nothing(nothing):
    assert packing.pack(nothing, tokenizer_file("word_bpe_49k.json")).collect() == []


@pytest.mark.parametrize("total", [1, 2, 3, 5, 7, 16, 17, 101, 1000])
def test_permutation(spark, total):
    got = spark.range(total).select(sharding.permute(F.col("id"), total, 5).alias("p"))
    assert sorted(r["p"] for r in got.collect()) == list(range(total))


def test_shard(docs, rows, nothing):
    got = sharding.shard(docs, 8).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode()) + 1
    want = Counter((k, size(t), zlib.crc32((t or "").encode())) for k, t, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r["slot"])
    assert set(shards) <= set(range(8)) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    other = sharding.shard(docs.repartition(7), 8).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, other))
    assert sharding.shard(nothing, 8).collect() == []


def test_sharding_runs_no_python(docs):
    plan = sharding.shard(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_find_copies(docs, rows, nothing):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for k, t, _ in rows:
        groups[norm(t)].append(k)
    got = exact_dedup.find_copies(docs).collect()
    assert len(got) == len(rows)
    by_digest = defaultdict(list)
    for r in got:
        by_digest[r["text_sha256"]].append(r)
    for text, keys in groups.items():
        rs = by_digest[hashlib.sha256(text.encode()).hexdigest()]
        first = min((k for k in keys if k is not None), default=None)
        assert sorted(map(str, keys)) == sorted(str(r["doc_id"]) for r in rs)
        assert {r["keep_id"] for r in rs} == {first} and {r["group_size"] for r in rs} == {len(keys)}
        assert sum(r["kept"] for r in rs) == 1
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.find_copies(nothing).collect() == []


def test_cuckoo_filter_grows_and_forgets():
    digest = lambda i: hashlib.sha256(str(i).encode()).digest()
    bucket = exact_dedup.Bucket()
    rows = bucket.filter.rows
    for i in range(5000):
        bucket.insert(digest(i), (False, i, i), 1)
    assert bucket.filter.rows > rows and all(bucket.lookup(digest(i)) for i in range(5000))
    assert not any(bucket.lookup(digest(i)) for i in range(5000, 6000))
    gone = random.Random(1).sample(range(5000), 2500)
    assert all(bucket.delete(digest(i)) for i in gone) and not bucket.delete(digest(gone[0]))
    again = exact_dedup.Bucket(bucket.stored, bucket.filter.dump())
    assert {i for i in range(5000) if again.lookup(digest(i))} == set(range(5000)) - set(gone)
    bucket.insert(digest(4999), (False, 7, 7), 2)
    assert bucket.lookup(digest(4999))[0] == (False, 7, 7)


def test_index_takes_batches_and_deletes(spark):
    texts = [(i, f"text {i % 40}") for i in range(100)]
    one = exact_dedup.digest_rows(spark.createDataFrame(texts[50:], "doc_id long, text string"))
    two = exact_dedup.digest_rows(spark.createDataFrame(texts[:50], "doc_id long, text string"))
    index = exact_dedup.CuckooIndex.empty(one, 10).insert(one).insert(two)
    assert {(r["first_id"], r["copies"]) for r in index.entries().collect()} == {(i, 3 if i < 20 else 2) for i in range(40)}
    index = index.delete(two.filter("doc_id < 10").select("digest"))
    assert {r["first_id"] for r in index.entries().collect()} == set(range(10, 40))
    index = index.insert(two.filter("doc_id = 41"))
    assert {r["first_id"]: r["copies"] for r in index.entries().collect()}[41] == 1


def test_later_batches_hit_the_filter_which_grows(spark):
    rows = spark.range(400).selectExpr("id AS doc_id", "id AS row", "unhex(sha2(cast(id % 90 AS string), 256)) AS digest")
    index = exact_dedup.CuckooIndex.empty(rows, 400).insert(rows, 4)
    assert {(r["first_id"], r["copies"]) for r in index.entries().collect()} == {(i, 5 if i < 40 else 4) for i in range(90)}
    assert index.hits() > 90  # most digests are in several of the four batches
    first = len(exact_dedup.CuckooFilter.for_size(0).dump())
    assert index.table.filter("digest IS NULL").selectExpr("max(length(filter)) AS n").first()["n"] > first
    assert exact_dedup.CuckooIndex.empty(rows, 400).insert(rows).hits() == 0
