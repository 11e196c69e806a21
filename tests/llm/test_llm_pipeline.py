"""The pipeline's stages against plain versions of what each should keep."""

import re
from collections import Counter

import corpus_pipeline
from tallystone.llm import quality
from test_llm_matching import alnum, components_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf, words):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "decontaminate", "pack"]
    score = {r["doc_id"]: r["score"] for r in quality.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    left = {r["doc_id"]: r["text"] for r in docs.collect() if score[r["doc_id"]] >= 0.3}
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())

    docs = stages["quality"](spark, docs, sf)
    assert docs.columns == COLUMNS and ids(docs) == sorted(left) and len(left) > 100

    first = {}
    for k in sorted(left):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", left[k] or ""), k)
    left = {k: left[k] for k in first.values()}
    docs = stages["exact_dedup"](spark, docs, sf)
    assert docs.columns == COLUMNS and ids(docs) == sorted(left)

    found, _ = components_of([(k, t, None) for k, t in left.items()], words, 5, 80)
    left = {k: left[k] for k, n, c in found if k == c or n == 0}
    docs = stages["near_dedup"](spark, docs, sf)
    assert docs.columns == COLUMNS and ids(docs) == sorted(left)

    runs = {tuple(w[i : i + 13]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in [alnum(r["text"])] for i in range(len(w) - 12)}
    for k in list(left):
        w = alnum(left[k])
        hit = {j for i in range(len(w) - 12) if tuple(w[i : i + 13]) in runs for j in range(i, i + 13)}
        if hit and 20 * len(hit) >= len(w):
            del left[k]
    docs = stages["decontaminate"](spark, docs, sf)
    assert docs.columns == COLUMNS and ids(docs) == sorted(left)

    packed = stages["pack"](spark, docs, sf).collect()
    assert {r["doc_id"] for r in packed} == set(left)
    used = Counter()
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048 and len(used) <= sum(used.values()) / 2048 * 1.02 + 1


def test_stages_take_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.collect() == []


def test_run_gives_the_last_stage(spark, sf):
    assert corpus_pipeline.run(spark, sf).columns[:6] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id"]
