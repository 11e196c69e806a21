"""From raw documents to packed sequences: filter, deduplicate, decontaminate, pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallystone.llm import decontaminate, exact_dedup, jaccard, packing, quality
from tallystone.llm.common import materialize, without
from tallystone.llm.queries import table, tokenizer_file

#: Score below which the quality classifier rejects a document.
REJECTED_BELOW = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    scored = quality.classify(docs, table(spark, sf_dir, "labels"))
    return without(docs, scored.filter(scored["score"] < REJECTED_BELOW).select("mark").distinct())


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest key."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by sets of five-word shingles with a similarity of 0.8 or more."""
    return jaccard.drop_near_copies(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in benchmark passages."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.filter(decontaminate.contaminated()).select("mark").distinct())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack_sequences),
]

#: The classifier and the tokenizer have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
