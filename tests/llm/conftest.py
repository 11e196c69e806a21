import re

import pytest

SPACES = r"[^\x20\x09-\x0D]+"
LOWER = {i: i + 32 for i in range(65, 91)}

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
COPY = " ".join(f"word{i * i % 101}" for i in range(120))
ODD = [
    (100_001, None, None, None),
    (100_002, "", "en", "s1"),
    (100_003, " \t\n ", "en", None),
    (100_004, LONG, "en", "s1"),
    (100_005, COPY, "en", "s2"),
    (100_006, COPY, "en", "s3"),
    (100_006, COPY, "en", "s3"),
    (100_007, COPY.replace(" ", "\n\t"), None, "s2"),
    (100_008, COPY.replace("word4 ", "other "), "en", "s2"),
    (None, COPY + " tail", "en", "s2"),
    (None, "a null key", "en", "s2"),
    (100_009, "the the the the the the", "en", "s1"),
    (100_010, "One", "en", "s1"),
    (100_011, "żółw 中文 \U0001f600 é" * 40, "pl", "s1"),
    (100_012, "<|endoftext|> x<|startoftext|>y 'S don't", "en", "s1"),
    (100_013, "nul\x00byte and \x1c control", "en", "s1"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns that an operator might use itself; none may matter.
CLASHES = ["row", "mark", "n", "set", "token", "bucket", "length", "hits", "word", "place", "start", "slot", "y"]


def odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    for i, c in enumerate(CLASHES):
        df = df.selectExpr("*", f"{i}L AS `{c}`" if i % 2 else f"'{c}' AS `{c}`")
    return df


@pytest.fixture(scope="session")
def docs(spark, sf, tmp_path_factory):
    """The small table with awkward rows and columns beside it, as files."""
    small = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    df = odd_rows(spark).unionByName(small, allowMissingColumns=True)
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    df.repartition(3, "text").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]


@pytest.fixture(scope="session")
def nothing(spark):
    return odd_rows(spark).limit(0)


@pytest.fixture(scope="session")
def words():
    return lambda text: re.findall(SPACES, (text or "").translate(LOWER))
