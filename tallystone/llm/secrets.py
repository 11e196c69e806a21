"""Secrets in texts, and who owns them: column expressions and joins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import materialize

# The patterns of the base kinds, in the order in which spans at one place are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ["assign", "access", "hex"]
ASSIGN_LEAST = 6
#: Runs that may be a credential without a name before it: 20 characters or more with both cases and a digit.
BARE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}"
KINDS = [*BASE_KINDS, "bare"]
#: A value found with this many owners is a copied example.
EXAMPLE_OWNERS = 3
#: A value with more than one owner is also an example if it is in this many repositories.
EXAMPLE_REPOSITORIES = 20


def _places(text: Column, pattern: str, found: Column) -> Column:
    """Start of each match in code points: what lies before it, match by match."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    step = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        return F.struct((start + pair["size"]).alias("at"), F.concat(state["starts"], F.array(start)).alias("starts"))

    pairs = F.transform(F.slice(between, F.lit(1), F.size(found)), lambda gap, i: F.struct(gap.alias("gap"), F.length(F.get(found, i)).alias("size")))
    return F.aggregate(pairs, step, add)["starts"]


def _spans(text: Column, pattern: str, kind: int, found: Column, value: Column | None = None) -> Column:
    """``at, kind, end, value`` of each match; texts without a match skip the work."""
    value = found if value is None else value
    starts = _places(text, pattern, found)
    spans = F.transform(
        starts,
        lambda s, i: F.struct(
            s.alias("at"), F.lit(kind).alias("kind"), (s + F.length(F.get(found, i))).alias("end"), F.get(value, i).alias("value")
        ),
    )
    empty = F.array().cast("array<struct<at:int,kind:int,end:int,value:string>>")
    return F.when(F.size(found) > 0, spans).otherwise(empty)


def candidates(docs: DataFrame) -> DataFrame:
    """Per row: the base spans, and the bare runs that no base span meets. ``docs`` has ``text`` without NULL."""
    all_of = lambda pattern, group=0: F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    text = F.col("text")
    found = docs.select("*", all_of(ASSIGN).alias("m0"), all_of(ACCESS).alias("m1"), all_of(HEX).alias("m2"), all_of(BARE).alias("m3"))
    value = F.when(F.size("m0") > 0, all_of(ASSIGN, 1)).otherwise(F.array().cast("array<string>"))
    found = found.select(
        "*",
        _spans(text, ASSIGN, 0, F.col("m0"), value).alias("s0"),
        _spans(text, ACCESS, 1, F.col("m1")).alias("s1"),
        _spans(text, HEX, 2, F.col("m2")).alias("s2"),
        _spans(text, BARE, 3, F.col("m3")).alias("s3"),
    )
    base = F.array_sort(F.concat(F.filter("s0", lambda s: F.length(s["value"]) >= ASSIGN_LEAST), "s1", "s2"))
    found = found.drop("text", "m0", "m1", "m2", "m3").withColumn("base", base)
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]")
    apart = lambda s: ~F.exists("base", lambda b: (b["at"] < s["end"]) & (s["at"] < b["end"]))
    return found.withColumn("bare", F.filter("s3", lambda s: mixed(s) & apart(s))).drop("s0", "s1", "s2", "s3")


def ownership(spans: DataFrame) -> DataFrame:
    """``hash, owners, repositories``: in how many distinct owners and repositories each value occurs.

    Each step counts groups of the one before, with partial counts before every shuffle, so a value
    in a third of all rows is spread over its repositories first and its owners next.
    """
    each = spans.select("hash", "owner", "repository").distinct()
    by_owner = each.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["at"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(
    docs: DataFrame, owner: str = "source", repository: str = "doc_id", key: str = "doc_id", text: str = "text",
    example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """Base secrets of every text, bare credentials of few owners, and how widely each value is copied.

    Candidate values are hashed; a hash found with ``example_owners`` distinct owners or more, or in ``example_repositories``
    repositories of more than one owner, is a copied example, any other looks live: one owner may hold a credential
    in any number of repositories. Bare runs (long, with both cases and digits, outside base spans) are
    added as spans only if they look live; base spans always stay.

    Returns one row per input row: ``doc_id, base`` and ``spans`` (lists of ``at, kind, end, value``, sorted),
    ``base_text`` and ``spans_text`` (kind:start:end, comma-joined, in code points), ``n_live, n_example``
    (spans of either sort, before bare examples go). NULL text is empty; NULL owners and repositories are one of their own; repeated rows
    are scanned each; an empty table gives none; other columns are not read.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
    )
    found = candidates(rows).withColumn("row", F.monotonically_increasing_id())
    found = materialize(found, "secrets")
    spans = found.select("row", "owner", "repository", F.explode(F.concat("base", "bare")).alias("span"))
    spans = spans.withColumn("hash", F.sha2(F.col("span.value").cast("binary"), 256))
    spread = (F.col("owners") > 1) & (F.col("repositories") >= example_repositories)
    judged = spans.join(ownership(spans), "hash").withColumn("example", (F.col("owners") >= example_owners) | spread)
    keep = F.when((F.col("span.kind") < len(BASE_KINDS)) | ~F.col("example"), F.col("span"))
    per_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(keep)).alias("spans"),
        F.count_if(~F.col("example")).alias("n_live"),
        F.count_if("example").alias("n_example"),
    )
    none = F.array().cast(per_row.schema["spans"].dataType)
    joined = found.select("row", "doc_id", "base").join(per_row, "row", "left")
    return joined.select(
        "doc_id", "base", F.coalesce("spans", none).alias("spans"),
        _text_of(F.col("base")).alias("base_text"), _text_of(F.coalesce("spans", none)).alias("spans_text"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )
