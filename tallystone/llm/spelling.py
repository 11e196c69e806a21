"""Spelling variants: words one edit apart, found by walking a frontier through a trie held as an edge table.

The trie is path-compressed: a node is a prefix that ends a word or goes on in two ways, an edge is the
text between two nodes. The frontier is a table of states (word, position, node, edits). Each round joins all states with
the edges of their nodes: a state follows the edge that its word spells, or spends its one edit on the edge. A
state with its edit spent that reaches the end of its word at a word's node is a pair of neighbours. Being near is mutual, so the
walk only deletes letters, or replaces one by a later one; the other directions follow by turning pairs round.

Letters are the 26 of a-z and 64 more, so a node has 90 edges at most, and a word makes states in proportion to its letters.
Words are in the trie forwards and backwards, which keeps edits out of the upper nodes with their many edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import _INVERSE, materialize, mix, pick, prefix_hash, scan, signed

#: The letters of a run, and the two rows that A-Z are lower-cased by.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of this many letters or more are compared by the hashes of what is left without one letter: a trie of them
#: would hold each prefix, which grows with the square of their length.
LONG = 48
#: Nodes that hold more than this share of a round's states go by broadcast: there are at most 1000 of them.
HOT_SHARE = 1e-3


def words_of(docs: DataFrame, drop_one_in: int | None = 97) -> DataFrame:
    """``word, times``: all runs of ``docs`` (``doc_id, text``), lower-cased and counted.

    With ``drop_one_in``, a run loses one letter if the CRC-32 of ``doc_id:run`` is divisible by it: spelling errors
    that depend on the row alone.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    plain = F.length("run") == F.octet_length("run")
    low = F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    rows = rows.select("id", low.alias("word"))
    if drop_one_in:
        hashed = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = F.pmod(F.col("hashed"), F.length("word").cast("long")).cast("int")
        without = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        hit = F.pmod(F.col("hashed"), F.lit(drop_one_in)) == 0
        rows = rows.withColumn("hashed", hashed).select(F.when(hit, without).otherwise(F.col("word")).alias("word"))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("times"))


def _after(word: str, at: str | Column, size: Column | None = None) -> Column:
    """What follows the first ``at`` letters, ``size`` letters of it if given."""
    at = F.col(at) if isinstance(at, str) else at
    return F.substring(word, at + 1, F.lit(LONG + 1) if size is None else size)


def trie(words: DataFrame) -> DataFrame:
    """Edges ``node, first, label, child, ends, nexts`` of the compressed trie of ``word`` (distinct, ``LONG`` letters at most).

    ``ends`` tells whether the child is a word, ``nexts`` holds the first letters of its own edges. The child of
    a node and a letter is the common beginning of the least and the greatest word below them.
    """
    at = F.explode(F.sequence(F.lit(0), F.length("word")))
    prefixes = words.select("word", at.alias("size")).select(
        F.substring("word", F.lit(1), F.col("size")).alias("node"), _after("word", "size", F.lit(1)).alias("first"), "word"
    )  # a word's own end is the empty letter
    ways = materialize(prefixes.groupBy("node", "first").agg(F.min("word").alias("least"), F.max("word").alias("most")), "trie-ways")
    nodes = ways.groupBy("node").agg(
        F.concat_ws("", F.array_sort(F.collect_list("first"))).alias("nexts"), F.count(F.lit(1)).alias("n"), F.bool_or(F.col("first") == "").alias("ends")
    )
    nodes = nodes.filter((F.col("n") > 1) | F.col("ends") | (F.col("node") == "")).drop("n")
    down = ways.filter("first <> ''").join(nodes.select("node"), "node")
    shared = F.filter(
        F.sequence(F.lit(1), F.least(F.length("least"), F.length("most"))),
        lambda i: F.substring("least", F.lit(1), i) == F.substring("most", F.lit(1), i),
    )
    child = F.substring("least", F.lit(1), F.array_max(shared))
    edges = down.select("node", "first", child.alias("child")).join(nodes.withColumnRenamed("node", "child"), "child")
    label = _after("child", F.length("node"))
    return materialize(edges.select("node", "first", label.alias("label"), "child", "ends", "nexts"), "trie-edges")


def _alive() -> Column:
    """Whether a state at its new node can still end: at the end of its word at a word, else with an edge for the next letter."""
    over = F.col("at") == F.length("word")
    return F.when(over, F.col("ends")).otherwise(F.instr("nexts", _after("word", "at", F.lit(1))) > 0)


def _half(word: str = "word") -> Column:
    """Where edits begin: the way to the middle of a word, after its mark, is walked letter by letter."""
    return 1 + ((F.length(word) - 1) / 2).cast("int")


def _steps(tried: DataFrame) -> DataFrame:
    """``word, at, node, edits, ends`` after one edge, of states joined with the edges that they may follow."""
    size, rest = F.length("label"), _after("word", "at")
    same = F.startswith(rest, F.col("label"))
    begin, longer, early = _after("word", "at", size), _after("word", "at", size + 1), _half() - F.col("at")
    free = ~same & (F.col("edits") == 0) & (F.substring("label", F.lit(1), early) == _after("word", "at", early))
    replaced = free & (F.col("label") > begin) & (F.length(begin) == size) & (F.levenshtein("label", begin, 1) == 1)
    # a letter that may be dropped after the edge is not dropped on it: each pair is found once
    dropped = free & (F.length(longer) == size + 1) & (F.levenshtein("label", longer, 1) == 1)
    step = lambda hit, moved, edits: F.when(hit, F.struct(moved.cast("int").alias("moved"), edits.alias("edits")))
    ways = F.array(step(same, size, F.col("edits")), step(replaced, size, F.lit(1)), step(dropped, size + 1, F.lit(1)))
    moved = tried.select("word", "at", "child", "ends", "nexts", F.explode(ways).alias("way")).filter("way IS NOT NULL")
    moved = moved.select("word", (F.col("at") + F.col("way.moved")).alias("at"), F.col("child").alias("node"), F.col("way.edits").alias("edits"), "ends", "nexts")
    # an exact state may also drop the last letter of its word here, so it lives on at a word with one letter left
    last = (F.col("edits") == 0) & F.col("ends") & (F.length("word") == F.col("at") + 1)
    return moved.filter(_alive() | last).drop("nexts")


def _short_pairs(words: DataFrame) -> DataFrame:
    """``a, b`` of neighbours by the frontier, in one direction each.

    Of two words one edit apart, the first halves are equal or the last ones are. So words go into the trie forwards (marked ``>``) and
    backwards (``<``), and edits are only spent behind the middle, where a node has few edges.
    """
    both = words.select(F.concat(F.lit(">"), "word").alias("word")).unionByName(words.select(F.concat(F.lit("<"), F.reverse("word")).alias("word")))
    every = edges = trie(both)
    found = []
    states = both.select("word", F.lit(0).alias("at"), F.substring("word", 1, 0).alias("node"), F.lit(0).alias("edits"))
    hot = edges.filter("node = ''").select("node").distinct()  # every word starts at the root
    while True:
        told = F.broadcast(edges.join(F.broadcast(hot), "node", "left_semi"))
        apart = states.join(F.broadcast(hot), "node", "left_anti")
        fans = (F.col("edits") == 0) & (F.col("at") >= _half())
        tried = None
        for some, of in ((states, told), (apart, edges)):
            one = some.filter(~fans).withColumn("first", _after("word", "at", F.lit(1))).join(of, ["node", "first"]).drop("first")
            part = one.unionByName(some.filter(fans).join(of.drop("first"), "node"))
            tried = part if tried is None else tried.unionByName(part)
        reached = materialize(_steps(tried), "frontier")
        left = F.length("word") - F.col("at")
        found.append(reached.filter(F.col("ends") & (left + F.col("edits") == 1)).select(F.col("word").alias("a"), F.col("node").alias("b")))
        states = reached.filter(left > 0).select("word", "at", "node", "edits")
        counted = materialize(states.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "frontier-nodes")
        total, low, high = counted.agg(F.sum("n"), F.min(F.length("node")), F.max(F.length("node"))).first()
        if not total:
            break
        edges = every.filter(F.length("node").between(low, high))
        hot = counted.filter(F.col("n") > total * HOT_SHARE).select("node")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    plain = lambda c: _after(c, F.lit(1))
    forth = pairs.filter(F.startswith("a", F.lit(">"))).select(plain("a").alias("a"), plain("b").alias("b"))
    back = pairs.filter(F.startswith("a", F.lit("<"))).select(F.reverse(plain("a")).alias("a"), F.reverse(plain("b")).alias("b"))
    half = (F.length("a") / 2).cast("int")
    return forth.unionByName(back.filter(F.substring("a", F.lit(1), half) != F.substring("b", F.lit(1), half)))


def _long_pairs(words: DataFrame) -> DataFrame:
    """``a, b`` of neighbours among words of ``LONG`` letters or more, in one direction each.

    Neighbours of equal length are equal without the letter of one place; of two lengths, the shorter one equals the longer one
    without a letter. Both are met by hash, one row a letter without the word itself, and checked letter by letter.
    """

    def work(got, n):
        if not n:
            return None
        own, place, hashed = [], [], []
        for name, word in zip(got["id"], got["word"], strict=True):
            sums = prefix_hash(np.frombuffer(word.decode().encode("latin-1"), np.uint8))
            # moving what follows the missing letter one place up is a product with the inverse of the base
            rest = (sums[-1] - sums[1:]) * _INVERSE
            hashed.append(signed(mix(np.append(sums[:-1] + rest, sums[-1]))))
            place.append(np.append(np.arange(1, len(sums)), 0))
            own.append(np.full(len(sums), name))
        return [pa.array(np.concatenate(c)) for c in (own, place, hashed)]

    named = words.select("word", F.xxhash64("word").alias("id"))
    cut = materialize(scan(named, work, "id long, place long, hashed long", ["id", "word"]), "long-words")
    less = cut.filter("place > 0").withColumnRenamed("id", "x")
    other = cut.withColumnRenamed("id", "y")
    same = less.join(other, ["hashed", "place"]).filter("x < y").select("x", "y", "place")
    one_less = less.join(other.filter("place = 0").drop("place"), "hashed").select("x", "y", "place")
    pairs = same.unionByName(one_less).groupBy("x", "y").agg(F.min("place").alias("place"))
    pairs = materialize(pairs, "long-pairs")
    of = lambda letter, word: named.select(F.col("id").alias(letter), F.col("word").alias(word))
    both = pairs.join(of("x", "a"), "x").join(of("y", "b"), "y")
    without = lambda w: F.concat(F.substring(w, F.lit(1), F.col("place").cast("int") - 1), F.substring(w, F.col("place").cast("int") + 1, F.length(w)))
    right = F.when(F.length("a") == F.length("b"), without("b")).otherwise(F.col("b"))
    return both.filter((F.col("a") != F.col("b")) & (without("a") == right)).select("a", "b")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, other``: all ordered pairs of distinct words that differ by one inserted, deleted or replaced letter."""
    pairs = _short_pairs(words.filter(F.length("word") < LONG).select("word"))
    long = words.filter(F.length("word") >= LONG - 1).select("word")
    if long.filter(F.length("word") >= LONG).take(1):
        both_short = (F.length("a") < LONG) & (F.length("b") < LONG)
        pairs = pairs.unionByName(_long_pairs(long).filter(~both_short))
    pairs = materialize(pairs, "spelling-pairs")  # the frontiers behind it are read once
    return pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of rows ``word, form``, where a form has no row of its own if the way ends there.

    Each round doubles the steps taken; a form has twice its word's count or more, so ways are short and never closed.
    """
    done, going = [], materialize(forms.select("word", F.col("form").alias("root")), "forms")
    ahead = going
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(going.join(further, "root", "left").select("word", "root", "next"), "roots")
        done.append(moved.filter("next IS NULL").select("word", "root"))
        going = moved.filter("next IS NOT NULL").select("word", F.col("next").alias("root"))
        ahead = materialize(ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots-ahead")
        if not going.take(1):
            break
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every


def spelling_groups(
    docs: DataFrame, least_letters: int = 5, least_times: int = 3, drop_one_in: int | None = 97, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Words, their neighbours one edit away, and the commoner word that each is probably a spelling of.

    A word's form is its neighbour seen most often (of equal ones the first by code points) if that is seen twice as
    often as the word or more; its root is where the way over forms ends.

    Returns one row per distinct word of ``least_letters`` letters and ``least_times`` occurrences: ``word, form, root, n,
    n_near, form_n``. NULL and empty texts have no words, a NULL key counts as the empty text; every row counts, repeated
    rows each; an empty table gives none; words of any length are compared; other columns are not read.
    """
    rows = pick(docs, **{key: "doc_id", text: "text"})
    counted = words_of(rows, drop_one_in).filter((F.length("word") >= least_letters) & (F.col("times") >= least_times))
    words = materialize(counted, "words")
    near = neighbours(words).join(words.select(F.col("word").alias("other"), F.col("times").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), "other"))
    near = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.n")
    is_form = form_n >= 2 * F.col("times")
    told = words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.other")).alias("form"), F.col("times").alias("n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, form_n).alias("form_n"),
    )
    told = materialize(told, "word-forms")
    ends = roots(told.filter("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
