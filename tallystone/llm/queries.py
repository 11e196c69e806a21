"""The registered queries: each derives its contract's columns from an operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm import clustering, decontaminate, exact_dedup, html_text, jaccard, language_model, line_dedup
from tallystone.llm import packing, quality, secrets, sharding, spelling, suffix_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf_dir, "documents"), size=4, percent=85).drop("group", "mark")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"),
        F.col("spans_text").alias("spans"), "n_live", "n_example",
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents")).drop("mark")


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents")).drop("kept")


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("measured")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_sharding": op2_sharding,
    "op3_quality": op3_quality,
    "op4_decontamination": op4_decontamination,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_secrets": op6_secrets,
    "op7_html_text": op7_html_text,
    "op8_language_model": op8_language_model,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_suffix_array": op10_suffix_array,
    "op11_spelling": op11_spelling,
    "op12_line_dedup": op12_line_dedup,
    "op13_clustering": op13_clustering,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _clustering_sql(clusters: int = 8, rounds: int = 10) -> str:
    """One pair of subqueries a round: all vectors assigned, all centroids moved."""
    parts = [
        """
        kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        )""",
        f"""
        c0 AS MATERIALIZED (
            SELECT c, v FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM kept) WHERE c < {clusters}
        )""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""
        a{i} AS MATERIALIZED (
            SELECT vec_id, any_value(k.v) AS v, CAST(min(list_sum(list_transform(list_zip(k.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) * {clusters} + c) AS BIGINT) AS best
            FROM kept k CROSS JOIN c{i} GROUP BY vec_id
        )""")
        if i < rounds:
            parts.append(f"""
        c{i + 1} AS MATERIALIZED (
            SELECT c{i}.c, coalesce(any_value(m.v), any_value(c{i}.v)) AS v FROM c{i} LEFT JOIN (
                SELECT c, list((total - ((total % n) + n) % n) // n ORDER BY place) AS v FROM (
                    SELECT best % {clusters} AS c, place, sum(x) AS total, count(*) AS n
                    FROM (SELECT best, unnest(v) AS x, unnest(range(64)) AS place FROM a{i}) GROUP BY ALL
                ) GROUP BY c
            ) m ON m.c = c{i}.c GROUP BY c{i}.c
        )""")
    last = f"""
        SELECT vec_id, CAST(best % {clusters} AS INTEGER) AS cluster, best // {clusters} AS distance,
            CAST(sum(best // {clusters}) OVER (PARTITION BY best % {clusters}) AS BIGINT) AS cluster_inertia,
            CAST(sum(best // {clusters}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c = best % {clusters}
    """
    return "WITH " + ",".join(parts) + last


ORACLES: dict[str, str] = {
    "op4_decontamination": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
        runs AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS run
            FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
        ),
        sizes AS (SELECT DISTINCT n FROM runs),
        places AS (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS run
            FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
        ),
        hits AS (SELECT doc_id, item_id, i, n FROM places JOIN runs USING (n, run)),
        words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
        ),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op5_ngram_jaccard": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
            FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)
        ),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM d
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        )
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
        FROM d JOIN reach r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
    """,
    "op9_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
            doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op11_spelling": rf"""
        WITH RECURSIVE bits AS (
            SELECT b, 0 AS step, CAST(b AS BIGINT) AS c FROM range(256) t(b)
            UNION ALL
            SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8
        ),
        crc AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE step = 8),
        runs AS (
            SELECT doc_id, run, count(*) AS times
            FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
        ),
        spelled AS (SELECT run, times, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS code FROM runs),
        read AS (
            SELECT run, times, list_prepend(4294967295, list_transform(
                range(0, length(code) // 2), lambda i: CAST(16 * (instr('0123456789ABCDEF', code[2 * i + 1]) - 1) + instr('0123456789ABCDEF', code[2 * i + 2]) - 1 AS BIGINT)
            )) AS bytes FROM spelled
        ),
        hashed AS (
            SELECT run, times, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM read, crc
        ),
        told AS (
            SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
            FROM hashed
        ),
        words AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM told WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
        less AS MATERIALIZED (
            SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
        ),
        near AS (
            SELECT a.word, b.word AS other FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
            UNION SELECT word, rest FROM less SEMI JOIN words w ON less.rest = w.word
            UNION SELECT rest, word FROM less SEMI JOIN words w ON less.rest = w.word
        ),
        best AS (
            SELECT near.word, count(*) AS n_near, max(o.n) AS form_n,
                first(other ORDER BY o.n DESC, other) AS form
            FROM near JOIN words o ON o.word = other GROUP BY near.word
        ),
        forms AS MATERIALIZED (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
            FROM words LEFT JOIN best USING (word)
        ),
        way AS (
            SELECT word, word AS root FROM forms
            UNION ALL
            SELECT way.word, forms.form FROM way JOIN forms ON forms.word = way.root WHERE forms.form IS NOT NULL
        ),
        ends AS (SELECT way.word, root FROM way JOIN forms ON forms.word = way.root WHERE forms.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """,
    "op12_line_dedup": """
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split),
        keyed AS MATERIALIZED (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM lines
        ),
        often AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
        told AS (SELECT doc_id, line, place, coalesce(doc_id < last, false) AS gone FROM keyed LEFT JOIN often USING (k))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
        FROM told GROUP BY doc_id
    """,
    "op13_clustering": _clustering_sql(),
}
