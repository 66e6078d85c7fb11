"""One registered query for each operator, over whole tables, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chunks, codes, decontaminate, embeddings, interpolation, packing, periodic, pii, quality, rules,
    simhash, token_counts, toxicity,
)
from .common import table


def tokenizer_file(name: str) -> str:
    """Where a vocabulary of the public tokenizers is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at a cosine of 0.95 and the groups they make, for every vector."""
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans, and those found from their contexts."""
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram scores of every document, counts from all but each fifth."""
    return interpolation.score(table(spark, sf_dir, "documents"), order=2)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 72 characters and more that occur more than once, all their occurrences."""
    return chunks.repeated_spans(table(spark, sf_dir, "documents"), least_chars=72)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles and their groups at two bits, for every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select(
        F.col("id").alias("doc_id"), simhash.hexadecimal().alias("fingerprint"), "component_id"
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model")
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds at least 0.8 of the five-word shingles of a benchmark item."""
    found = decontaminate.contained(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8
    )
    return found.select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"),
        F.col("common").alias("n_common"), F.col("size").alias("n_shingles"), "containment",
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 tokens."""
    return packing.pack(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), capacity=2048
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by crc32 of its id repeats its own words.

    With h that number, g = floor(h / 10) and n words: from word a = g % n on, the first
    p = 1 + floor((n - a) / (3 + g % 8)) words fill the rest of the text over and over.
    """
    chosen = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    planted = "h % 10 = 0 and text rlike '[^\\\\x20\\\\x09-\\\\x0D]'"
    split = docs.select("doc_id", text.alias("text"), chosen.alias("h")).selectExpr(
        "doc_id", "text", "h div 10 as g",
        f"if({planted}, filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> ''), null) as w",
    )
    placed = split.selectExpr("*", "size(w) as n", "cast(g % size(w) as int) as a").selectExpr(
        "*", "cast(1 + (n - a) div (3 + g % 8) as int) as p"
    )
    rest = "slice(flatten(array_repeat(slice(w, a + 1, p), cast(1 + (n - a) div p as int))), 1, n - a)"
    return placed.selectExpr(
        "doc_id", f"if(w is null, text, array_join(concat(slice(w, 1, a), {rest}), ' ')) as text"
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least 12 words in every document, runs planted in each tenth; see the operator."""
    docs = with_planted_runs(table(spark, sf_dir, "documents"))
    found = periodic.periodic_runs(docs, least_words=12)
    longest = "array_max(transform(runs, r -> struct(r.length as length, -r.start as s, -r.period as q)))"
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.selectExpr(
        "doc_id", "cast(size(runs) as long) as n_runs", f"{longest} as top",
        f"sha2({listed}, 256) as runs_sha256", "sha2(collapsed, 256) as collapsed_sha256",
    ).selectExpr(
        "doc_id", "n_runs", "-top.s as start", "top.length as length", "-top.q as period",
        "1000 * top.length div -top.q as exponent_milli", "runs_sha256", "collapsed_sha256",
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of 8 parts with 16 entries each for every vector, after 6 rounds, and their errors."""
    found, books = codes.encode(
        table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096
    )
    return codes.with_label_errors(found).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(codes.digest(books)).alias("codebooks_sha256"),
    )


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether it passes all rules."""
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", F.array_join("failed", ",").alias("failed"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dup, op2_pii, op3_lm_score, op4_toxicity, op5_substring_dedup, op6_simhash,
        op7_token_counts, op8_decontamination, op9_quality, op10_packing, op11_periodic_runs,
        op12_vector_codes, op13_quality_rules,
    )
}

def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """All rounds of k-means in plain integers, one after the other."""
    nearest = """
        SELECT v.uid, v.part, any_value(v.x) AS x, min(
            (list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT,
             c.entry)) AS best
        FROM v JOIN c{} c ON c.part = v.part GROUP BY v.uid, v.part"""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED ({nearest.format(n)})")
        if n < rounds:
            steps.append(f"""
        s{n} AS (
            SELECT part, entry, pos, sum(y) AS total, count(*) AS n FROM (
                SELECT part, best[2] AS entry, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS y FROM a{n}
            ) GROUP BY ALL
        ), m{n} AS (
            SELECT part, entry, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x
            FROM s{n} GROUP BY part, entry
        ), c{n + 1} AS MATERIALIZED (
            SELECT c.part, c.entry, coalesce(m.x, c.x) AS x
            FROM c{n} c LEFT JOIN m{n} m ON m.part = c.part AND m.entry = c.entry
        )""")
    return f"""
        WITH e AS (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS uid, vec_id, label,
                   list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x
            FROM embeddings
            WHERE len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), v AS MATERIALIZED (
            SELECT uid, p.part, x[p.part * len(x) // {parts} + 1:(p.part + 1) * len(x) // {parts}] AS x
            FROM e, range({parts}) p(part)
        ), c0 AS MATERIALIZED (SELECT part, uid AS entry, x FROM v WHERE uid < {entries}),
        {", ".join(steps)},
        books AS (
            SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
            FROM c{rounds}
        ), coded AS (
            SELECT uid, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code,
                   sum(best[1])::BIGINT AS error
            FROM a{rounds} GROUP BY uid
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               codebooks_sha256
        FROM coded JOIN e USING (uid), books
    """


def _rules_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted({w for t in rules.STOP_WORDS.values() for w in t.split()}))
    tests = {
        "few_words": "n_words < 50", "repeats_itself": "n_repeat_words > 0.5 * n_words",
        "short_words": "word_chars < 2 * n", "long_words": "word_chars > 15 * n",
        "symbols": "n_symbols / n > 0.1", "exclaims": "n_exclamations / n > 0.2",
        "few_letters": "n_letter_words / n < 0.7", "no_stop_words": "n_stop_words < 2",
        "rare_stop_words": "n_stop_words / n < 0.02",
        "repeated_lines": "n_dup_lines / greatest(n_lines, 1) > 0.4",
        "bullets": "n_bullet_lines / greatest(n_lines, 1) > 0.9",
        "cut_lines": "n_open_lines / greatest(n_lines, 1) > 0.3",
    }
    named = ", ".join(f"CASE WHEN {t} THEN '{n}' END" for n, t in tests.items())
    return rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents
        ), parts AS (
            SELECT *, list_filter(string_split_regex(text, '[ 	-
]+'), lambda w: w <> '') AS w,
                string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?',
                                             'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+') AS plain,
                list_filter(string_split(text, chr(10)),
                            lambda l: regexp_matches(l, '[^ 	-
]')) AS lines
            FROM texts
        ), windows AS (
            SELECT uid, i, count(*) OVER (PARTITION BY uid, key) AS n FROM (
                SELECT uid, unnest(range(1, len(w) - 1)) AS i,
                       unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS key
                FROM parts WHERE len(w) > 2
            )
        ), repeats AS (
            SELECT uid, count(DISTINCT j) AS n_repeat_words
            FROM (SELECT uid, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY uid
        ), counts AS (
            SELECT doc_id, len(w) AS n_words, greatest(len(w), 1) AS n,
                length(regexp_replace(text, '[ 	-
]+', '', 'g')) AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
                len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
                len(list_filter(plain, lambda x: x IN ({stop}))) AS n_stop_words,
                len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                len(list_filter(lines, lambda l: regexp_matches(l, '^[ 	]*[-*•]'))) AS n_bullet_lines,
                len(list_filter(lines, lambda l: regexp_matches(l, '(…|\.\.\.)[ 	
]*$'))) AS n_open_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM parts LEFT JOIN repeats USING (uid)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               {tests["few_words"]} OR {tests["repeats_itself"]} AS base_failed,
               NOT ({" OR ".join(tests.values())}) AS kept, concat_ws(',', {named}) AS failed
        FROM counts
    """


#: The other operators hash, learn or pack in ways SQL can't express; tests hold them against
#: brute force, exact round trips or held-out labels.
ORACLE = {
    "op1_embedding_near_dup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        ), ok AS (
            SELECT * FROM v
            WHERE e IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM ok a, ok b
            WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              AND list_cosine_similarity(a.e, b.e) >= 0.95
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), least AS (
            SELECT a, min(b) AS component_id FROM reach GROUP BY a
        ), n AS (
            SELECT a, count(*) AS n_links FROM links GROUP BY a
        )
        SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, least.component_id,
               v.vec_id = least.component_id AS kept
        FROM v JOIN least ON least.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
    """,
    "op8_decontamination": r"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', item_id, text FROM benchmark
        ), words AS (
            SELECT kind, id, list_filter(
                string_split_regex(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x20\x09-\x0D]+'
                ), lambda w: w <> '') AS w
            FROM texts WHERE id IS NOT NULL AND text IS NOT NULL
        ), shingles AS (
            SELECT DISTINCT kind, id, unnest(
                CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END
            ) AS s
            FROM words WHERE len(w) > 0
        ), sizes AS (
            SELECT id, count(*) AS n_shingles FROM shingles WHERE kind = 'i' GROUP BY id
        )
        SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_common, any_value(n_shingles) AS n_shingles,
               count(*) / any_value(n_shingles) AS containment
        FROM shingles d JOIN shingles i ON d.kind = 'd' AND i.kind = 'i' AND d.s = i.s
        JOIN sizes ON sizes.id = i.id
        GROUP BY d.id, i.id
        HAVING count(*) >= 0.8 * any_value(n_shingles)
    """,
    "op12_vector_codes": _codes_sql(),
    "op13_quality_rules": _rules_sql(),
}
