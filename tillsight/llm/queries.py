"""Queries over the whole tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillsight.llm.byte_bpe import bpe_digest
from tillsight.llm.centroids import cluster_digest
from tillsight.llm.license_scan import LEAST_COVERAGE, MOST_SLACK, TEMPLATES, license_digest
from tillsight.llm.line_dedup import line_dedup_digest
from tillsight.llm.ngram_join import linked_components
from tillsight.llm.packing import pack_documents
from tillsight.llm.pii import personal_data_digest
from tillsight.llm.quality import quality_verdicts
from tillsight.llm.shipping import ship
from tillsight.llm.substring_dedup import substring_dedup_digest
from tillsight.llm.toxicity import toxicity_scores
from tillsight.llm.vector_search import nearest
from tillsight.llm.warc import archived_and_read_back
from tillsight.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup_digest(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_digest(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_and_read_back(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_digest(table(spark, sf_dir, "embeddings"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_search": op1_vector_search,
    "op2_ngram_join": op2_ngram_join,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_pii": op7_pii,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_line_dedup": op10_line_dedup,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_license_scan": op13_license_scan,
    "pipeline": pipeline,
}

_WORDS = r"""words AS (
    SELECT doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS words FROM documents
)"""
_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)



def _clustering_sql(rounds: int = 10) -> str:
    """Every distance anew in every round, in long form."""
    parts = ["""
WITH v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64
), p AS MATERIALIZED (
    SELECT vec_id, unnest(x) AS a, generate_subscripts(x, 1) AS d FROM v
), c0 AS MATERIALIZED (
    SELECT k, unnest(x) AS m, generate_subscripts(x, 1) AS d FROM (
        SELECT x, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM v
    ) WHERE k < 8
)"""]
    for step in range(rounds + 1):
        parts.append(f""", a{step} AS MATERIALIZED (
    SELECT vec_id, arg_min(k, (t, k)) AS k, min(t) AS t FROM (
        SELECT vec_id, k, sum((a - m) * (a - m))::BIGINT AS t FROM p JOIN c{step} USING (d) GROUP BY ALL
    ) GROUP BY vec_id
)""")
        if step < rounds:
            parts.append(f""", c{step + 1} AS MATERIALIZED (
    SELECT k, d, coalesce((s - ((s % n) + n) % n) // n, m) AS m FROM c{step} LEFT JOIN (
        SELECT k, d, sum(a)::BIGINT AS s, count(*) AS n FROM p JOIN a{step} USING (vec_id) GROUP BY ALL
    ) USING (k, d)
)""")
    parts.append(f"""
SELECT vec_id, k::INTEGER AS cluster, t AS distance, cluster_inertia::BIGINT AS cluster_inertia,
       (SELECT sum(t) FROM a{rounds})::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT k, sum(t) AS cluster_inertia FROM a{rounds} GROUP BY k) USING (k)
JOIN (SELECT k, sha256(string_agg(m::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k) USING (k)
""")
    return "".join(parts)


def _license_sql() -> str:
    """Grams joined as words; diagonals of one template are merged up to its slack."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    rows = ", ".join(
        f"({number}, {quote(t.label)}, {quote(t.text)}, {t.exact})" for number, t in enumerate(TEMPLATES)
    )
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')".format(word)
    return f"""
WITH t AS (
    SELECT number, label, exact, {words} AS words FROM (VALUES {rows}) AS given(number, label, text, exact)
), tg AS (
    SELECT number, pos, size, list_slice(words, pos + 1, pos + size) AS gram
    FROM (SELECT number, words, least(3, len(words)) AS size, unnest(range(len(words) - least(3, len(words)) + 1)) AS pos FROM t)
), d AS (
    SELECT doc_id, {words} AS words FROM documents
), g AS (
    SELECT doc_id, pos, size, list_slice(words, pos + 1, pos + size) AS gram
    FROM (SELECT doc_id, words, unnest(range(len(words))) AS pos FROM d), (VALUES (2), (3)) AS sizes(size)
), hits AS (
    SELECT doc_id, number, size, tg.pos AS pos, g.pos - tg.pos AS diagonal FROM g JOIN tg USING (size, gram)
), marked AS (
    SELECT hits.*, len(words) AS n, label, exact,
           diagonal - lag(diagonal) OVER (PARTITION BY doc_id, number ORDER BY diagonal, hits.pos)
           > (CASE WHEN exact THEN 0 ELSE least({MOST_SLACK}, ceil(len(words) / 5)) END) AS new
    FROM hits JOIN t USING (number)
), runs AS (
    SELECT *, sum(coalesce(new, false)::INT) OVER (PARTITION BY doc_id, number ORDER BY diagonal, pos) AS run FROM marked
), spans AS (
    SELECT doc_id, label, exact, min(diagonal + pos) AS first,
           len(list_distinct(flatten(list(range(pos, pos + size))))) / any_value(n) AS coverage
    FROM runs GROUP BY doc_id, number, label, exact, run
), judged AS (
    SELECT *, CASE WHEN exact THEN coverage = 1 ELSE coverage >= {LEAST_COVERAGE} END AS verified FROM spans
)
SELECT doc_id, len(words)::BIGINT AS n_words,
       count(*) FILTER (WHERE exact AND verified) AS n_base,
       min(first) FILTER (WHERE exact AND verified) AS first_word,
       max(first) FILTER (WHERE exact AND verified) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact AND verified), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE verified), '') AS labels,
       coalesce(max(coverage) FILTER (WHERE NOT exact OR verified), 0.0)::DOUBLE AS score
FROM d LEFT JOIN judged USING (doc_id) GROUP BY doc_id, words
"""


ORACLE = {
    "op2_ngram_join": f"""
WITH RECURSIVE {_WORDS.format(text=_LOWERED)}, grams AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS gram
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS i FROM words)
    WHERE len(words) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached r LEFT JOIN sizes ON sizes.doc_id = r.doc_id GROUP BY r.doc_id
""",
    "op3_substring_dedup": f"""
WITH {_WORDS.format(text="coalesce(text, '')")}, windows AS (
    SELECT doc_id, i, array_to_string(list_slice(words, i, i + 19), ' ') AS said
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS i FROM words)
), later AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY said ORDER BY doc_id, i) AS nth FROM windows
    ) WHERE nth > 1
), gone AS (
    SELECT DISTINCT doc_id, i + k AS i FROM later, generate_series(0, 19) AS steps(k)
), single AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM words
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words w LEFT JOIN kept ON kept.doc_id = w.doc_id
""",
    "op9_warc": """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), g AS (
    SELECT payload_digest, payload_bytes, max(page_id) AS response FROM d
    WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response > page_id THEN response END AS refers_to
FROM d LEFT JOIN g USING (payload_digest, payload_bytes)
""",
    "op10_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, u.pos AS pos, u.line AS line,
           regexp_replace(u.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
         LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS pos) u
), keyed AS (
    SELECT doc_id, pos, line,
           translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), known AS (
    SELECT key, min(doc_id) AS first_doc FROM keyed
    WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> n.first_doc, false) AS gone
    FROM keyed k LEFT JOIN known n ON k.key = n.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op11_centroid_clustering": _clustering_sql(),
    "op13_license_scan": _license_sql(),
}
