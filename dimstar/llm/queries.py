"""The registered queries of the operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstar.llm import (
    byte_bpe,
    exact_dedup,
    html_extract,
    language_crf,
    line_dedup,
    masked_lm,
    merkle,
    mixing,
    ngram_join,
    ready,
    spelling,
    suffix_dedup,
    url_filter,
    vector_graph,
)
from dimstar.llm.url_filter import Rule

URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, folder, "pages"), URL_RULES)


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    parts = mixing.mix(_table(spark, folder, "documents"))
    return parts.select("doc_id", "size", "source_size", "target", "taken", "shards")


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.deduplicated(_table(spark, folder, "documents"))
    sizes = F.transform("removed", lambda s: s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op4_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_graph.near_duplicates(_table(spark, folder, "embeddings"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_crf.identified(_table(spark, folder, "documents"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(_table(spark, folder, "documents"), "source")
    return cleaned.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, folder, "documents"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trips(
        _table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    like = ngram_join.Similarity(width=4, percent=85)
    groups = ngram_join.similar_groups(_table(spark, folder, "documents"), like)
    return groups.select("doc_id", "n_shingles", "component_id")


def op10_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return masked_lm.score_documents(_table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(_table(spark, folder, "documents"), "lang")


def op12_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extracted(_table(spark, folder, "pages"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_source_mix,
        op3_suffix_dedup,
        op4_embedding_near_dedup,
        op5_language_id,
        op6_line_dedup,
        op7_exact_dedup,
        op8_byte_bpe,
        op9_ngram_join,
        op10_lm_score,
        op11_merkle_manifest,
        op12_html_extract,
        op13_spelling_variants,
    )
}

_BARE = r"trim(x, E' \t\r')"

_REACHED = """
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reached(node, root) AS (
  SELECT a, a FROM e UNION SELECT e.b, r.root FROM reached r JOIN e ON r.node = e.a),
least AS (SELECT node, min(root) AS root FROM reached GROUP BY node)"""

ORACLE_SQL = {
    "op4_embedding_near_dedup": f"""
WITH RECURSIVE
v AS (SELECT vec_id, embedding::DOUBLE[] AS x, len(embedding) AS n FROM embeddings),
usable AS (
  SELECT * FROM v WHERE n > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.n = q.n AND p.vec_id < q.vec_id
  WHERE list_cosine_similarity(p.x, q.x) >= {vector_graph.THRESHOLD}),{_REACHED}
SELECT v.vec_id, (SELECT count(*) FROM e WHERE e.a = v.vec_id) AS n_links,
       coalesce(root, v.vec_id) AS component_id, coalesce(root, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN least ON v.vec_id = node""",
    "op9_ngram_join": rf"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
    END) AS held FROM w),
n AS (SELECT doc_id, len(held) AS size FROM s),
u AS (SELECT doc_id, unnest(held) AS g FROM s),
both_ AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM u p JOIN u q ON p.g = q.g
  WHERE p.doc_id < q.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.size + y.size - c)),{_REACHED}
SELECT doc_id, size::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id
FROM n LEFT JOIN least ON doc_id = node""",
    "op6_line_dedup": f"""
WITH pages AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines,
         row_number() OVER () AS page FROM documents),
bare AS (SELECT *, list_transform(lines, lambda x: {_BARE}) AS own FROM pages),
found AS (SELECT DISTINCT page, source, unnest(own) AS line FROM bare),
totals AS (SELECT source, count(*) AS n FROM pages GROUP BY source),
counts AS (
  SELECT f.source, line FROM found f JOIN totals t ON f.source IS NOT DISTINCT FROM t.source
  WHERE line <> '' GROUP BY f.source, line
  HAVING count(*) >= {line_dedup.MIN_PAGES} AND count(*) > {line_dedup.RATIO}::DOUBLE * min(n)),
bad AS (SELECT source, list(line) AS keys FROM counts GROUP BY source),
marked AS (
  SELECT b.*, k.keys,
         len(list_filter(own, lambda x: x <> '' AND NOT list_contains(k.keys, x))) AS n_good
  FROM bare b LEFT JOIN bad k ON b.source IS NOT DISTINCT FROM k.source),
kept AS (
  SELECT doc_id, lines,
         CASE WHEN keys IS NULL OR n_good = 0 THEN lines
              ELSE list_filter(lines, lambda x: NOT list_contains(keys, {_BARE})) END AS rest
  FROM marked)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines,
       coalesce(len(lines) - len(rest), 0)::BIGINT AS n_dropped,
       sha256(array_to_string(rest, chr(10))) AS kept_sha256
FROM kept""",
    "op7_exact_dedup": """
WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)""",
}
