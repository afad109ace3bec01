"""Queries of the training-data operators over the driver's tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import bpe, html_content, jaccard, language, media, packing, passages, quality, store, token_table, warc

Query = Callable[[SparkSession, str], DataFrame]

_WORDS = r"regexp_extract_all(lower(text), '[0-9A-Za-z_\x{80}-\x{10FFFF}]+')"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    store.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bpe.with_tokens(_read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), count_col="n_tokens", kind="library")
    token_table.write_tokens(docs.drop("text"), path := store.new_path(spark, "tokens"))
    return token_table.read_tokens(spark, path)


def op2_jpeg_thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.with_thumbnails(media.rendered(_read(spark, sf_dir, "embeddings")), id_col="vec_id")


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_read(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_classes(_read(spark, sf_dir, "documents"))


OP4_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) ELSE [array_to_string(ws, ' ')] END)) AS g FROM w WHERE len(ws) > 0),
r AS (SELECT doc_id, g, min(doc_id) OVER (PARTITION BY g) AS rep, count(*) OVER (PARTITION BY g) AS copies FROM s),
e AS (SELECT doc_id, len(g) AS size, unnest(g) AS gram FROM r WHERE doc_id = rep),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.size, b.size HAVING count(*) >= 0.5 * (a.size + b.size - count(*))),
c AS (SELECT a, b FROM p UNION SELECT c.a, p.b FROM c JOIN p ON c.b = p.a),
k AS (SELECT a, min(b) AS low FROM c GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT doc_id, least(rep, coalesce(low, rep)) AS class_id, rep, copies, coalesce(n_links, 0) AS n_links
FROM r LEFT JOIN k ON k.a = rep LEFT JOIN n ON n.a = rep WHERE copies > 1 OR n_links > 0
"""


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(bpe.with_tokens(_read(spark, sf_dir, "documents").select("doc_id", "text"), kind="library", binary=True))


def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.with_tokens(_read(spark, sf_dir, "documents").select("doc_id", "text"), count_col="n_tokens")
    return bpe.with_text(encoded).select("doc_id", "n_tokens", "tokens", F.col("decoded").eqNullSafe(F.col("text")).alias("restored"))


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.page_records(_read(spark, sf_dir, "pages"))
    warc.archive(records, path := store.new_path(spark, "warc"), id_col="page_id")
    return warc.restore(spark, path, id_col="page_id").withColumn("record", F.decode("record", "UTF-8"))


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, html, sha256(html) AS digest, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) AS http FROM pages WHERE html IS NOT NULL)
SELECT page_id, digest, true AS verified, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'WARC-Payload-Digest: sha256:' || digest || chr(13) || chr(10) || 'Content-Type: application/http; msgtype=response' || chr(13) || chr(10) || 'Content-Length: ' || (strlen(http) + strlen(html)) || chr(13) || chr(10) || chr(13) || chr(10) || http || html || chr(13) || chr(10) || chr(13) || chr(10) AS record
FROM p
"""


def op8_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return html_content.extract(pages, html_content.train(pages))


def op9_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition_coverage(_read(spark, sf_dir, "documents"))


def _op9_sql() -> str:
    counts = ", ".join(f"coalesce(c{n}.chars, 0) AS dup{n}_chars" for n in quality.LIMITS)
    keep = " AND ".join([f"coalesce(c{n}.chars, 0) <= {limit} * t.chars" for n, limit in quality.LIMITS.items()] + [f"coalesce(l.chars, 0) <= {quality.LINE_LIMIT} * t.chars"])
    joins = " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in quality.LIMITS)
    parts = "".join(
        f"""
g{n} AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, gram ORDER BY i) AS k FROM (SELECT doc_id, unnest(range(1, len(ws) - {n - 2})) AS i, unnest(list_transform(range(1, len(ws) - {n - 2}), lambda j: array_to_string(ws[j:j + {n - 1}], ' '))) AS gram FROM w WHERE len(ws) >= {n})),
c{n} AS (SELECT w.doc_id, sum(length(x.word))::BIGINT AS chars FROM w, (SELECT DISTINCT doc_id, i + unnest(range({n})) AS i FROM g{n} WHERE k > 1) d, (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) x WHERE w.doc_id = d.doc_id AND x.doc_id = d.doc_id AND x.i = d.i GROUP BY w.doc_id),"""
        for n in quality.LIMITS
    )
    return rf"""
WITH w AS (SELECT doc_id, text, {_WORDS} AS ws FROM documents),
t AS (SELECT doc_id, coalesce(sum(length(word)), 0)::BIGINT AS chars FROM (SELECT doc_id, unnest(ws) AS word FROM w UNION ALL SELECT doc_id, '' FROM w) GROUP BY doc_id),{parts}
q AS (SELECT doc_id, array_to_string(ws, ' ') AS line, array_to_string(ws, '') AS joined, row_number() OVER (PARTITION BY doc_id, ws ORDER BY i) AS k FROM (SELECT doc_id, i, {_WORDS.replace("text", "part")} AS ws FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)) WHERE len(ws) > 0),
l AS (SELECT doc_id, sum(length(joined))::BIGINT AS chars FROM q WHERE k > 1 GROUP BY doc_id)
SELECT doc_id, t.chars AS word_chars, {counts}, coalesce(l.chars, 0) AS dup_line_chars, {keep} AS keep
FROM t {joins} LEFT JOIN l USING (doc_id)
"""


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def queries() -> dict[str, Query]:
    ops = (op1_token_parquet, op2_jpeg_thumbnails, op3_repeated_passages, op4_ngram_jaccard_join, op5_best_fit_packing, op6_bpe_encode_decode, op7_warc_archive, op8_html_content, op9_repetition_coverage, op10_language_id)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_jaccard_join": OP4_SQL, "op7_warc_archive": OP7_SQL, "op9_repetition_coverage": _op9_sql()}
