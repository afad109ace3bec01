"""Queries of tokenizing, packing, verification, and the streaming form of the pipeline."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import packing as P
from quern.operators import tokenize as K
from quern.operators import verify as V
from quern.plans.queries import _CHUNKS, _IDW, _STATUS, _grams, docs, encoded, index, joined, text
from quern.plans.registry import register
from quern.sources import writers as S
from quern.streaming import ingest as I

#: A finished tokenizer, as a JSON file.
TOKENIZER = os.environ.get("QUERN_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
LENGTH = 64


def _chunks(s, d, carry=("doc_id",)):
    return P.chunks(encoded(s, d), "ids", LENGTH, list(carry))


@register("tok3_encode")
def tok3(s, d):
    return K.encode(docs(s, d).select("doc_id", "text"), "text", TOKENIZER).select("doc_id", F.size("ids").alias("n_tokens"), joined("ids").alias("ids"))


@register("tok3_encode_words", f"{_IDW} SELECT doc_id, array_to_string(ids, ',') AS ids FROM tok")
def tok3_words(s, d):
    return encoded(s, d).select("doc_id", joined("ids").alias("ids"))


@register("tok4_vocabulary", f"{_IDW} SELECT id, word FROM vocab WHERE id < 100")
def tok4(s, d):
    return K.inspect(P.word_vocabulary(docs(s, d), text()), 100).select(F.col("id").cast("long").alias("id"), "word")


@register("tok4_pieces")
def tok4_pieces(s, d):
    return K.vocabulary(s, TOKENIZER, 1000)


@register("pck1_chunks", f"{_CHUNKS} SELECT doc_id, chunk, array_to_string(input_ids, ',') AS input_ids FROM chunks")
def pck1(s, d):
    return _chunks(s, d).select("doc_id", F.col("chunk").cast("long").alias("chunk"), joined("input_ids").alias("input_ids"))


@register("pck2_curriculum_chunks", f"{_CHUNKS} SELECT doc_id, lang, doc_id % 10 AS topic_id, chunk, array_to_string(input_ids, ',') AS input_ids FROM chunks")
def pck2(s, d):
    rows = encoded(s, d).withColumn("topic_id", F.col("doc_id") % 10)
    return P.chunks(rows, "ids", LENGTH, ["doc_id", "lang", "topic_id"]).select("doc_id", "lang", "topic_id", F.col("chunk").cast("long").alias("chunk"), joined("input_ids").alias("input_ids"))


_ACROSS = f"{_IDW}, fl AS (SELECT id, (row_number() OVER (ORDER BY doc_id, pos) - 1) AS k FROM (SELECT doc_id, unnest(ids) AS id, unnest(range(len(ids))) AS pos FROM tok)), bl AS (SELECT k // {LENGTH} AS block, array_to_string(list(id ORDER BY k), ',') AS input_ids, count(*) AS n FROM fl GROUP BY block HAVING count(*) = {LENGTH})"


@register("pck3_across_documents", f"{_ACROSS} SELECT block, input_ids FROM bl")
def pck3(s, d):
    return P.across_documents(encoded(s, d), "doc_id", "ids", LENGTH).select("block", joined("input_ids").alias("input_ids"))


@register("pck4_whole_shards", f"{_ACROSS} SELECT block, input_ids FROM bl WHERE block < (SELECT count(*) FROM bl) // 1000 * 1000")
def pck4(s, d):
    blocks = P.across_documents(encoded(s, d), "doc_id", "ids", LENGTH)
    return P.whole_shards(S.stored(blocks, "blocks"), 1000).select("block", joined("input_ids").alias("input_ids"))


@register("pck5_stats", f"{_IDW} SELECT count(*) AS docs, sum(len(ids))::BIGINT AS tokens, sum(len(ids) // {LENGTH})::BIGINT AS chunks, sum(len(ids) % {LENGTH})::BIGINT AS discarded FROM tok")
def pck5(s, d):
    return P.chunk_stats(encoded(s, d), "ids", LENGTH)


def _mixture_sql(quotas):
    kept = " ".join(f"WHEN '{k}' THEN {n}" for k, n in quotas.items())
    part = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(quotas))
    names = ", ".join(f"'{k}'" for k in quotas)
    return f"SELECT '{'-'.join(sorted(quotas))}' AS mixture, (CASE lang {part} END)::BIGINT AS part, lang, count(*) AS chunks, {LENGTH} * count(*) AS tokens FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id, chunk) AS k FROM chunks WHERE lang IN ({names})) WHERE k <= CASE lang {kept} END GROUP BY lang"


#: One language, pairs, three, all, and a small pilot: chunks of each, and their order.
MIXTURES = [{"en": 400}, {"en": 300, "fr": 100}, {"de": 100, "en": 300}, {"en": 200, "fr": 100, "es": 100}, {"es": 20, "de": 20, "fr": 20, "en": 20}, {"fr": 5}]


@register("pck6_mixtures", f"{_CHUNKS} " + " UNION ALL ".join(map(_mixture_sql, MIXTURES)))
def pck6(s, d):
    rows = S.stored(P.chunks(encoded(s, d), "ids", LENGTH, ["doc_id", "lang"]), "chunks")
    out = None
    for quotas in MIXTURES:
        one = V.summary(P.mixture(rows, "doc_id", "lang", quotas), LENGTH, ["part", "lang"])
        one = one.select(F.lit("-".join(sorted(quotas))).alias("mixture"), "part", "lang", "chunks", "tokens")
        out = one if out is None else out.unionByName(one)
    return out


@register("snk6_resumed_chunks", f"{_CHUNKS} SELECT 'src_' || doc_id // 100 AS shard, doc_id, chunk, array_to_string(input_ids, ',') AS input_ids FROM chunks")
def snk6(s, d):
    """A first run that wrote some shards only, then one that adds the rest."""
    rows = S.stored(_chunks(s, d).withColumn("shard", F.concat(F.lit("src_"), F.floor(F.col("doc_id") / 100).cast("string"))), "chunks")
    S.write_chunks(rows.where("shard IN ('src_0', 'src_2')"), path := S.scratch(s, "resumed"), "shard")
    return S.write_chunks(rows, path, "shard").select("shard", "doc_id", F.col("chunk").cast("long").alias("chunk"), joined("input_ids").alias("input_ids"))


@register("ver1_chunk_length", f"{_CHUNKS} SELECT count(*) AS chunks, sum((len(input_ids) <> {LENGTH})::INT)::BIGINT AS wrong FROM chunks")
def ver1(s, d):
    return V.wrong_lengths(_chunks(s, d), "input_ids", LENGTH)


@register("ver2_ids_in_vocabulary", f"{_CHUNKS} SELECT sum(len(input_ids))::BIGINT AS tokens, sum(len(list_filter(input_ids, lambda x: x < 0 OR x >= 200)))::BIGINT AS outside FROM chunks")
def ver2(s, d):
    return V.outside_vocabulary(_chunks(s, d), "input_ids", 200)


@register("ver3_recheck", f"{_CHUNKS}, dec AS (SELECT doc_id, chunk, list(word ORDER BY pos) AS w FROM (SELECT doc_id, chunk, unnest(input_ids) AS id, unnest(range({LENGTH})) AS pos FROM chunks) JOIN vocab USING (id) GROUP BY doc_id, chunk), ix AS (SELECT DISTINCT unnest({_grams(13)}) AS gram FROM b), hit AS (SELECT DISTINCT doc_id, chunk FROM (SELECT doc_id, chunk, unnest({_grams(13)}) AS gram FROM dec) JOIN ix USING (gram)) SELECT (SELECT count(*) FROM dec) AS chunks, (SELECT count(*) FROM hit) AS contaminated")
def ver3(s, d):
    decoded = V.decode_words(_chunks(s, d), ["doc_id", "chunk"], "input_ids", P.word_vocabulary(docs(s, d), text()))
    return V.recheck(S.stored(decoded, "decoded"), ["doc_id", "chunk"], index(s, d))


@register("ver4_summary", f"{_CHUNKS} SELECT lang, count(*) AS chunks, {LENGTH} * count(*) AS tokens FROM chunks GROUP BY lang")
def ver4(s, d):
    return V.summary(_chunks(s, d, ("doc_id", "lang")), LENGTH, ["lang"])


@register("e1_streamed_corpus", f"{_STATUS}, c AS (SELECT doc_id, words, row_number() OVER (ORDER BY doc_id) - 1 AS dense_id, coalesce(sum(words) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS words_before FROM st WHERE status = 'clean') SELECT dense_id, doc_id, words, words_before FROM c WHERE words_before < 200000")
def e1_stream(s, d):
    return I.ingest(s, f"{d}/documents.parquet", index(s, d), S.scratch(s, "stream"), 200_000).select("dense_id", "doc_id", "words", "words_before")
