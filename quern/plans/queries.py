"""The reference capabilities as queries over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import education as E
from quern.functions import heuristics as H
from quern.functions import text as T
from quern.operators import corpus as C
from quern.operators import decontamination as D
from quern.operators import ordered as O
from quern.operators import packing as P
from quern.plans.registry import register, table
from quern.sources import readers as R
from quern.sources import writers as S

_W = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
_CW = r"regexp_extract_all(text, '[\p{L}\p{N}_]+')"
_WC = r"len(regexp_extract_all(text, '\S+'))"


def _grams(n: int, w: str = "w") -> str:
    return f"CASE WHEN len({w}) >= {n} THEN list_transform(range(1, len({w}) - {n - 2}), lambda i: array_to_string({w}[i:i + {n - 1}], ' ')) ELSE [] END"


_WORDS = f"WITH w AS (SELECT *, {_W} AS w FROM documents), b AS (SELECT *, {_W} AS w FROM benchmark)"
_GRAMS = f"{_WORDS}, g AS (SELECT doc_id, unnest(list_distinct({_grams(13)})) AS gram FROM w), idx AS (SELECT gram, min(item_id) AS owner FROM (SELECT item_id, unnest(list_distinct({_grams(13)})) AS gram FROM b WHERE trim(text) <> '') GROUP BY gram), hit AS (SELECT g.doc_id, g.gram FROM g JOIN idx USING (gram))"
_STATUS = f"{_GRAMS}, st AS (SELECT doc_id, lang, text, CASE WHEN length(text) < 200 THEN 'too_short' WHEN length(text) > 100000 THEN 'too_long' WHEN doc_id IN (SELECT doc_id FROM hit) THEN 'contaminated' ELSE 'clean' END AS status, {_WC} AS words FROM documents)"


def text() -> Column:
    return F.col("text")


def docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents")


def index(s: SparkSession, d: str) -> DataFrame:
    return D.benchmark_index(table(s, d, "benchmark"), text(), F.col("item_id"))


def clean_docs(s: SparkSession, d: str) -> DataFrame:
    """Documents that pass the length gate and the index; texts are normalised first."""
    return D.with_status(docs(s, d).withColumn("text", T.normalize(text())), index(s, d), "doc_id", text()).where("status = 'clean'").drop("status")


stored = S.stored


# Sources


@register("src1_language_stream", "SELECT doc_id, text, '' AS url, lang = 'en' AS english FROM documents WHERE lang IN ('en', 'fr')")
def src1(s, d):
    part = lambda lang: R.documents(docs(s, d).where(F.col("lang") == lang)).select("doc_id", "text", "url", F.lit(lang == "en").alias("english"))
    return part("en").unionByName(part("fr"))


@register("src2_shard_scan", "SELECT doc_id, text, 'docs_' || lpad(CAST(doc_id // 100 AS VARCHAR), 5, '0') AS shard FROM documents WHERE doc_id // 100 NOT IN (1, 4)")
def src2(s, d):
    path = S.scratch(s, "shards")
    S.write_shards(docs(s, d).select("doc_id", "text", F.format_string("docs_%05d", F.floor(F.col("doc_id") / 100)).alias("shard")), path)
    return R.shards(s, path, ["doc_id", "text"], done=s.createDataFrame([("docs_00001",), ("docs_00004",), (None,)], "shard string"))


@register("src3_partition_scan", "SELECT doc_id, lang, doc_id % 12 AS topic, row_number() OVER (ORDER BY CAST(doc_id % 12 AS VARCHAR), doc_id) AS place FROM documents WHERE lang = 'en'")
def src3(s, d):
    path = S.scratch(s, "hive")
    S.write_hive(docs(s, d).select("doc_id", "lang", (F.col("doc_id") % 12).alias("topic")), path)
    rows = R.hive_partitions(s, path, "en", ["doc_id"])
    seat = F.array_position(F.array(*[F.lit(x) for x in sorted(map(str, range(12)))]), F.col("topic_order"))
    return O.dense_ids(rows.withColumn("k", seat * F.lit(1 << 40) + F.col("doc_id")), "k", "place").select("doc_id", "lang", "topic", (F.col("place") + 1).alias("place"))


@register("src4_json_lines", "SELECT doc_id, text FROM documents")
def src4(s, d):
    lines = docs(s, d).select(F.to_json(F.struct("doc_id", "text")).alias("value")).unionByName(s.createDataFrame([("",), ("{broken",), ("   ",)], "value string"))
    return R.json_lines(lines, "doc_id BIGINT, text STRING")


@register("src5_annotation_lines", "SELECT accepted, count(*) AS n FROM (SELECT true AS accepted FROM documents UNION ALL SELECT false FROM range(2)) GROUP BY accepted")
def src5(s, d):
    lines = docs(s, d).select(F.to_json(F.struct("doc_id", "lang", C.rule_annotation(text()).alias("annotation"))).alias("value")).unionByName(s.createDataFrame([('{"doc_id": 1}',), ("{broken",), ("",)], "value string"))
    return R.annotation_lines(lines, f"doc_id BIGINT, lang STRING, annotation {C.ANNOTATION}").groupBy("accepted").agg(F.count(F.lit(1)).alias("n"))


@register("src6_tsv", "SELECT DISTINCT full_text FROM (SELECT replace(text, chr(10), ' ') AS full_text FROM documents) WHERE full_text <> ''")
def src6(s, d):
    flat = T.flatten_lines(text())
    lines = docs(s, d).select(F.concat_ws("\t", F.col("doc_id").cast("string"), F.lit("w"), flat).alias("value")).unionByName(s.createDataFrame([("7\tw",)], "value string"))
    return R.tsv(lines, ["item", "word", "full_text"], "full_text")


@register("src7_benchmark_columns", "SELECT 'default' AS bench, text FROM benchmark WHERE trim(text) <> '' UNION ALL SELECT 'pairs', unnest([p_name, p_brand]) FROM part UNION ALL SELECT 'any', unnest([r_name]) FROM region WHERE length(r_name) > 5")
def src7(s, d):
    return R.benchmark_texts(table(s, d, "benchmark"), ["text"], "default").unionByName(R.benchmark_texts(table(s, d, "part"), ["p_name", "p_brand"], "pairs")).unionByName(R.benchmark_texts(table(s, d, "region"), ["r_name"], "any", longer=5))


@register("src7_modes", "SELECT 'flores' AS bench, unnest([p_name, p_type]) AS text FROM part UNION ALL SELECT 'all/region', r_name FROM region UNION ALL SELECT 'all/nation', n_name FROM nation UNION ALL SELECT 'langs/en', text FROM documents WHERE lang = 'en' UNION ALL SELECT 'langs/fr', text FROM documents WHERE lang = 'fr' UNION ALL SELECT 'split', text FROM documents WHERE lang IN ('de', 'es') UNION ALL SELECT 'any/benchmark', text FROM benchmark UNION ALL SELECT 'any/region', r_name FROM region UNION ALL SELECT 'any/customer', c_mktsegment FROM customer WHERE length(c_mktsegment) > 5")
def src7_modes(s, d):
    part, region, nation = (table(s, d, x) for x in ("part", "region", "nation"))
    rows = docs(s, d).select("lang", "text")
    out = R.benchmark({"devtest": part.select(F.col("p_name").alias("eng"), F.col("p_type").alias("fra"), "p_partkey")}, "flores", "flores", langs=["eng", "fra", "deu"])
    out = out.unionByName(R.benchmark({"region": region.withColumnRenamed("r_name", "name"), "nation": nation.withColumnRenamed("n_name", "name")}, "all_configs", "all", ["name"]))
    out = out.unionByName(R.benchmark({x: rows.where(F.col("lang") == x) for x in ("en", "fr", "es")}, "per_lang", "langs", ["text"], ["en", "fr", "xx"]))
    out = out.unionByName(R.benchmark({"all": rows}, "split_per_lang", "split", ["text"], ["de", "es"]))
    return out.unionByName(R.benchmark({"benchmark": table(s, d, "benchmark"), "region": region, "customer": table(s, d, "customer").select("c_custkey", "c_mktsegment")}, "any_text", "any"))


@register("src8_treebanks", "SELECT source, count(*) AS n FROM documents WHERE trim(text) <> '' GROUP BY source")
def src8(s, d):
    return R.nonblank(docs(s, d), "text").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("src9_whole_files", f"WITH f AS (SELECT item_id % 4 AS file, string_agg(text, chr(10) ORDER BY item_id) AS text FROM benchmark GROUP BY 1), b AS (SELECT file, {_W} AS w FROM f) SELECT DISTINCT unnest({_grams(13)}) AS gram FROM b")
def src9(s, d):
    files = R.whole_files(table(s, d, "benchmark"), F.col("item_id") % 4, "item_id", "text")
    return D.grams_of(files, "file", text()).select("gram").distinct()


@register("src10_word_files", "SELECT doc_id, i - 1 AS line_no, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)")
def src10(s, d):
    return R.lines_of(docs(s, d), "doc_id", "text").withColumn("line_no", F.col("line_no").cast("long"))


@register("src11_gram_lines", f"{_WORDS} SELECT gram, CAST(item_id AS VARCHAR) AS document_id FROM (SELECT item_id, unnest({_grams(5)}) AS gram FROM b)")
def src11(s, d):
    lines = table(s, d, "benchmark").select(F.explode(T.ngrams(T.words(text()), 5)).alias("g"), "item_id").select(F.concat_ws(" ", "g", F.col("item_id").cast("string")).alias("value"))
    return R.gram_lines(lines)


@register("src12_remote_scan", "SELECT doc_id, text, '' AS url FROM documents WHERE text <> ''")
def src12(s, d):
    return R.documents(R.shards(s, f"file://{d}/documents.parquet", ["doc_id", "text"])).where("text <> ''").select("doc_id", "text", "url")


@register("src13_bilingual_stream", "SELECT doc_id, lang, CASE lang WHEN 'fr' THEN 0 ELSE 1 END AS part FROM documents WHERE lang IN ('fr', 'en')")
def src13(s, d):
    rows = docs(s, d).select("doc_id", "lang")
    return O.one_after_another([rows.where("lang = 'fr'"), rows.where("lang = 'en'")], "doc_id")


@register("src14_interleave", "SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS turn, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS seat FROM documents")
def src14(s, d):
    seat = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "de", 2).otherwise(3)
    return O.interleave(docs(s, d).select("doc_id", "lang"), "doc_id", "lang", seat)


# Sinks


_IDS = f"{_STATUS}, c AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS dense_id FROM st WHERE status = 'clean'), sh AS (SELECT *, 'all_clean_' || lpad(CAST(dense_id // 100 AS VARCHAR), 5, '0') || '.parquet' AS shard FROM c)"


def _sharded(s, d):
    return S.sharded(stored(clean_docs(s, d).select("doc_id", "lang", T.word_count(text()).alias("words")), "clean"), "doc_id", F.lit("all"), per_shard=100)


@register("snk1_shards", f"{_IDS} SELECT doc_id, dense_id, shard, CAST(words AS INT) AS words FROM sh")
def snk1(s, d):
    return _sharded(s, d).select("doc_id", "dense_id", "shard", "words")


@register("snk1_shard_files", f"{_IDS} SELECT doc_id, dense_id, text, CAST(words AS INT) AS word_count, shard FROM sh")
def snk1_files(s, d):
    rows = stored(clean_docs(s, d).select("doc_id", "text", T.word_count(text()).alias("word_count")), "clean")
    S.write_shards(S.sharded(rows, "doc_id", F.lit("all"), per_shard=100), path := S.scratch(s, "shards"))
    return s.read.parquet(path).select("doc_id", "dense_id", "text", "word_count", F.col("shard").cast("string").alias("shard"))


@register("snk2_manifest", f"{_IDS} SELECT shard, min(dense_id) AS first_doc_id, max(dense_id) AS last_doc_id FROM sh GROUP BY shard")
def snk2(s, d):
    return S.manifest(_sharded(s, d))


@register("snk10_held_out_shards", "SELECT doc_id, held_id, 'held_out_' || lpad(CAST(held_id // 30 AS VARCHAR), 5, '0') AS shard, text FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 - 100 AS held_id FROM documents) WHERE held_id >= 0 AND held_id < 80")
def snk10(s, d):
    held = O.skip_then_take(docs(s, d).select("doc_id", "text"), "doc_id", 100, 80)
    S.write_shards(held.withColumn("shard", F.format_string("held_out_%05d", F.floor(F.col("held_id") / 30))), path := S.scratch(s, "held-out"))
    return s.read.parquet(path).select("doc_id", "held_id", F.col("shard").cast("string").alias("shard"), "text")


@register("snk5_index_manifest", "SELECT lang, doc_id % 10 AS topic, count(*) AS n_docs FROM documents GROUP BY 1, 2")
def snk5(s, d):
    return S.index_manifest(docs(s, d).withColumn("topic", F.col("doc_id") % 10), ["lang", "topic"])


@register("snk7_truncate", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 150")
def snk7(s, d):
    return S.truncated(docs(s, d).select("doc_id"), "doc_id", 150)


# Text


@register("txt1_normalize", "SELECT doc_id, text FROM documents")
def txt1(s, d):
    return docs(s, d).select("doc_id", T.normalize(text()).alias("text"))


@register("txt2_clean", "SELECT doc_id, text FROM documents")
def txt2(s, d):
    return docs(s, d).select("doc_id", T.clean(text()).alias("text"))


@register("txt3_length_gate", "SELECT doc_id, CASE WHEN length(text) < 200 THEN 'too_short' WHEN length(text) > 100000 THEN 'too_long' ELSE 'ok' END AS status FROM documents")
def txt3(s, d):
    return docs(s, d).select("doc_id", T.length_status(text()).alias("status"))


@register("txt4_words", f"SELECT doc_id, array_to_string({_W}, ' ') AS words FROM documents")
def txt4(s, d):
    return docs(s, d).select("doc_id", F.array_join(T.words(text()), " ").alias("words"))


@register("txt5_ngram_sets", f"{_WORDS} SELECT doc_id, len(list_distinct({_grams(13)})) AS grams FROM w")
def txt5(s, d):
    return docs(s, d).select("doc_id", F.size(T.ngram_set(T.words(text()), 13)).cast("long").alias("grams"))


@register("txt6_word_count", f"SELECT doc_id, {_WC} AS words FROM documents")
def txt6(s, d):
    return docs(s, d).select("doc_id", T.word_count(text()).cast("long").alias("words"))


@register("txt7_flatten_lines", "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents")
def txt7(s, d):
    return docs(s, d).select("doc_id", T.flatten_lines(text()).alias("text"))


_MASK = r"regexp_replace(regexp_replace(regexp_replace(text, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+', '[EMAIL]', 'g'), '\b(\+?\d[\d\s\-().]{7,}\d)\b', '[PHONE]', 'g'), '\b\d{3}-\d{2}-\d{4}\b', '[SSN]', 'g')"


@register("txt8_mask_personal", f"SELECT doc_id, {_MASK} AS text FROM documents")
def txt8(s, d):
    return docs(s, d).select("doc_id", T.mask_personal(text()).alias("text"))


@register("txt9_hashes", "SELECT doc_id, sha256(text) AS sha, md5(left(text, 200)) AS id FROM documents")
def txt9(s, d):
    return docs(s, d).select("doc_id", T.content_hash(text()).alias("sha"), T.fallback_id(text()).alias("id"))


@register("txt10_truncations", "SELECT doc_id, left(text, 512) AS embed, left(text, 2000) AS prompt, left(text, 150) AS calibration FROM documents")
def txt10(s, d):
    return docs(s, d).select("doc_id", *[F.substring("text", 1, n).alias(k) for k, n in (("embed", 512), ("prompt", 2000), ("calibration", 150))])


_SNIPPET = "CASE WHEN instr(lower(text), word) > 0 THEN substring(text, greatest(instr(lower(text), word) - 200, 1), instr(lower(text), word) - greatest(instr(lower(text), word) - 200, 1) + 200) ELSE left(text, 400) END"


@register("txt11_snippet", f"{_GRAMS}, f AS (SELECT doc_id, string_split(min(gram), ' ')[1] AS word FROM hit GROUP BY doc_id) SELECT doc_id, {_SNIPPET} AS context FROM documents JOIN f USING (doc_id)")
def txt11(s, d):
    first = D.overlaps(docs(s, d), index(s, d), "doc_id", text()).groupBy("doc_id").agg(F.min("gram").alias("g"))
    return docs(s, d).join(first, "doc_id").select("doc_id", T.snippet(text(), F.split("g", " ")[0]).alias("context"))


@register("txt12_fenced_json", "SELECT doc_id, lang FROM documents")
def txt12(s, d):
    reply = F.concat(F.lit("Here:\n```json\n"), F.to_json(F.struct("lang")), F.lit("\n```\nDone."))
    return docs(s, d).select("doc_id", F.from_json(T.fenced_json(reply), "lang STRING")["lang"].alias("lang"))


@register("txt13_dataset_names", "SELECT DISTINCT 'corpus-' || array_to_string(list_sort([a.lang, b.lang]), '-') AS name FROM documents a, (SELECT DISTINCT lang FROM documents) b WHERE a.lang <> b.lang")
def txt13(s, d):
    langs = docs(s, d).select("lang").distinct()
    other = langs.select(F.col("lang").alias("other"))
    return langs.crossJoin(other).where("lang <> other").select(T.dataset_name("corpus-", F.array("lang", "other")).alias("name")).distinct()


# Decontamination


@register("dec1_benchmark_index", f"{_GRAMS} SELECT gram FROM idx")
def dec1(s, d):
    return index(s, d).select("gram")


@register("dec2_added_by_benchmark", f"{_GRAMS} SELECT owner, count(*) AS added FROM idx GROUP BY owner")
def dec2(s, d):
    return D.added_by_benchmark(index(s, d))


@register("dec3_contaminated_docs", f"{_GRAMS} SELECT DISTINCT doc_id FROM hit")
def dec3(s, d):
    return D.contaminated_ids(docs(s, d), index(s, d), "doc_id", text())


@register("dec4_overlap_listing", f"{_GRAMS} SELECT doc_id, count(*) AS n_overlaps, string_agg(gram, '|' ORDER BY gram) AS grams FROM hit GROUP BY doc_id")
def dec4(s, d):
    return D.overlap_listing(docs(s, d), index(s, d), "doc_id", text())


@register("dec5_status", f"{_STATUS} SELECT doc_id, status FROM st")
def dec5(s, d):
    return D.with_status(docs(s, d).withColumn("text", T.normalize(text())), index(s, d), "doc_id", text()).select("doc_id", "status")


_COUNTS = f"{_STATUS} SELECT lang, count(*) AS streamed, sum((status = 'too_short')::INT)::BIGINT AS too_short, sum((status = 'too_long')::INT)::BIGINT AS too_long, sum((status = 'contaminated')::INT)::BIGINT AS contaminated, sum((status = 'clean')::INT)::BIGINT AS clean, sum(CASE WHEN status = 'clean' THEN words ELSE 0 END)::BIGINT AS clean_words, sum((status = 'contaminated')::INT) / greatest(1, sum((status IN ('contaminated', 'clean'))::INT)) AS contamination_rate FROM st GROUP BY lang"


@register("dec6_status_counts", _COUNTS)
def dec6(s, d):
    return D.status_counts(D.with_status(docs(s, d).withColumn("text", T.normalize(text())), index(s, d), "doc_id", text()), "lang", T.word_count(text()))


_SCAN = f"{_WORDS}, g AS (SELECT doc_id, unnest(list_distinct({_grams(13)})) AS gram FROM w), q AS (SELECT item_id, unnest(list_distinct({_grams(13)})) AS gram FROM b), h AS (SELECT item_id, doc_id, count(*) AS n_overlaps, min(gram) AS first_gram FROM g JOIN q USING (gram) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY doc_id) AS k, string_split(first_gram, ' ')[1] AS word FROM h)"


@register("dec7_corpus_scan", f"{_SCAN} SELECT item_id, doc_id, n_overlaps, first_gram, {_SNIPPET} AS context FROM r JOIN documents USING (doc_id) WHERE k <= 10")
def dec7(s, d):
    return D.scan_corpus(docs(s, d), table(s, d, "benchmark"), "doc_id", text(), "item_id", text())


@register("dec8_remote_scan", f"{_SCAN} SELECT item_id, doc_id, n_overlaps FROM r WHERE k <= 5")
def dec8(s, d):
    return D.scan_corpus(R.shards(s, f"file://{d}/documents.parquet", ["doc_id", "text"]), table(s, d, "benchmark"), "doc_id", text(), "item_id", text(), most=5).select("item_id", "doc_id", "n_overlaps")


@register("dec9_batch", f"{_SCAN} SELECT item_id, left(any_value(text), 200) AS shown, count(doc_id) AS matches FROM benchmark LEFT JOIN (SELECT item_id, doc_id FROM r WHERE k <= 10) x USING (item_id) GROUP BY item_id")
def dec9(s, d):
    bench = table(s, d, "benchmark")
    hits = D.scan_corpus(docs(s, d), bench, "doc_id", text(), "item_id", text()).groupBy("item_id").agg(F.count(F.lit(1)).alias("matches"))
    return bench.select("item_id", F.substring("text", 1, 200).alias("shown")).join(hits, "item_id", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))


@register("dec10_task_overlap", f"{_WORDS}, q AS (SELECT item_id, 'task' || item_id % 3 AS task, unnest(list_distinct({_grams(13)})) AS gram FROM b) SELECT task, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS doc_ids FROM q WHERE gram IN (SELECT unnest({_grams(13)}) FROM w) GROUP BY task")
def dec10(s, d):
    tasks = table(s, d, "benchmark").withColumn("task", F.concat(F.lit("task"), (F.col("item_id") % 3).cast("string")))
    train = D.grams_among(docs(s, d), text(), D.grams_of(tasks, "item_id", text()))
    return D.task_overlap(tasks, train, "task", "item_id", text()).withColumn("doc_ids", F.array_join(F.transform("doc_ids", lambda x: x.cast("string")), ","))


# Budgets, splits, samples


@register("bud1_word_budget", f"{_STATUS}, c AS (SELECT doc_id, words, coalesce(sum(words) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS words_before FROM st WHERE status = 'clean') SELECT doc_id, words_before FROM c WHERE words_before < 100000")
def bud1(s, d):
    return O.word_budget(stored(clean_docs(s, d).select("doc_id", T.word_count(text()).alias("words")), "clean"), "doc_id", F.col("words"), 100_000).select("doc_id", "words_before")


@register("bud2_word_target", "SELECT CAST(floor(28000000000 / 1.3) AS BIGINT) AS target_words")
def bud2(s, d):
    return s.range(1).select(F.floor(F.lit(28e9) / F.lit(1.3)).alias("target_words"))


_IDW = f"{_WORDS}, vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS id FROM (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM w) GROUP BY word)), tok AS (SELECT doc_id, lang, list(id ORDER BY pos) AS ids FROM (SELECT doc_id, lang, unnest(w) AS word, unnest(range(len(w))) AS pos FROM w) JOIN vocab USING (word) GROUP BY doc_id, lang)"
_CHUNKS = f"{_IDW}, ch AS (SELECT doc_id, lang, unnest(range(len(ids) // 64)) AS chunk, ids FROM tok), chunks AS (SELECT doc_id, lang, chunk, ids[chunk * 64 + 1:chunk * 64 + 64] AS input_ids FROM ch)"


def encoded(s, d):
    rows = docs(s, d)
    return P.encode_words(rows, "doc_id", text(), P.word_vocabulary(rows, text()), carry=("lang", "source"))


def joined(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@register("bud3_chunk_quota", f"{_CHUNKS} SELECT doc_id, chunk FROM (SELECT doc_id, chunk, row_number() OVER (ORDER BY doc_id, chunk) AS k FROM chunks) WHERE k <= 50000 // 64")
def bud3(s, d):
    chunks = stored(P.chunks(encoded(s, d), "ids", 64, ["doc_id"]).select("doc_id", "chunk"), "chunks")  # it is read three times
    return P.chunk_quota(chunks, "doc_id", 50_000 // 64).select("doc_id", F.col("chunk").cast("long").alias("chunk"))


@register("bud4_language_split", "SELECT CAST(floor(24000000000 * 0.5) AS BIGINT) // 513 AS first_chunks, (24000000000 - CAST(floor(24000000000 * 0.5) AS BIGINT)) // 513 AS second_chunks")
def bud4(s, d):
    a, b = P.split_tokens(24_000_000_000, 0.5, 513)
    return s.range(1).select(F.lit(a).cast("long").alias("first_chunks"), F.lit(b).cast("long").alias("second_chunks"))


@register("bud5_token_quota", f"{_IDW}, p AS (SELECT doc_id, lang, ids, coalesce(sum(len(ids)) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before, CASE lang WHEN 'en' THEN 50000 ELSE 9001 END AS quota FROM tok WHERE lang IN ('en', 'fr')) SELECT doc_id, lang, least(len(ids), quota - before) AS kept, array_to_string(ids[1:least(len(ids), quota - before)], ',') AS ids FROM p WHERE before < quota")
def bud5(s, d):
    rows = stored(encoded(s, d).select("doc_id", "lang", "ids"), "tokens")  # it is read three times
    return O.token_quota(rows, "doc_id", "lang", "ids", {"en": 50_000, "fr": 9001}).select("doc_id", "lang", F.size("ids").cast("long").alias("kept"), joined("ids").alias("ids"))


_ALLOC = f"WITH c AS (SELECT source, sum({_WC})::BIGINT AS n FROM documents GROUP BY source), t AS (SELECT source, n, (n::HUGEINT * 10007) // sum(n) OVER ()::HUGEINT AS f, (n::HUGEINT * 10007) % sum(n) OVER ()::HUGEINT AS r FROM c), a AS (SELECT source, n, (f + (row_number() OVER (ORDER BY r DESC, source) <= 10007 - sum(f) OVER ())::INT)::BIGINT AS share FROM t)"


def _shares(s, d):
    return O.largest_remainder(docs(s, d).groupBy("source").agg(F.sum(T.word_count(text())).alias("n")), "source", "n", "source", 10_007)


@register("bud6_largest_remainder", f"{_ALLOC} SELECT source, n, share FROM a")
def bud6(s, d):
    return _shares(s, d)


_LINES = r"l AS (SELECT source, doc_id * 1000000 + i AS k, line, regexp_extract_all(line, '\S+') AS ws FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)), p AS (SELECT source, k, line, ws, coalesce(sum(len(ws)) OVER (PARTITION BY source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM l)"


@register("bud7_prefix_lines", f"{_ALLOC}, {_LINES} SELECT source, k, CASE WHEN len(ws) >= share - before THEN array_to_string(ws[1:share - before], ' ') ELSE line END AS line, least(len(ws), share - before) AS written FROM p JOIN a USING (source) WHERE before < share")
def bud7(s, d):
    lines = docs(s, d).select("source", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line")).select("source", (F.col("doc_id") * 1_000_000 + F.col("i")).alias("k"), "line")
    return O.prefix_lines(lines, "source", "k", "line", _shares(s, d)).select("source", "k", "line", F.col("written").cast("long").alias("written"))


@register("bud8_held_out_by_skip", "SELECT doc_id, k - 300 AS held_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents) WHERE k >= 300 AND k < 500")
def bud8(s, d):
    return O.skip_then_take(docs(s, d).select("doc_id"), "doc_id", 300, 200)


@register("bud9_held_out_by_content", "WITH t AS (SELECT DISTINCT sha256(trim(text)) AS h FROM documents WHERE doc_id % 3 = 0), r AS (SELECT doc_id FROM documents WHERE trim(text) <> '' AND sha256(trim(text)) NOT IN (SELECT h FROM t)) SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS held_id FROM r")
def bud9(s, d):
    rows = docs(s, d)
    return O.dense_ids(C.held_out(rows, rows.where("doc_id % 3 = 0"), "text").select("doc_id"), "doc_id", "held_id")


@register("smp1_hash_sample", "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS k FROM documents) WHERE k <= 25")
def smp1(s, d):
    return C.hash_sample(docs(s, d).select("doc_id", "lang"), "doc_id", "lang", 100 // 4)


@register("smp2_calibration", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS k FROM (SELECT doc_id FROM documents WHERE length(text) > 100 ORDER BY doc_id LIMIT 30)) WHERE k <= 10")
def smp2(s, d):
    first = S.truncated(docs(s, d).where(F.length("text") > 100).select("doc_id", F.lit(0).alias("g")), "doc_id", 30)
    return C.hash_sample(first, "doc_id", "g", 10, seed="7").select("doc_id")


@register("smp3_tiered_top", "SELECT doc_id, tier FROM (SELECT doc_id, 'q' || quality AS tier, row_number() OVER (PARTITION BY quality ORDER BY n_chars DESC, doc_id) AS k, quality FROM documents JOIN labels USING (doc_id)) WHERE k <= CASE quality WHEN 1 THEN 60 ELSE 25 END")
def smp3(s, d):
    rows = docs(s, d).join(table(s, d, "labels"), "doc_id").select("doc_id", "n_chars", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("tier"))
    return C.tiered_top(rows, "tier", "n_chars", "doc_id", 100, {"q1": 0.6, "q0": 0.25}).select("doc_id", "tier")


@register("smp4_split", "SELECT doc_id, ('0x' || left(md5('42:' || doc_id), 6))::BIGINT < CAST(floor(0.1 * 16777216) AS BIGINT) AS is_val FROM documents")
def smp4(s, d):
    return C.hash_split(docs(s, d).select("doc_id"), "doc_id")


@register("smp5_first_then_long", "SELECT doc_id FROM (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 300) WHERE length(text) > 200")
def smp5(s, d):
    return C.first_then_long(docs(s, d), "doc_id", "text", 300).select("doc_id")


# Duplicates


@register("dup1_exact_dedup", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)")
def dup1(s, d):
    return C.first_of_each(docs(s, d), T.content_hash(T.clean(text())), "doc_id").select("doc_id")


@register("dup3_distinct_passages", "SELECT DISTINCT text FROM documents")
def dup3(s, d):
    return docs(s, d).select("text").distinct()


@register("dup4_last_annotation", "SELECT source, max_by(lang, doc_id) AS lang, max(doc_id) AS doc_id FROM documents GROUP BY source")
def dup4(s, d):
    return C.last_annotation(docs(s, d).select("source", "lang", "doc_id"), "source", "doc_id")


@register("dup5_language_pairs", "SELECT DISTINCT least(a.lang, b.lang) AS a, greatest(a.lang, b.lang) AS b FROM (SELECT DISTINCT lang FROM documents) a, (SELECT DISTINCT lang FROM documents) b WHERE a.lang <> b.lang")
def dup5(s, d):
    langs = docs(s, d).select("lang").distinct()
    return C.unordered_pairs(langs.select(F.col("lang").alias("a")).crossJoin(langs.select(F.col("lang").alias("b"))), "a", "b")
