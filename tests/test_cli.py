import json

import pytest

from quern import cli, config
from quern.operators import tokenize as K
from quern.operators.corpus import annotated
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_settings_overlay(tmp_path):
    a, b = tmp_path / "a.json", tmp_path / "b.json"
    a.write_text(json.dumps({"chunk": 65, "quotas": {"en": 10, "fr": 5}}))
    b.write_text(json.dumps({"quotas": {"fr": 7}, "languages": ["en", "fr"]}))
    s = config.load([str(a), str(b)], {"gram": 8})
    assert (s.chunk, s.quotas, s.languages, s.gram, s.per_shard) == (65, {"en": 10, "fr": 7}, ("en", "fr"), 8, 50_000)
    with pytest.raises(ValueError):
        config.load([], {"chunks": 1})


def test_stages_run_once(spark, tmp_path):
    c = config.load([], {"documents": f"{SF}/documents.parquet", "benchmark": f"{SF}/benchmark.parquet", "out": f"file://{tmp_path}/out", "chunk": 64, "target_words": 40_000, "per_shard": 20, "held_out_skip": 100, "held_out_docs": 30, "quotas": {"en": 50, "fr": 20}})
    assert cli.run(spark, c, list(cli.STAGES)) == list(cli.STAGES)
    assert cli.run(spark, c, list(cli.STAGES)) == [] and cli.run(spark, c, ["verify"], again=True) == ["verify"]
    report = spark.read.json(f"{c.out}/verify/report").first()
    assert report["wrong"] == report["outside"] == 0 and 0 < report["chunks"] <= 70
    shards = spark.read.parquet(f"{c.out}/decontaminate/shards")
    assert sorted(r["dense_id"] for r in shards.collect()) == list(range(shards.count()))
    assert spark.read.json(f"{c.out}/decontaminate/manifest").count() == -(-shards.count() // 20)
    assert spark.read.parquet(f"{c.out}/hold_out/shards").count() == 30
    with pytest.raises(ValueError):
        cli.run(spark, c, ["indexes"])


def test_finished_tokenizers(tmp_path):
    (tmp_path / "tok-fr-en.json").write_text("{}")
    assert K.finished(str(tmp_path), "tok", ["en", "fr", "en"]).endswith("tok-fr-en.json")
    with pytest.raises(FileNotFoundError):
        K.finished(str(tmp_path), "tok", ["en", "de"])


def test_annotators_that_fail(spark):
    tried = {}

    def reply(question):
        body = question.rsplit("\n", 1)[1]
        tried[body] = tried.get(body, 0) + 1
        if body == "second" and tried[body] == 1:
            raise TimeoutError
        return {"second": '{"topic": {"math": true}}', "broken": "{nonsense", "other": '{"unknown": 1}', "": None}[body]

    df = spark.createDataFrame([(1, "second"), (2, "broken"), (3, "other"), (4, None), (5, "raises")], "i INT, t STRING")
    got = {r["i"]: r["annotation"] for r in annotated(df, F.col("t"), reply).collect()}
    assert got[1]["topic"]["math"] is True and got[2] is got[3] is got[4] is got[5] is None
    assert annotated(df.limit(0), F.col("t"), reply).count() == 0
