import json

import numpy as np

from sieveline.sources import files


def test_sources(spark, rows, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "c.csv").write_text('a,b\n"1,5",x\n2,"y ""z"""\n')
    assert rows(files.string_csv(spark, str(tmp_path / "c.csv"), ["a", "b"])) == [("1,5", "x"), ("2", 'y "z"')]
    (tmp_path / "v.jsonl").write_text('{"work_id":"1","verdict":"research"}\n{"work_id":"2","verdict":"junk"}\n{"work_id":"1","verdict":"research"}\n')
    assert rows(files.research_ids(spark, str(tmp_path / "v.jsonl"))) == [("1",)]
    (tmp_path / "o.json").write_text(json.dumps({"3": {"status": "normal", "reason": "r", "date": "d", "by": "b"}, "_3": {"status": "old"}}))
    assert {r[0] for r in rows(files.overrides(spark, str(tmp_path / "o.json")))} == {"3", "_3"}
    np.savez(tmp_path / "e.npz", cids=np.array([4, 5]), V=np.eye(2, dtype=np.float32))
    assert rows(files.npz_embeddings(spark, str(tmp_path / "e.npz"))) == [(4, [1.0, 0.0]), (5, [0.0, 1.0])]
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    assert files.optional(spark, str(tmp_path / "none"), schema).count() == 0
    files.write_ordered(spark.range(10).selectExpr("cast(9 - id as int) x"), str(tmp_path / "p"), "x")
    assert [r["x"] for r in files.optional(spark, str(tmp_path / "p"), schema).orderBy("x").collect()] == list(range(10))
    assert files.signature_matches(str(tmp_path / "sig"), "a") and not files.signature_matches(str(tmp_path / "sig"), "b")


def test_stream_screens_each_work_once(spark, rows, tmp_path):
    from sieveline.streaming.screen import counts_by_hour, screen_stream

    src, t = tmp_path / "in", "timestamp'2026-01-01 10:00:00'"
    spark.sql(f"select '1' work_id, 'Editorial' title_display, {t} loaded_at union all select '1', 'Editorial', {t} union all select '2', 'Soil and rain', {t} union all select '3', null, {t} union all select '4', 'News', {t}").write.parquet(str(src))
    stream = spark.readStream.schema("work_id string, title_display string, loaded_at timestamp").parquet(str(src))
    retracted = spark.createDataFrame([("3",)], "work_id string")
    q = screen_stream(stream, retracted).writeStream.format("memory").queryName("screened").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("screened")
    assert rows(got, "work_id", "reason") == [("1", "junk_regex_v2"), ("3", "retracted"), ("4", "junk_regex_v3")]
    assert sum(r["works"] for r in counts_by_hour(got).collect()) == 3
