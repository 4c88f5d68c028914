"""Counts taken while writing; several sinks of one stream."""

import json

import pytest
from pyspark.sql import functions as F

from chatmill.sinks.observed import counts_table, write_counted, write_observed
from chatmill.streaming.requests import batch_writer, read_table, run_requests, validated


def test_counts_are_those_of_the_rows_written(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("source")).repartition(7)
    out = str(tmp_path / "x")
    counts = write_counted(df, lambda d: d.write.parquet(out), "source", ["a", "b", None, "never"], {"n": F.lit(True), "even": F.col("id") % 2 == 0})
    assert counts == {"a": {"n": 334, "even": 167}, "b": {"n": 333, "even": 166}, None: {"n": 333, "even": 167}, "never": {"n": 0, "even": 0}}
    assert spark.read.parquet(out).count() == 1000
    assert sorted((str(r.source), r.n, r.even) for r in counts_table(spark, counts, "source").collect())[0] == ("None", 333, 167)
    with pytest.raises(ValueError, match="333 rows"):
        write_counted(df, lambda d: d.write.mode("overwrite").parquet(out), "source", ["a", "b"], {"n": F.lit(True)})
    assert write_observed(df.limit(0), lambda d: d.write.mode("overwrite").parquet(out), {"n": F.count(F.lit(1)), "m": F.max("id")}) == {"n": 0, "m": None}


REQUESTS = [('{"messages":[{"role":"user","content":"x"}]}', "chat", None), ('{"prompt":"x"}', "completion", None), ('{"prompt":"x","temperature":2}', "completion", None),
            ('{"prompt":"x","temperature":2.01}', "completion", "temperature out of range [0.0, 2.0]"), ('{"prompt":"x","max_tokens":1.5}', "completion", "max_tokens is no whole number"),
            ('{"prompt":"x","max_tokens":0}', "completion", "max_tokens out of range [1, 4096]"), ('{"prompt":"x","top_p":"much"}', "completion", "top_p is no number"),
            ('{"prompt":"x","repetition_penalty":9}', "completion", None), ('{"messages":[],"prompt":"x"}', "chat", "messages empty"), ('{"messages":"x"}', "chat", "messages is no list"),
            ('{"messages":[{"role":"user"}]}', "chat", "a message lacks role or content"), ('{"messages":[{"role":"user","content":5}]}', "chat", "a message lacks role or content"),
            ('{"messages":[{"role":"user","content":"x"}],"repetition_penalty":0.5}', "chat", "repetition_penalty out of range [1.0, 2.0]"),
            ('{"prompt":5}', "completion", "prompt is no text"), ('[1]', None, "neither messages nor prompt"), ('{}', None, "neither messages nor prompt"), ("", None, "not JSON"),
            ('{"prompt":"x"} trailing', None, "not JSON"), ('{"prompt":"x","temperature":null}', "completion", "temperature is no number"), ('{"prompt":"x","temperature":true}', "completion", "temperature is no number")]


def test_both_request_shapes(spark):
    out = validated(spark.createDataFrame([(v,) for v, _, _ in REQUESTS], "value string")).collect()
    assert {r.value: (r["shape"], r.reason) for r in out} == {v: (s, reason) for v, s, reason in REQUESTS}
    first = next(r for r in out if r.value == REQUESTS[1][0])
    assert (first.temperature, first.max_tokens, first.top_p, first.repetition_penalty) == (0.7, 2048, 0.9, None)


def test_a_restart_in_mid_batch_leaves_no_row_twice(spark, tmp_path):
    folder, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    folder.mkdir()
    for k in range(4):
        (folder / f"{k}.txt").write_text("".join(json.dumps({"prompt": f"{k} {i}", "temperature": i}) + "\n" for i in range(5)))
    own, runs = batch_writer(out, ["value"]), []

    def fails_once(batch, number):
        own(batch, number)  # everything of the batch is written, and then the driver is lost before the batch is committed
        runs.append(number)
        if number == 1 and runs.count(1) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run_requests(spark, str(folder), out, ckpt, files_per_batch=1, writer=fails_once)
    run_requests(spark, str(folder), out, ckpt, files_per_batch=1, writer=fails_once)
    assert runs == [0, 1, 1, 2, 3]
    accepted, quarantine, metrics = (read_table(spark, out, t) for t in ("accepted", "quarantine", "metrics"))
    assert (accepted.count(), accepted.select("value").distinct().count()) == (12, 12)  # temperatures 0, 1, 2 of each file
    assert (quarantine.count(), quarantine.select("value").distinct().count()) == (8, 8)
    assert {(r.verdict, r.n) for r in metrics.groupBy("verdict").agg(F.sum("n").alias("n")).collect()} == {("accepted", 12), ("temperature out of range [0.0, 2.0]", 8)}
    run_requests(spark, str(folder), out, ckpt)  # nothing new
    assert read_table(spark, out, "accepted").count() == 12
