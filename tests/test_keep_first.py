"""Stateful keep-first: late earlier copies, and state that ends."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chatmill.operators.dedup import keep_first
from chatmill.streaming.incremental import run_to_completion
from chatmill.streaming.keep_first import changes, first_copies

SCHEMA = "source string, content_key string, seq long, at timestamp"


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def put(spark, folder, rows):
    start = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(s, k, o, start + dt.timedelta(minutes=m)) for s, k, o, m in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp}/in")
    q = (changes(stream, ["source", "content_key"], "seq", "at", "10 minutes", 600_000).writeStream.format("parquet").option("checkpointLocation", f"{tmp}/ckpt")
         .option("path", f"{tmp}/out").trigger(availableNow=True).start())
    q.awaitTermination()
    return [p["stateOperators"][0]["customMetrics"] for p in q.recentProgress if p["stateOperators"]]


def test_late_earlier_copies_replace_the_kept_one(spark, tmp_path, few_partitions):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b"]), rng.choice(["hot", "hot", "x", "y", None]), i, i % 5) for i in range(300)]
    rng.shuffle(rows)
    for part in (rows[:150], rows[150:]):
        put(spark, str(tmp_path / "in"), part)
        run(spark, tmp_path)
    df = spark.createDataFrame([(s, k, o) for s, k, o, _ in rows if k], "source string, content_key string, seq long")
    batch = {(r.source, r.content_key, r.seq) for r in keep_first(df, ["source", "content_key"], "seq").collect()}
    found = first_copies(spark, str(tmp_path / "out"), ["source", "content_key"]).filter(F.col("content_key").isNotNull()).collect()
    assert {tuple(r) for r in found} == batch
    change = spark.read.parquet(str(tmp_path / "out"))
    assert change.filter("replaces <= `order`").count() == 0
    # each key is new once, and each change replaces what was first before
    assert change.filter("replaces IS NULL").count() == change.select("source", "content_key").distinct().count()


def test_state_ends_with_the_window(spark, tmp_path, few_partitions):
    put(spark, str(tmp_path / "in"), [("a", "x", 5, 0), ("a", "y", 7, 1)])
    run(spark, tmp_path)
    put(spark, str(tmp_path / "in"), [("a", "z", 1, 500)])  # moves the watermark far ahead: x and y end
    run(spark, tmp_path)
    put(spark, str(tmp_path / "in"), [("a", "x", 9, 501)])  # a new key by now, though 5 came before
    run(spark, tmp_path)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.content_key, r.order, r.replaces) for r in out.collect()) == [("x", 5, None), ("x", 9, None), ("y", 7, None), ("z", 1, None)]
