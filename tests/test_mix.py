import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chatmill.operators.mix import cap_per_source, exact_split, oversample, seeded_key, split_leakage
from chatmill.operators.ranking import dense_index, running_totals, within_rank
from chatmill.operators.tokens import pad_batches

CFG = "source string, weight double, max_samples bigint, category string"


def _ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("cap,expected", [(None, 30), (0, 30), (1000, 30), (7, 7)])
def test_cap(spark, cap, expected):
    df = spark.range(30).select(F.col("id"), F.lit("s").alias("source"))
    cfg = spark.createDataFrame([("s", 1.0, cap, "x")], CFG)
    assert cap_per_source(df, cfg, "id").count() == expected


def test_cap_equals_row_number_brute_force(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("source")).repartition(7)
    cfg = spark.createDataFrame([("0", 1.0, 100, "x"), ("1", 1.0, 5, "x"), ("2", 1.0, None, "x")], CFG)
    got = _ids(cap_per_source(df, cfg, "id"))
    w = Window.partitionBy("source").orderBy(seeded_key(42, "id"), "id")
    ref = df.join(cfg, "source").withColumn("rn", F.row_number().over(w)).filter(
        F.col("max_samples").isNull() | (F.col("rn") <= F.col("max_samples")))
    assert got == _ids(ref)


def test_oversample_counts(spark):
    df = spark.range(5).select("id", F.lit("m").alias("source")).union(
        spark.range(100, 104).select("id", F.lit("h").alias("source")))
    cfg = spark.createDataFrame([("m", 2.5, None, "math"), ("h", 0.5, None, "x")], CFG)
    out = oversample(df, cfg, "id")
    counts = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert counts == {"m": 12, "h": 4}
    extra = out.filter((F.col("source") == "m") & (F.col("copy") == 2)).collect()
    assert len({r.id for r in extra}) == 2          # distinct rows


@pytest.mark.parametrize("n", [21, 1, 0, 1000])
def test_split_sizes(spark, n):
    df = spark.range(n).select("id")
    out = exact_split(df, seeded_key(42, "id"), ["id"])
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    train = int(n * 0.95)
    assert counts.get("train", 0) == train and counts.get("validation", 0) == n - train


def test_split_independent_of_partitioning_and_equals_global_rank(spark):
    rows = list(range(3000))
    random.Random(1).shuffle(rows)
    a = spark.createDataFrame([(r,) for r in rows], "id long").repartition(3)
    b = spark.createDataFrame([(r,) for r in sorted(rows)], "id long").repartition(11)
    sa = {r.id for r in exact_split(a, seeded_key(42, "id"), ["id"]).filter("split = 'train'").collect()}
    sb = {r.id for r in exact_split(b, seeded_key(42, "id"), ["id"]).filter("split = 'train'").collect()}
    w = Window.orderBy(seeded_key(42, "id"), "id")
    ref = {r.id for r in a.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= int(3000 * 0.95)).collect()}
    assert sa == sb == ref


def test_within_rank_with_narrow_buckets(spark):
    # one hex digit -> many rows per bucket, exercising the boundary ranking
    df = spark.range(500).select("id", (F.col("id") % 2).alias("g"), seeded_key(3, "id").alias("k"))
    got = {r.id for r in within_rank(df, ["g"], "k", ["id"], F.lit(37), hex_digits=1).filter("in_rank").collect()}
    w = Window.partitionBy("g").orderBy("k", "id")
    ref = {r.id for r in df.withColumn("rn", F.row_number().over(w)).filter("rn <= 37").collect()}
    assert got == ref


def test_leakage_detects_copies_in_both_splits(spark):
    df = spark.createDataFrame([(1, "train"), (1, "validation"), (2, "train")], "id long, split string")
    assert [r.id for r in split_leakage(df, ["id"]).collect()] == [1]


def test_running_totals_equal_window(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("ab"), rnd.randint(0, 1)) for i in range(0, 3000, 3)]
    df = spark.createDataFrame(rows, "seq long, g string, v long")
    got = {(r.seq): (r.running_rows, r.running_v) for r in
           running_totals(df, ["g"], "seq", {"v": F.col("v")}, block_width=64).collect()}
    w = Window.partitionBy("g").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    ref = {r.seq: (r.n, r.s) for r in df.select("seq", F.count(F.lit(1)).over(w).alias("n"),
                                                F.sum("v").over(w).alias("s")).collect()}
    assert got == ref


def test_dense_index(spark):
    df = spark.createDataFrame([(x,) for x in random.Random(2).sample(range(10_000), 700)], "k long")
    out = sorted((r.k, r.row_index) for r in dense_index(df, ["k"], partitions=6).collect())
    assert [i for _, i in out] == list(range(700))


def test_batches_of_many_rows_with_payload(spark, tmp_path):
    # written and read back: an aggregate over the index alone prunes the payload
    n = 300_000
    ids = F.array_repeat(F.lit(7), (F.col("id") % 20 + 1).cast("int"))
    df = spark.range(n).select("id", F.xxhash64("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"),
                               ids.alias("input_ids"), ids.alias("attention_mask"), ids.alias("labels")).repartition(13)
    dense_index(df.select("k", "payload"), ["k"]).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    want = F.row_number().over(Window.orderBy("k")) - 1
    assert index.count() == n and index.withColumn("want", want).filter("want <> row_index").count() == 0

    pad_batches(df, ["k"], 8, 0).write.parquet(str(tmp_path / "padded"))
    padded = spark.read.parquet(str(tmp_path / "padded"))
    per = padded.groupBy("batch").agg(
        F.count("*").alias("rows"), F.max(F.col("id") % 20 + 1).alias("longest"),
        F.min("padded_length").alias("least"), F.max("padded_length").alias("most"), F.max(F.size("input_ids")).alias("size"))
    assert padded.select("id").distinct().count() == padded.count() == n
    assert per.count() == n // 8 and per.filter("rows <> 8").isEmpty()
    assert per.filter("least <> most OR most <> size OR most < longest OR most - longest >= 8 OR most % 8 <> 0").isEmpty()


def test_null_groups_are_ranked_and_unconfigured_sources_left_out(spark):
    df = spark.range(10).select("id", F.when(F.col("id") % 2 == 0, "s").alias("source"))
    ranked = within_rank(df.withColumn("k", seeded_key(1, "id")), ["source"], "k", ["id"], F.lit(3)).filter("in_rank")
    assert {r.source: r["count"] for r in ranked.groupBy("source").count().collect()} == {"s": 3, None: 3}
    totals = running_totals(df, ["source"], "id", {"v": F.lit(1)}, block_width=3)
    assert {r.id: (r.running_rows, r.running_v) for r in totals.collect()} == {i: (i // 2 + 1, i // 2 + 1) for i in range(10)}
    cfg = spark.createDataFrame([("s", 2.0, None, "x"), ("t", 1.0, None, "x")], CFG)
    assert _ids(cap_per_source(df, cfg, "id")) == [0, 2, 4, 6, 8]
    assert oversample(df, cfg, "id").count() == 10


def test_split_by_id_keeps_copies_together(spark):
    df = spark.range(400).select(F.col("id"), F.explode(F.sequence(F.lit(0), (F.col("id") % 3).cast("int"))).alias("copy"))
    out = exact_split(df, seeded_key(42, "id"), ["id", "copy"], by=["id"])
    assert split_leakage(out, ["id"]).count() == 0
    sides = {r.split: r["count"] for r in out.select("id", "split").distinct().groupBy("split").count().collect()}
    assert sides["train"] == int(400 * 0.95) and sides["validation"] == 400 - int(400 * 0.95)
    assert out.count() == df.count()
