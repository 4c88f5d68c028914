"""The keyed bijection and the order it gives."""

import random

import pytest
from pyspark.sql import functions as F

from chatmill.operators.shuffle import in_parts, permuted, prefix_split, round_keys, shuffled


@pytest.mark.parametrize("n", [1, 2, 3, 4, 15, 16, 17, 1000, 99_991])
def test_every_place_once(spark, n):
    places = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), 42).alias("p"))
    assert tuple(places.agg(F.min("p"), F.max("p"), F.countDistinct("p"), F.count("p")).first()) == (0, n - 1, n, n)


def test_large_totals_stay_inside(spark):
    n = 1 << 52
    near = spark.range(n - 1000, n).select(permuted(F.col("id"), F.lit(n).cast("long"), 1).alias("p"))
    assert near.filter((F.col("p") < 0) | (F.col("p") >= n)).count() == 0
    assert near.distinct().count() == 1000


def test_a_shuffle_and_not_an_order(spark):
    n = 20_000
    df = spark.range(n).select("id", permuted(F.col("id"), F.lit(n).cast("long"), 7).alias("p"), permuted(F.col("id"), F.lit(n).cast("long"), 8).alias("q"))
    r = df.agg(F.corr("id", "p").alias("a"), F.corr("p", "q").alias("b"), F.count_if(F.col("p") == F.col("id")).alias("still"),
               F.count_if(F.col("p") < n // 2).alias("low")).first()
    assert abs(r.a) < 0.03 and abs(r.b) < 0.03 and r.still < 12 and r.low == n // 2
    # neighbours do not stay neighbours, and each tenth of the input spreads over all tenths of the output
    spread = df.groupBy(F.floor(F.col("id") / 2000).alias("from"), F.floor(F.col("p") / 2000).alias("to")).count().collect()
    assert len(spread) == 100 and all(120 < x["count"] < 280 for x in spread)


def test_same_order_whatever_the_input(spark):
    rows = [(i, f"s{i % 3}") for i in range(3000)]
    random.Random(1).shuffle(rows)
    a = shuffled(spark.createDataFrame(rows, "id long, source string").repartition(3), ["source", "id"], 42)
    b = shuffled(spark.createDataFrame(sorted(rows), "id long, source string").repartition(11), ["source", "id"], 42)
    assert {tuple(r) for r in a.select("id", "position", "n_rows").collect()} == {tuple(r) for r in b.select("id", "position", "n_rows").collect()}
    split = prefix_split(a, 0.95)
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 2850, "validation": 150}
    assert shuffled(spark.createDataFrame([], "id long, source string"), ["source", "id"], 42).count() == 0


def test_written_parts_are_in_order(spark, tmp_path):
    placed = prefix_split(shuffled(spark.range(5000).toDF("id"), ["id"], 3), 0.9)
    in_parts(placed, 400, by=["split"]).write.partitionBy("split").parquet(str(tmp_path / "out"))
    for split, n in (("train", 4500), ("validation", 500)):
        files = sorted((tmp_path / "out" / f"split={split}").glob("part-*"))
        seen = [r.position for f in files for r in spark.read.parquet(str(f)).collect()]  # file by file, row by row
        assert len(seen) == n and seen == sorted(seen)
    assert round_keys(1) != round_keys(2)
