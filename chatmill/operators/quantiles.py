"""Exact quantiles of whole numbers by histogram refinement.

A counter per distinct value does not stay small when lengths are not cut, and
sorting a group puts it into one task.  Here every level counts values in at
most ``FAN`` buckets per group and open bucket (combined map-side), finds the
bucket each wanted rank falls into, and the next level looks into these
buckets only, until a bucket is one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once

FAN = 4096


def values_at_ranks(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """``values``: (g, v) with ``v`` a non-negative BIGINT, ``ranks``: (g,
    rank) with 0-based ranks inside the group.  Returns (g, rank, v)."""
    most = values.agg(F.max("v")).first()[0] or 0
    width = 1
    while width * FAN <= most:
        width *= FAN
    found = ranks.withColumn("bucket", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long"))
    first = True
    while width:
        rows = values.withColumn("bucket", F.call_function("div", F.col("v"), F.lit(width)))
        if not first:  # only what lies in the buckets found so far
            rows = rows.withColumn("outer", F.call_function("div", F.col("bucket"), F.lit(FAN)))
            rows = rows.join(found.select("g", F.col("bucket").alias("outer")).distinct(), ["g", "outer"], "left_semi")
        counts = rows.groupBy("g", "bucket").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.withColumn("outer", F.lit(0).cast("long") if first else F.call_function("div", F.col("bucket"), F.lit(FAN)))
        upto = F.sum("n").over(Window.partitionBy("g", "outer").orderBy("bucket"))  # at most FAN rows
        counts = counts.withColumn("upto", upto).withColumnRenamed("bucket", "inner")
        hit = found.withColumnRenamed("bucket", "outer").join(counts, ["g", "outer"]).filter(
            (F.col("before") + F.col("upto") > F.col("rank")) & (F.col("before") + F.col("upto") - F.col("n") <= F.col("rank")))
        found = write_once(hit.select("g", "rank", F.col("inner").alias("bucket"), (F.col("before") + F.col("upto") - F.col("n")).alias("before")), "quantile-buckets")
        first, width = False, width // FAN
    return found.select("g", "rank", F.col("bucket").alias("v"))


def exact_quantiles(df: DataFrame, value: str, probabilities: dict[str, float], groups: list[str] | None = None) -> DataFrame:
    """One row per value of ``groups`` (NULL is a value like any other): a
    column for each of ``probabilities``, linearly interpolated between the two
    ranks next to it.  NULL values are left out; a group without any gives no
    row.  ``df`` is read once and its light columns are written."""
    keys = groups or []
    light = write_once(df.filter(F.col(value).isNotNull()).select(F.struct(F.lit(0).alias("_cm_one"), *keys).alias("g"), F.col(value).cast("long").alias("v")), "quantile-values")
    sizes = light.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    wanted = sizes.select("g", F.inline(F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(float(p)) * (F.col("n") - 1)).alias("at")) for name, p in probabilities.items()])))
    wanted = write_once(wanted.withColumn("low", F.floor("at")).withColumn("high", F.ceil("at")), "quantile-ranks")
    ranks = wanted.select("g", F.explode(F.array("low", "high")).alias("rank")).distinct()
    found = values_at_ranks(light, ranks)
    low = found.select("g", F.col("rank").alias("low"), F.col("v").alias("v_low"))
    high = found.select("g", F.col("rank").alias("high"), F.col("v").alias("v_high"))
    each = wanted.join(low, ["g", "low"]).join(high, ["g", "high"]).withColumn(
        "value", F.col("v_low") + (F.col("v_high") - F.col("v_low")) * (F.col("at") - F.col("low")))
    out = each.groupBy("g").agg(*[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in probabilities])
    return out.select(*[F.col(f"g.{k}").alias(k) for k in keys], *probabilities)
