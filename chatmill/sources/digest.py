"""A digest of a dataset's lines that adds up over file splits.

Each line is hashed with a key to a number ``d``; the digest of the lines
``1 .. n`` is ``n``, the sum of ``d`` (which lines there are, how often) and the
sum of ``i * d`` over the line numbers ``i`` (in which order), both modulo the
prime 2^61 - 1.  A split that begins after ``k`` lines adds ``k * sum(d)`` to its
own weighted sum, so splits are summed where they are read, in one scan, and
the result does not depend on how the files were cut.  A changed, missing,
repeated or moved line changes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PRIME = (1 << 61) - 1
#: hexadecimal digits of a line's hash that are taken: 60 bits
DIGITS = 15
KEY = "line"

_WIDE = "decimal(38,0)"


def line_number_hash(value: Column, key: str = KEY) -> Column:
    """The line's keyed hash as a number of 60 bits."""
    digest = F.md5(F.concat(F.lit(key + ":"), value).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("decimal(20,0)")


def _modulo(x: Column) -> Column:
    return (x % F.lit(PRIME).cast("decimal(20,0)")).cast("decimal(20,0)")


def split_digests(spark: SparkSession, paths, key: str = KEY) -> DataFrame:
    """One row per file split: ``file, block, n, plain, weighted`` (line numbers from 1 in the split)."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                          F.monotonically_increasing_id().alias("row"), line_number_hash(F.col("value"), key).alias("d"))
    # row ids are numbered by task, not by split: the first one of the split is taken off afterwards
    local = F.col("row").bitwiseAND(F.lit((1 << 33) - 1)).cast("decimal(20,0)")
    sums = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min(local).alias("first"),
                                              F.sum(F.col("d").cast(_WIDE)).alias("plain"), F.sum(_modulo(local * F.col("d")).cast(_WIDE)).alias("weighted"))
    plain = _modulo(F.col("plain"))
    below = _modulo((F.col("first") - 1 + F.lit(PRIME)) % F.lit(PRIME).cast("decimal(20,0)"))  # the first line of the split has number 1
    return sums.select("file", "block", "n", plain.alias("plain"),
                       _modulo(F.col("weighted") + F.lit(PRIME).cast(_WIDE) - _modulo(below * plain)).alias("weighted"))


def merged(splits: DataFrame, by: list[str]) -> DataFrame:
    """Digests of the lines of each value of ``by``, the splits in order of
    file and block: ``n, plain, weighted, digest``."""
    ahead = Window.partitionBy(*by).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)).cast("decimal(20,0)"))
    shifted = _modulo(F.col("weighted") + _modulo(F.col("before") * F.col("plain")))
    out = placed.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.col("plain").cast(_WIDE)).alias("plain"), F.sum(shifted.cast(_WIDE)).alias("weighted"))
    out = out.withColumn("plain", _modulo(F.col("plain"))).withColumn("weighted", _modulo(F.col("weighted")))
    return out.withColumn("digest", F.concat_ws("-", F.col("n").cast("string"), F.col("plain").cast("string"), F.col("weighted").cast("string")))


def file_digests(spark: SparkSession, paths, key: str = KEY) -> DataFrame:
    """``file, n, plain, weighted, digest`` of each file under ``paths``."""
    return merged(split_digests(spark, paths, key), ["file"])
