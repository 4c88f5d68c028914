"""Driver tables (one parquet file each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# tables whose rows carry long text: per-row work is regex-heavy
TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


def spread(df: DataFrame, key=None) -> DataFrame:
    """Give a CPU-heavy stage at least one partition per core.

    A small file scans as few splits as it has row groups, which can leave
    cores idle.  Only then is the scan hash-partitioned on ``key`` (a column
    or list of columns that is unique per row, so the spread is even and a
    retried task sees the same rows); a large input already has many splits
    and is returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    keys = [key] if isinstance(key, str) else list(key or [])
    return df.repartition(cores, *keys) if keys else df.repartition(cores)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_text_table(spark: SparkSession, sf_dir: str, name: str, key) -> DataFrame:
    return spread(read_table(spark, sf_dir, name), key)
