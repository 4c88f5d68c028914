"""Incremental cleaning with Structured Streaming.

New raw files are picked up as they land; the same converters run per
micro-batch and a stateful ``dropDuplicates`` on ``(source, content_key)``
removes copies across batches.  Streaming can only keep the first copy
*seen* (arrival order), not the first by file position.  Without an event
time the dedup state holds every key; with one, use
``dropDuplicatesWithinWatermark`` to bound it.

Checkpoints and outputs live under the shared ``spark.checkpoint.dir``; the
result is read back from the written table, never collected on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import content_hash
from ..operators.convert import DEFAULT_SYSTEM, convert_parsed, convert_triples
from ..session import scratch_path
from ..sources.jsonl import parse_json


def clean_stream(lines: DataFrame, shape: str, source: str, default_system: str = DEFAULT_SYSTEM,
                 dedup_window: str | None = None) -> DataFrame:
    """Streaming text lines -> converted, deduplicated rows.

    ``dedup_window`` (e.g. ``"7 days"``) bounds the dedup state: the file
    modification time is the event time, and copies are dropped only when
    they arrive within that window of each other (state older than the
    watermark is evicted).  Without it every key is kept in state forever,
    which is exact but grows with the corpus."""
    parsed = lines.select(F.lit(source).alias("source"), parse_json("value").alias("parsed"),
                          F.col("_metadata.file_modification_time").alias("arrived"))
    conv = convert_parsed(parsed.filter(F.col("parsed").isNotNull()), shape, default_system=default_system)
    keyed = conv.filter(F.col("messages").isNotNull()).withColumn("content_key", content_hash("messages"))
    if dedup_window:
        deduped = keyed.withWatermark("arrived", dedup_window).dropDuplicatesWithinWatermark(["source", "content_key"])
    else:
        deduped = keyed.dropDuplicates(["source", "content_key"])
    return deduped.select("source", "content_key", "messages")


def run_to_completion(df: DataFrame, output: str, checkpoint: str, fmt: str = "parquet") -> None:
    q = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(output))
    q.awaitTermination()


def incremental_clean(spark: SparkSession, input_dir: str, shape: str, source: str,
                      output: str | None = None, checkpoint: str | None = None,
                      dedup_window: str | None = None) -> DataFrame:
    """Process every file present in ``input_dir`` (and, on re-runs, only new
    ones) and return the accumulated output table."""
    output = output or scratch_path(spark, "incremental-out")
    checkpoint = checkpoint or scratch_path(spark, "incremental-ckpt")
    lines = spark.readStream.format("text").load(input_dir)
    run_to_completion(clean_stream(lines, shape, source, dedup_window=dedup_window), output, checkpoint)
    return spark.read.parquet(output)


def incremental_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents streamed as a file source -> triple conversion -> stateful
    dedup -> (source, content_key) of every distinct converted document."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    stream = (spark.readStream.schema(docs.schema).format("parquet")
              .load(f"{sf_dir.rstrip('/')}/documents*.parquet"))
    cores = spark.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() < cores:
        # few input splits: spread the CPU-heavy conversion over the cores
        stream = stream.repartition(cores, "doc_id")
    nl = F.instr(F.col("text"), "\n")
    triples = stream.select(
        "doc_id", "source", F.col("source").alias("system_prompt"),
        F.substring_index(F.col("text"), "\n", 1).alias("question"),
        F.when(nl > 0, F.expr("substr(text, instr(text, '\n') + 1)")).otherwise(F.lit("")).alias("response"))
    conv = convert_triples(triples, default_system=DEFAULT_SYSTEM)
    keyed = conv.filter(F.col("messages").isNotNull()).withColumn("content_key", content_hash("messages"))
    deduped = keyed.dropDuplicates(["source", "content_key"]).select("source", "content_key")
    output = scratch_path(spark, "stream-keys")
    run_to_completion(deduped, output, scratch_path(spark, "stream-keys-ckpt"))
    return spark.read.parquet(output)
