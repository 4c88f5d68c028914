"""Sinks: cleaned JSON lines, the prepared columnar dataset, tokenized data,
manifests and report lines.  Everything is written by Spark's writers from
the executors; manifests are one-row (or one-row-per-source) aggregates
turned into JSON by ``to_json`` -- nothing large passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed_text, percent_text, short_checksum

DASH = "—"


def write_cleaned(df: DataFrame, path: str, source: str = "source", messages: str = "messages") -> None:
    """Kept rows as JSON lines per source (non-ASCII kept as is), replacing
    what was there."""
    (df.select(source, messages).write.mode("overwrite").partitionBy(source)
       .option("compression", "none").json(path))


def prepared_columns(df: DataFrame, messages: str = "messages", source: str = "source",
                     keep: list[str] | None = None) -> DataFrame:
    """The prepared-dataset row: messages re-encoded as a JSON string and the
    source (``unknown`` when missing)."""
    return df.select(*(keep or []), F.to_json(F.col(messages)).alias("messages"),
                     F.coalesce(F.col(source), F.lit("unknown")).alias("source"), "split")


def write_prepared(df: DataFrame, path: str) -> None:
    """Columnar train/validation dataset, partitioned by split so a reload
    of one split prunes the other."""
    prepared_columns(df).write.mode("overwrite").partitionBy("split").parquet(path)


def write_split_jsonl(df: DataFrame, path: str, messages: str = "messages") -> None:
    """JSON-lines copy of each split without internal metadata."""
    df.select(messages, "split").write.mode("overwrite").partitionBy("split").json(path)


def write_nested(df: DataFrame, path: str, messages: str = "messages") -> None:
    """Nested-column export (both splits; validation may be empty)."""
    df.select(messages, "split").write.mode("overwrite").partitionBy("split").parquet(path)


def write_tokenized(df: DataFrame, path: str) -> None:
    df.select("input_ids", "attention_mask", "labels", "split").write.mode("overwrite").partitionBy("split").parquet(path)


def manifest_json(df: DataFrame) -> DataFrame:
    """One JSON document per row (``value`` column) for ``write.text``."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_manifest(df: DataFrame, path: str) -> None:
    manifest_json(df).coalesce(1).write.mode("overwrite").text(path)


def cleaning_manifest(summary: DataFrame, stage: str = "cleaning") -> DataFrame:
    """One row: stage, per-source results (array of structs) and totals."""
    per = summary.filter(F.col("source") != "Total")
    return per.agg(
        F.lit(stage).alias("stage"),
        F.collect_list(F.struct(*[F.col(c) for c in per.columns])).alias("results"),
        F.sum("input").alias("total_input"),
        F.sum("output").alias("total_output"))


def preparation_manifest(split_counts: DataFrame, load_stats: DataFrame, seed: int, ratio: float) -> DataFrame:
    """Totals per split, the ratio and seed, and per-source load stats, in
    one aggregate over the stacked (small) inputs."""
    stat = F.struct(*[F.col(c) for c in load_stats.columns]).alias("stat")
    stacked = (split_counts.select("split", F.col("count").cast("long").alias("count"),
                                   F.lit(None).cast(stat_type(load_stats)).alias("stat"))
               .unionByName(load_stats.select(F.lit(None).cast("string").alias("split"),
                                              F.lit(None).cast("long").alias("count"), stat)))
    return (stacked.agg(
        F.sum(F.when(F.col("split") == "train", F.col("count"))).alias("train_examples"),
        F.sum(F.when(F.col("split") == "validation", F.col("count"))).alias("validation_examples"),
        F.collect_list("stat").alias("source_stats"))
        .withColumn("train_ratio", F.lit(float(ratio)))
        .withColumn("random_seed", F.lit(int(seed)))
        .withColumn("total_examples", F.col("train_examples") + F.coalesce("validation_examples", F.lit(0))))


def stat_type(df: DataFrame) -> str:
    return df.select(F.struct(*[F.col(c) for c in df.columns])).schema[0].dataType.simpleString()


def summary_table_row(name: Column, status: Column, inp: Column, out: Column, dropped: Column,
                      size_bytes: Column) -> Column:
    """The cleaning summary row as display strings: thousands separators,
    retention with one decimal or a dash, size in MB or a dash."""
    retention = F.when(inp > 0, percent_text(out, F.greatest(inp, F.lit(1)), 1))
    size = F.when(size_bytes > 0, F.concat(fixed_text(size_bytes.cast("double") / F.lit(1e6), 1), F.lit(" MB")))
    return F.struct(name.alias("dataset"), status.alias("status"),
                    F.format_number(inp, 0).alias("input"), F.format_number(out, 0).alias("output"),
                    F.format_number(dropped, 0).alias("dropped"),
                    F.coalesce(retention, F.lit(DASH)).alias("retention"),
                    F.coalesce(size, F.lit(DASH)).alias("size"))


def checksum_display(c) -> Column:
    return F.concat(short_checksum(c, 16), F.lit("..."))


def report_timestamp(ts: Column) -> Column:
    """ISO-8601 UTC with a trailing Z, whatever the session's zone (pass the
    run time in as a literal for deterministic output)."""
    return F.concat(F.date_format(F.to_utc_timestamp(ts, F.current_timezone()),"yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def write_jsonl(df: DataFrame, path: str) -> int:
    """Full ingest to JSON lines; returns the row count of what was written
    (read back from the files, so it is the count on disk)."""
    df.write.mode("overwrite").option("compression", "none").json(path)
    return df.sparkSession.read.text(path).count()


def tokenization_manifest(stats: DataFrame, max_length: int, tokenizer_name: str) -> DataFrame:
    """Tokenization config and per-split statistics as one document."""
    per = stats.agg(F.collect_list(F.struct(*[F.col(c) for c in stats.columns])).alias("statistics"))
    return per.select(F.lit(tokenizer_name).alias("tokenizer"), F.lit(int(max_length)).alias("max_seq_length"),
                      "statistics")


def evaluation_report(results: DataFrame, subjects: DataFrame | None, model: str, timestamp: Column) -> DataFrame:
    """One-row evaluation report: benchmarks keyed by name (a repeated name
    keeps the last), macro average of the rounded scores, a score map and,
    when given, MMLU subject accuracies as a map -- one aggregate over the
    stacked result and subject rows."""
    from ..operators.report import latest_per_benchmark
    res = latest_per_benchmark(results, "run") if "run" in results.columns else results
    cols = [c for c in res.columns if c != "run"]
    bench = F.struct(*[F.col(c) for c in cols])
    rows = res.select(F.col("benchmark").alias("k"), bench.alias("bench"), F.col("score").alias("score"),
                      F.lit(None).cast("double").alias("acc"))
    if subjects is not None:
        rows = rows.unionByName(subjects.select(
            F.col("subject").alias("k"), F.lit(None).cast(rows.schema["bench"].dataType).alias("bench"),
            F.lit(None).cast("double").alias("score"), F.col("accuracy").cast("double").alias("acc")))
    is_b = F.col("bench").isNotNull()
    agg = rows.agg(
        F.map_from_entries(F.collect_list(F.when(is_b, F.struct("k", "bench")))).alias("benchmarks"),
        F.count_if(is_b).alias("num_benchmarks"),
        F.coalesce(F.round(F.avg("score"), 2), F.lit(0.0)).alias("average_score"),
        F.map_from_entries(F.collect_list(F.when(is_b, F.struct("k", "score")))).alias("scores"),
        F.map_from_entries(F.collect_list(F.when(~is_b, F.struct("k", "acc")))).alias("subject_accuracies"))
    out = agg.select(F.lit(model).alias("model"), timestamp.alias("timestamp"), "benchmarks",
                     F.struct("num_benchmarks", "average_score", "scores").alias("summary"),
                     "subject_accuracies")
    return out if subjects is not None else out.drop("subject_accuracies")
