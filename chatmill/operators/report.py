"""Reports: benchmark results against baselines, subject rankings, manifest
summaries and formatted report lines.  Inputs are small result tables; the
baseline table is a few literal rows (broadcast)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DASH = "—"


def with_baselines(results: DataFrame, baselines: DataFrame) -> DataFrame:
    """Left join on benchmark; a missing or 0 baseline counts as absent."""
    b = baselines.select("benchmark", F.nullif(F.col("baseline"), F.lit(0.0)).alias("baseline"))
    joined = results.join(F.broadcast(b), "benchmark", "left")
    return joined.withColumn("delta", F.round(F.col("score") - F.col("baseline"), 1))


def terminal_delta(delta: Column) -> Column:
    """'+x.x' above 0, 'x.x' below, bare '0.0' at 0, dash when absent."""
    return (F.when(delta.isNull(), F.lit(DASH))
             .when(delta > 0, F.format_string("+%.1f", delta))
             .when(delta < 0, F.format_string("%.1f", delta))
             .otherwise(F.lit("0.0")))


def markdown_delta(delta: Column) -> Column:
    """'+x.x%' at or above 0, 'x.x%' below, dash when absent."""
    return (F.when(delta.isNull(), F.lit(DASH))
             .when(delta >= 0, F.format_string("+%.1f%%", delta))
             .otherwise(F.format_string("%.1f%%", delta)))


def report_summary(results: DataFrame, baselines: DataFrame) -> DataFrame:
    """One row: number of benchmarks, macro average of the (already rounded)
    scores (0 if none), average over *all* baselines and the overall delta.
    Scores and baselines are stacked and reduced in a single aggregate."""
    stacked = (results.select(F.col("score").alias("s"), F.lit(None).cast("double").alias("b"))
               .unionByName(baselines.select(F.lit(None).cast("double").alias("s"), F.col("baseline").alias("b"))))
    s = stacked.agg(F.count("s").alias("num_benchmarks"),
                    F.coalesce(F.round(F.avg("s"), 2), F.lit(0.0)).alias("average_score"),
                    F.avg("b").alias("baseline_average"))
    return s.withColumn("overall_delta", F.round(F.col("average_score") - F.col("baseline_average"), 1))


def latest_per_benchmark(results: DataFrame, order: str) -> DataFrame:
    """A benchmark named twice keeps its last result."""
    w = Window.partitionBy("benchmark").orderBy(F.col(order).desc())
    return results.withColumn("_cm_rn", F.row_number().over(w)).filter("_cm_rn = 1").drop("_cm_rn")


def top_bottom_subjects(subjects: DataFrame, k: int = 10) -> DataFrame:
    """Subjects by accuracy descending (ties: first appearance).  Top k, and
    bottom k only when there are more than k subjects (the lists may
    overlap).  One row per (list, subject) with its position."""
    # one row per subject: a whole-table window over a small aggregate
    total = F.count(F.lit(1)).over(Window.partitionBy())
    ranked = subjects.withColumn("position", F.row_number().over(
        Window.orderBy(F.col("accuracy").desc(), F.col("first_seen"))))
    ranked = ranked.withColumn("n_subjects", total)
    top = ranked.filter(F.col("position") <= k).withColumn("list", F.lit("top"))
    bottom = (ranked.filter((F.col("n_subjects") > k) & (F.col("position") > F.col("n_subjects") - k))
                    .withColumn("list", F.lit("bottom")))
    return top.unionByName(bottom).drop("n_subjects")


def markdown_result_line(name: Column, metric: Column, score: Column, baseline: Column, delta: Column) -> Column:
    base = F.when(baseline.isNull(), F.lit(DASH)).otherwise(F.concat(baseline.cast("string"), F.lit("%")))
    return F.concat_ws(" | ", F.concat(F.lit("| "), name), metric, F.concat(score.cast("string"), F.lit("%")),
                       base, F.concat(markdown_delta(delta), F.lit(" |")))


def download_summary(manifest: DataFrame) -> DataFrame:
    """Counts by status (skipped counts as success) and sums of examples and
    bytes over a download manifest."""
    ok = F.col("status").isin("success", "skipped")
    return manifest.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum("num_examples"), F.lit(0)).alias("total_examples"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_size_bytes"))


def report_rows(results: DataFrame, baselines: DataFrame, subjects: DataFrame, k: int = 10) -> DataFrame:
    """The report's tables as lines in order (section, position, line): the
    results with header and average, then the best and the worst subjects."""
    compared = with_baselines(results, baselines)
    first = F.row_number().over(Window.orderBy("benchmark"))  # one row per benchmark
    lines = compared.select(F.lit("results").alias("section"), (first + 2).cast("long").alias("position"),
                            markdown_result_line(F.col("benchmark"), F.col("metric"), F.col("score"), F.col("baseline"), F.col("delta")).alias("line"))
    total = report_summary(results, baselines)
    average = total.select(F.lit("results").alias("section"), (F.col("num_benchmarks") + 3).cast("long").alias("position"), markdown_result_line(
        F.lit("**Average**"), F.lit("mean"), F.col("average_score"), F.col("baseline_average"), F.col("overall_delta")).alias("line"))
    heads = [("results", 1, "| Benchmark | Metric | Score | Baseline | Delta |"), ("results", 2, "|---|---|---|---|---|")]
    for section in ("top", "bottom"):
        heads += [(section, 1, "| Subject | Accuracy |"), (section, 2, "|---|---|")]
    ranked = top_bottom_subjects(subjects, k)
    place = F.row_number().over(Window.partitionBy("list").orderBy("position"))
    named = ranked.select(F.col("list").alias("section"), (place + 2).cast("long").alias("position"),
                          F.concat(F.lit("| "), "subject", F.lit(" | "), F.format_string("%.1f%%", "accuracy"), F.lit(" |")).alias("line"))
    head = results.sparkSession.createDataFrame(heads, "section string, position long, line string")
    return head.unionByName(lines).unionByName(average).unionByName(named)
