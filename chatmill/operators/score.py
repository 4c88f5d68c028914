"""Benchmark scoring over a predictions table (``item_id, response`` and, for
code, a ``passed`` column from an external sandbox).  Gold and prediction
rows are matched by id with a left join: a missing prediction is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import choice_label, extract_choice, extract_numeric_answer, numbers_match
from .ranking import running_totals

# --- fixed values: progress report interval per benchmark -------------------
REPORT_EVERY = {"humaneval": 20, "gsm8k": 100, "mmlu": 500}
MMLU_DETAIL_ROWS = 100
# ---------------------------------------------------------------------------


def percent(correct: Column, total: Column) -> Column:
    return F.when(total > 0, correct.cast("double") * 100 / total)


def grade_numeric(gold: DataFrame, predictions: DataFrame, id_col: str = "item_id",
                  answer: str = "answer", response: str = "response") -> DataFrame:
    """Extract both numbers; correct when both exist and differ < 1e-6."""
    joined = gold.join(predictions.select(id_col, response), id_col, "left")
    return (joined.withColumn("ground_truth", extract_numeric_answer(F.col(answer)))
                  .withColumn("predicted", extract_numeric_answer(F.col(response)))
                  .withColumn("correct", numbers_match("predicted", "ground_truth")))


def grade_choice(gold: DataFrame, predictions: DataFrame, id_col: str = "item_id",
                 answer: str = "answer", response: str = "response") -> DataFrame:
    """Extract the chosen index; NULL prediction is wrong and shown '?'."""
    joined = gold.join(predictions.select(id_col, response), id_col, "left")
    return (joined.withColumn("predicted_idx", extract_choice(F.col(response)))
                  .withColumn("correct", F.coalesce(F.col("predicted_idx") == F.col(answer), F.lit(False)))
                  .withColumn("ground_truth", choice_label(F.col(answer)))
                  .withColumn("predicted", choice_label(F.col("predicted_idx"))))


def accuracy(graded: DataFrame, benchmark: str, metric: str = "accuracy", correct: str = "correct",
             groups: list[str] | None = None) -> DataFrame:
    """Score = correct / total * 100 rounded to 2 places, plus the counts."""
    agg = graded.groupBy(*(groups or [])).agg(
        F.count_if(F.col(correct)).alias("correct"), F.count(F.lit(1)).alias("total"))
    return agg.select(*(groups or []), F.lit(benchmark).alias("benchmark"), F.lit(metric).alias("metric"),
                      F.round(percent(F.col("correct"), F.col("total")), 2).alias("score"),
                      "correct", "total")


def subject_accuracy(graded: DataFrame, subject: str = "subject", order: str = "item_id") -> DataFrame:
    """Accuracy per subject (missing subject -> 'unknown'), 1 decimal, with
    the subject's first appearance for stable ordering."""
    s = F.coalesce(F.col(subject), F.lit("unknown"))
    return (graded.groupBy(s.alias("subject")).agg(
        F.count_if("correct").alias("correct"), F.count(F.lit(1)).alias("total"),
        F.min(order).alias("first_seen"))
        .withColumn("accuracy", F.round(percent(F.col("correct"), F.col("total")), 1)))


def running_accuracy(graded: DataFrame, order: str, groups: list[str] | None = None,
                     every: int | None = None, correct: str = "correct", block_width: int | None = None) -> DataFrame:
    """Cumulative accuracy in ``order`` (per group) and a flag on every
    ``every``-th row -- where the reference prints progress."""
    rt = running_totals(graded, groups or [], order, {"correct": F.col(correct).cast("long")},
                        block_width=block_width)
    rt = rt.withColumn("running_accuracy", F.col("running_correct").cast("double") * 100 / F.col("running_rows"))
    if every:
        rt = rt.withColumn("is_report_point", F.col("running_rows") % every == 0)
    return rt


def detail_rows(graded: DataFrame, columns: dict[str, Column], widths: dict[str, int] | None = None,
                order: str | None = None, limit: int | None = None) -> DataFrame:
    """Detail rows of every item, with whole texts.  ``widths`` cuts the named
    text columns to so many code points, and ``limit`` keeps the first rows in
    ``order``: the short forms that reports show."""
    cut = lambda n, c: F.substring(c, 1, widths[n]) if widths and n in widths else c
    rows = graded if limit is None else graded.orderBy(order).limit(limit)
    return rows.select(*[cut(n, c).alias(n) for n, c in columns.items()])


def select_benchmarks(df: DataFrame, allowed: list[str], name: str = "benchmark") -> DataFrame:
    """Keep only the requested benchmarks."""
    return df.filter(F.col(name).isin(list(allowed)))


def with_runtime(results: DataFrame, seconds: float) -> DataFrame:
    """Carry a measured runtime as a rounded column."""
    return results.withColumn("runtime_seconds", F.round(F.lit(float(seconds)), 1))
