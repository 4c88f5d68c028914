"""Table computations re-aimed from the training and serving stages (no model
is trained or served here): the training-plan arithmetic, validation of a
table of batch requests, and token usage accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: request defaults and allowed ranges ----------------------
REQUEST_DEFAULTS = {"temperature": 0.7, "max_tokens": 2048, "top_p": 0.9, "repetition_penalty": 1.05}
REQUEST_RANGES = {"temperature": (0.0, 2.0), "max_tokens": (1, 4096), "top_p": (0.0, 1.0),
                  "repetition_penalty": (1.0, 2.0)}
# --- fixed values: training profiles (batch, accumulation, epochs, warm-up) --
TRAINING_PROFILES = [("local", 1, 16, 1, 0.05), ("cloud", 1, 32, 3, 0.05)]
# ---------------------------------------------------------------------------


def training_plan(train_counts: DataFrame, profiles: DataFrame) -> DataFrame:
    """steps = n // batch // accumulation * epochs (left to right), warm-up =
    max(1, int(steps * ratio)), effective batch = batch * accumulation.
    ``train_counts``: one row (train_examples); ``profiles``: a few literal
    rows.  The count is a single number, fetched and attached as a literal."""
    n = train_counts.select(F.col("train_examples").cast("long")).first()[0] or 0
    steps = (F.floor(F.floor(F.col("train_examples") / F.col("batch_size")) / F.col("grad_accumulation"))
             * F.col("epochs")).cast("bigint")
    return (profiles.withColumn("train_examples", F.lit(int(n)).cast("bigint"))
            .withColumn("total_steps", steps)
            .withColumn("warmup_steps", F.greatest(F.lit(1), F.floor(F.col("total_steps") * F.col("warmup_ratio")))
                        .cast("bigint"))
            .withColumn("effective_batch", F.col("batch_size") * F.col("grad_accumulation")))


def profiles_df(spark) -> DataFrame:
    return spark.createDataFrame(TRAINING_PROFILES, "profile string, batch_size int, grad_accumulation int, "
                                                    "epochs int, warmup_ratio double")


def range_check(c: Column, name: str) -> Column:
    lo, hi = REQUEST_RANGES[name]
    return F.when(~c.between(lo, hi), F.lit(f"{name} out of range [{lo}, {hi}]"))


def validate_requests(requests: DataFrame) -> DataFrame:
    """Fill defaults, then flag each request: ``reason`` is NULL for a valid
    request, else the first failed rule (valid rows go on, the rest to
    quarantine)."""
    out = requests
    for k, v in REQUEST_DEFAULTS.items():
        out = out.withColumn(k, F.coalesce(F.col(k), F.lit(v)))
    empty = F.when(F.coalesce(F.size("messages"), F.lit(0)) == 0, F.lit("messages empty"))
    reason = F.coalesce(empty, *[range_check(F.col(k), k) for k in REQUEST_RANGES])
    return out.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def usage(df: DataFrame, prompt_tokens: str, completion_tokens: str, elapsed: str) -> DataFrame:
    """total = prompt + completion; tokens per second = completion / elapsed,
    0 when elapsed <= 0."""
    return (df.withColumn("total_tokens", F.col(prompt_tokens) + F.col(completion_tokens))
              .withColumn("tokens_per_second",
                          F.when(F.col(elapsed) > 0, F.col(completion_tokens).cast("double") / F.col(elapsed))
                           .otherwise(F.lit(0.0))))
