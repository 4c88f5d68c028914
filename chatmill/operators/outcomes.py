"""Cleaning outcomes: every input line ends as exactly one of
``parse_error``, ``conversion_failed``, ``duplicate`` or ``kept`` (checked in
that order), so ``input = output + dropped`` holds by construction.  The
classified frame is computed once and feeds both sinks (rows and metrics)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .convert import DEFAULT_SYSTEM, convert_parsed
from .dedup import flag_duplicates, with_content_key

OUTCOMES = ("parse_error", "conversion_failed", "duplicate", "kept")


def classify_lines(lines: DataFrame, shape: str, default_system: str = DEFAULT_SYSTEM,
                   scope: str = "source", order: str = "seq", parsed: str = "parsed",
                   keep_messages: bool = True, materialize: bool = False) -> DataFrame:
    """``lines``: one row per raw line with ``scope``, ``order`` (unique) and a
    parsed VARIANT (NULL = not JSON).  Adds ``messages``, ``content_key`` and
    ``outcome``.  Duplicates are judged per ``scope`` among converted rows.

    Dedup reads the keyed lines twice (key aggregate, then the join on
    ``order``).  With ``materialize`` the keyed lines are checkpointed once,
    so each line is parsed and converted only once; with
    ``keep_messages=False`` only the light columns are kept (and written)."""
    conv = convert_parsed(lines, shape, parsed=parsed, default_system=default_system)
    keyed = (with_content_key(conv)
             .withColumn("_cm_parse_failed", F.col(parsed).isNull())
             .withColumn("_cm_failed", F.col("messages").isNull()))
    if not keep_messages:
        keyed = keyed.drop("messages", parsed)
    if materialize:
        from ..session import materialize as _mat
        keyed = _mat(keyed)
    flagged = flag_duplicates(keyed, [scope, "content_key"], order)
    outcome = (F.when(F.col("_cm_parse_failed"), F.lit("parse_error"))
                .when(F.col("_cm_failed"), F.lit("conversion_failed"))
                .when(F.col("is_duplicate"), F.lit("duplicate"))
                .otherwise(F.lit("kept")))
    return flagged.withColumn("outcome", outcome).drop("is_duplicate", "_cm_parse_failed", "_cm_failed")


def outcome_counts(classified: DataFrame, scope: str = "source") -> DataFrame:
    """Per scope: input, output, dropped and dropped by reason."""
    cnt = lambda name: F.count_if(F.col("outcome") == name)
    return (classified.groupBy(scope).agg(
        F.count(F.lit(1)).alias("input"),
        cnt("kept").alias("output"),
        cnt("parse_error").alias("parse_error"),
        cnt("conversion_failed").alias("conversion_failed"),
        cnt("duplicate").alias("duplicate"))
        .withColumn("dropped", F.col("input") - F.col("output")))


def outcome_counts_single_pass(converted: DataFrame, scope: str = "source",
                               parsed: str = "parsed", key: str = "content_key",
                               parse_failed: Column | None = None) -> DataFrame:
    """The same per-scope counts as ``outcome_counts(classify_lines(..))``
    without deciding which copy is first: kept = distinct keys among
    converted rows.  One scan; the ``(scope, key)`` aggregate combines
    map-side, so a hot key costs one row per map task."""
    failed = parse_failed if parse_failed is not None else F.col(parsed).isNull()
    per_key = converted.groupBy(scope, key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(failed).alias("_parse"))
    conv = F.col(key).isNotNull()
    return (per_key.groupBy(scope).agg(
        F.sum("_n").alias("input"),
        F.count_if(conv).alias("output"),
        F.sum("_parse").alias("parse_error"),
        F.sum(F.when(~conv, F.col("_n") - F.col("_parse")).otherwise(F.lit(0))).alias("conversion_failed"),
        F.sum(F.when(conv, F.col("_n") - 1).otherwise(F.lit(0))).alias("duplicate"))
        .withColumn("dropped", F.col("input") - F.col("output")))


def retention_pct(output: Column, inp: Column) -> Column:
    """output / max(input, 1) * 100; NULL (shown as a dash) when input is 0."""
    return F.when(inp > 0, output.cast("double") * 100 / F.greatest(inp, F.lit(1)))


def outcome_summary(counts: DataFrame, scope: str = "source", total_label: str = "Total") -> DataFrame:
    """Per-scope counts plus an overall row (rollup) with retention."""
    rolled = (counts.rollup(scope).agg(
        *[F.sum(c).alias(c) for c in ("input", "output", "dropped", "parse_error", "conversion_failed", "duplicate")],
        F.grouping(scope).alias("_g")))
    return (rolled.withColumn(scope, F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col(scope)))
                  .withColumn("retention_pct", retention_pct(F.col("output"), F.col("input")))
                  .drop("_g"))
