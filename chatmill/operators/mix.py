"""Corpus mixing: exact seeded caps, oversampling, validation, seeded shuffle
and an exact prefix split -- all without a single-partition sort.

Random choice is by ``md5(seed:id[:copy])``: deterministic, independent of
partitioning and input order, and expressible in SQL.  The chosen identities
differ from Python's Mersenne Twister (which cannot be reproduced); the
cardinalities are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chat import has_user_and_assistant
from ..sources.registry import RANDOM_SEED, TRAIN_RATIO
from .ranking import BUCKET_HEX_DIGITS, within_rank


def seeded_key(seed: int, *cols) -> Column:
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def cap_per_source(df: DataFrame, config: DataFrame, id_col: str, seed: int = RANDOM_SEED,
                   source: str = "source", n_sources: int | None = None,
                   hex_digits: int = BUCKET_HEX_DIGITS) -> DataFrame:
    """Exact random cap without replacement per source.  ``max_samples``
    NULL or 0 means no cap; a cap >= the source size keeps everything.  A
    source without a config row (NULL included) is not part of the mix.
    ``n_sources``, when the caller knows it (a literal config), proves the
    histogram bound and lets it be broadcast up front; otherwise AQE decides
    from the histogram's measured size at run time."""
    cfg = F.broadcast(config.select(F.col("source").alias(source), "max_samples"))
    staged = df.join(cfg, source).withColumn("_cm_key", seeded_key(seed, id_col))
    limit = F.when(F.col("max_samples") > 0, F.col("max_samples"))
    ranked = within_rank(staged, [source], "_cm_key", [id_col], limit, out="_cm_in",
                         max_groups=n_sources, hex_digits=hex_digits)
    return ranked.filter("_cm_in").drop("_cm_in", "_cm_key", "max_samples")


def oversample(df: DataFrame, config: DataFrame, id_col: str, seed: int = RANDOM_SEED,
               source: str = "source", n_sources: int | None = None,
               hex_digits: int = BUCKET_HEX_DIGITS) -> DataFrame:
    """Weight > 1: every row ``floor(weight)`` times (``copy`` 0..k-1), plus
    ``floor(n * frac)`` distinct rows (seed + 1) as copy k.  Weight <= 1 is a
    no-op (copy 0)."""
    cfg = F.broadcast(config.select(F.col("source").alias(source), "weight"))
    staged = df.join(cfg, source).withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    whole = F.when(F.col("weight") > 1, F.floor("weight")).otherwise(F.lit(1)).cast("int")
    copies = staged.withColumn("copy", F.explode(F.sequence(F.lit(0), whole - 1)))
    frac = lambda: F.col("weight") - F.floor("weight")
    extra = (staged.filter((F.col("weight") > 1) & (frac() > 0))
                   .withColumn("_cm_key", seeded_key(seed + 1, id_col)))
    # the extra count floor(n * frac) comes from the histogram's group total
    extra = within_rank(extra, [source, "weight"], "_cm_key", [id_col], out="_cm_in", max_groups=n_sources,
                        limit_from_total=lambda n: F.floor(n * frac()), hex_digits=hex_digits)
    extra = (extra.filter("_cm_in").withColumn("copy", F.floor("weight").cast("int"))
                  .drop("_cm_in", "_cm_key"))
    return copies.unionByName(extra).drop("weight")


def is_valid_example(messages="messages") -> Column:
    """>= 2 messages, user and assistant present, every role and content
    non-empty."""
    m = F.col(messages) if isinstance(messages, str) else messages
    non_empty = F.forall(m, lambda x: F.coalesce(F.length(x["role"]) > 0, F.lit(False))
                         & F.coalesce(F.length(x["content"]) > 0, F.lit(False)))
    return F.coalesce(m.isNotNull() & (F.size(m) >= 2) & has_user_and_assistant(m) & non_empty, F.lit(False))


def load_stats(sampled: DataFrame, mixed: DataFrame, config: DataFrame, source: str = "source") -> DataFrame:
    """Per source: loaded (after cap and oversampling), valid (after
    validation), invalid, category -- from the light id tables."""
    loaded = sampled.groupBy(source).agg(F.count(F.lit(1)).alias("loaded"))
    valid = mixed.groupBy(source).agg(F.count(F.lit(1)).alias("valid"))
    return (loaded.join(valid, source, "left")
                  .withColumn("valid", F.coalesce("valid", F.lit(0)))
                  .withColumn("invalid", F.col("loaded") - F.col("valid"))
                  .join(F.broadcast(config.select(F.col("source").alias(source), "category")), source, "left"))


# sampled ids are broadcast into the raw scan only below this many rows
IDS_BROADCAST_LIMIT = 1_000_000


def mix_sources(df: DataFrame, config: DataFrame, id_col: str, seed: int = RANDOM_SEED,
                source: str = "source", messages: str = "messages", n_sources: int | None = None,
                materialize: bool = True, return_sampled: bool = False, prepare=None,
                light: DataFrame | None = None):
    """cap -> oversample -> validate; returns ``(source, id, copy)`` of the
    mixed corpus (attach payloads with :func:`attach_payload`), and with
    ``return_sampled`` also the ids before validation (for load stats).

    Sampling runs on the light ``(source, id)`` projection.  Invalid rows
    have already used cap slots, as in the reference.  With ``materialize``
    the capped and the mixed id sets are checkpointed, so the exact-rank
    passes that follow (each reads its input more than once) never
    recompute upstream work.

    ``prepare`` (raw rows -> rows with ``messages``) defers building the
    messages until after sampling: when the checkpointed capped id set is
    small enough (a size check, not a guess) it is broadcast into the raw
    scan, so only sampled rows are converted; otherwise every row is
    validated map-side and matched by a shuffle join.  ``light`` is an
    optional cheaper read of the same rows for the ``(source, id)`` passes.
    """
    from ..session import materialize as _mat
    light = (light if light is not None else df).select(source, id_col)
    capped = cap_per_source(light, config, id_col, seed, source, n_sources)
    if materialize:
        capped = _mat(capped)
    sampled = oversample(capped, config, id_col, seed, source, n_sources)
    cand = df
    if materialize and capped.count() <= IDS_BROADCAST_LIMIT:
        cand = df.join(F.broadcast(capped.select(source, id_col)), [source, id_col], "left_semi")
    if prepare is not None:
        cand = prepare(cand)
    valid = cand.filter(is_valid_example(messages)).select(source, id_col)
    mixed = sampled.join(valid, [source, id_col], "left_semi")
    mixed = _mat(mixed) if materialize else mixed
    return (sampled, mixed) if return_sampled else mixed


def attach_payload(mixed: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """Mixed ids (with copies) -> full rows."""
    return mixed.join(df, keys, "inner")


def exact_split(df: DataFrame, key: Column, tiebreak: list[str], ratio: float = TRAIN_RATIO,
                out: str = "split", by: list[str] | None = None,
                hex_digits: int = BUCKET_HEX_DIGITS) -> DataFrame:
    """Seeded shuffle + exact prefix split: the first ``floor(n * ratio)`` rows
    in ``key`` order are ``train``, the rest ``validation``.

    With ``by`` (e.g. the example id without the copy number) the split is
    made over the distinct ``by`` values -- ``key`` must then depend on
    ``by`` only -- and every copy follows its example, so no example is in
    both splits (``floor(n_ids * ratio)`` ids go to train)."""
    if by:
        ids = df.select(*by).distinct().withColumn("_cm_skey", key)
        ranked = within_rank(ids, [], "_cm_skey", by, out="_cm_in", max_groups=1, hex_digits=hex_digits,
                             limit_from_total=lambda n: F.floor(n * F.lit(float(ratio))))
        side = ranked.select(*by, F.when(F.col("_cm_in"), F.lit("train")).otherwise(F.lit("validation")).alias(out))
        return df.join(side, by, "inner")
    staged = df.withColumn("_cm_skey", key)
    ranked = within_rank(staged, [], "_cm_skey", tiebreak, out="_cm_in", max_groups=1, hex_digits=hex_digits,
                         limit_from_total=lambda n: F.floor(n * F.lit(float(ratio))))
    return (ranked.withColumn(out, F.when(F.col("_cm_in"), F.lit("train")).otherwise(F.lit("validation")))
                  .drop("_cm_in", "_cm_skey"))


def split_leakage(df: DataFrame, ids: list[str], split: str = "split") -> DataFrame:
    """Examples (by id) that landed in more than one split."""
    return (df.groupBy(*ids).agg(F.countDistinct(split).alias("n_splits"), F.count(F.lit(1)).alias("copies"))
              .filter(F.col("n_splits") > 1))


def source_distribution(df: DataFrame, source: str = "source", total_label: str = "Total") -> DataFrame:
    """Count and percent per source, most frequent first, and a Total row last (rollup)."""
    counts = df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    rolled = counts.rollup(source).agg(F.sum("n").alias("count"), F.grouping(source).alias("_g"))
    from pyspark.sql import Window
    # the rolled-up counts have one row per source (+ the total)
    total = F.max(F.when(F.col("_g") == 1, F.col("count"))).over(Window.partitionBy())
    return (rolled.withColumn("percent", F.col("count").cast("double") * 100 / total)
                  .withColumn(source, F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col(source)))
                  .orderBy("_g", F.col("count").desc(), source).drop("_g"))
