"""Exact ranks, running totals and dense indexes without a single-partition
window.

* ``within_rank`` answers "is this row among the first ``limit`` of its group
  when ordered by a uniformly distributed hex key?" -- exactly, like
  ``row_number() <= limit`` -- with a histogram of key prefixes (small,
  combined map-side), prefix sums over that histogram, and a real ranking
  only inside the one boundary bucket per group.
* ``running_totals`` computes cumulative sums per group in fixed-width blocks
  of the order column: block totals are small, each block is ranked on its
  own, so no task holds more than one block.
* ``dense_index`` numbers rows 0..n-1 in a given order from a range
  partitioning plus per-partition counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once

# histogram buckets per group = 16 ** BUCKET_HEX_DIGITS
BUCKET_HEX_DIGITS = 4
# broadcast the histogram only below this many rows (groups x buckets)
BROADCAST_ROW_LIMIT = 2_000_000


def _maybe_broadcast(df: DataFrame, bound_rows: int | None) -> DataFrame:
    return F.broadcast(df) if bound_rows is not None and bound_rows <= BROADCAST_ROW_LIMIT else df


def _left_join(left: DataFrame, right: DataFrame, keys: list[str], bound_rows: int | None) -> DataFrame:
    """Left join in which NULL keys meet; the keys stay once."""
    other = {k: f"_cm_k{i}" for i, k in enumerate(keys)}
    right = _maybe_broadcast(right.withColumnsRenamed(other), bound_rows)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()])
    return left.join(right, same, "left").drop(*other.values())


def within_rank(df: DataFrame, groups: list[str], key: str, tiebreak: list[str], limit: Column | None = None,
                out: str = "in_rank", max_groups: int | None = None,
                hex_digits: int = BUCKET_HEX_DIGITS, limit_from_total=None) -> DataFrame:
    """Adds boolean ``out``: rank of the row within ``groups`` ordered by
    ``(key, *tiebreak)`` is <= ``limit``.  ``limit`` must be constant within a
    group; NULL means unlimited.  ``key`` must be a lower-case hex string
    (e.g. md5) so that prefix buckets are even.  ``max_groups`` bounds the
    number of groups: with it the histogram is broadcast when groups x
    buckets is under the limit (a proven bound); without it no hint is given
    and adaptive execution picks the join from the histogram's measured
    size.
    ``limit_from_total`` (instead of ``limit``) derives the limit from the
    group's row count, e.g. ``lambda n: F.floor(n * 0.95)``."""
    b = "_cm_bucket"
    lim = "_cm_limit"
    staged = df.withColumn(b, F.substring(F.col(key), 1, hex_digits))
    if limit_from_total is None:
        staged = staged.withColumn(lim, limit)
        hist = staged.groupBy(*groups, lim, b).agg(F.count(F.lit(1)).alias("_cm_n"))
    else:
        hist = staged.groupBy(*groups, b).agg(F.count(F.lit(1)).alias("_cm_n"))
        hist = hist.withColumn(lim, limit_from_total(F.sum("_cm_n").over(Window.partitionBy(*groups))))
    # prefix sums over the histogram: at most 16 ** hex_digits rows per group
    # (also when there are no groups, as for a global split)
    w = Window.partitionBy(*groups).orderBy(b).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = (hist.withColumn("_cm_cum", F.sum("_cm_n").over(w))
                .withColumn("_cm_before", F.col("_cm_cum") - F.col("_cm_n"))
                .withColumn("_cm_status",
                            F.when(F.col(lim).isNull() | (F.col("_cm_cum") <= F.col(lim)), F.lit(2))
                             .when(F.col("_cm_before") < F.col(lim), F.lit(1))
                             .otherwise(F.lit(0)))
                .select(*groups, b, lim, "_cm_status", "_cm_before"))
    bound = None if max_groups is None else max_groups * 16 ** hex_digits
    if limit_from_total is None:
        staged = staged.drop(lim)
    joined = _left_join(staged, hist, [*groups, b], bound)
    # rows of whole buckets are decided by the histogram alone
    decided = (joined.filter(F.col("_cm_status") != 1)
                     .withColumn(out, F.col("_cm_status") == 2))
    # only the boundary bucket of each group needs a real ranking
    wb = Window.partitionBy(*groups, b).orderBy(F.col(key), *[F.col(t) for t in tiebreak])
    boundary = (joined.filter(F.col("_cm_status") == 1)
                      .withColumn("_cm_rn", F.row_number().over(wb))
                      .withColumn(out, F.col("_cm_rn") + F.col("_cm_before") <= F.col(lim))
                      .drop("_cm_rn"))
    return decided.unionByName(boundary).drop(b, lim, "_cm_status", "_cm_before")


def group_sizes(df: DataFrame, groups: list[str], out: str = "group_rows") -> DataFrame:
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias(out))


# adaptive block width aims at no more than this many blocks per group
TARGET_BLOCKS = 1 << 20


def running_totals(df: DataFrame, groups: list[str], order: str, values: dict[str, Column],
                   block_width: int | None = None, max_blocks: int | None = None) -> DataFrame:
    """Cumulative ``count`` (as ``running_rows``) and cumulative sums of
    ``values`` per group in ``order`` (numeric, unique within a group).

    Blocks are ``floor(order / block_width)``; each block is ranked alone and
    offset by the totals of the blocks before it.  Without a width, one small
    aggregate of the order range picks it so that a group has at most about
    a million blocks (and a block at most ``width`` rows).
    """
    blk = "_cm_block"
    if block_width is None:
        lo, hi = df.agg(F.min(order), F.max(order)).first()
        span = 0 if lo is None else int(hi) - int(lo) + 1
        block_width = max(4096, -(-span // TARGET_BLOCKS))
    staged = df.withColumn(blk, F.floor(F.col(order) / block_width))
    for name, expr in values.items():
        staged = staged.withColumn(f"_cm_v_{name}", expr)
    totals = staged.groupBy(*groups, blk).agg(
        F.count(F.lit(1)).alias("_cm_bn"),
        *[F.sum(f"_cm_v_{n}").alias(f"_cm_bs_{n}") for n in values])
    wprev = Window.partitionBy(*groups).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *groups, blk,
        F.coalesce(F.sum("_cm_bn").over(wprev), F.lit(0)).alias("_cm_off_n"),
        *[F.coalesce(F.sum(f"_cm_bs_{n}").over(wprev), F.lit(0)).alias(f"_cm_off_{n}") for n in values])
    joined = _left_join(staged, offsets, [*groups, blk], max_blocks)
    wlocal = (Window.partitionBy(*groups, blk).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = joined.withColumn("running_rows", F.col("_cm_off_n") + F.count(F.lit(1)).over(wlocal))
    for n in values:
        out = out.withColumn(f"running_{n}", F.col(f"_cm_off_{n}") + F.sum(f"_cm_v_{n}").over(wlocal))
    drop = [blk, "_cm_off_n"] + [f"_cm_off_{n}" for n in values] + [f"_cm_v_{n}" for n in values]
    return out.drop(*drop)


def dense_index(df: DataFrame, order: list[str], out: str = "row_index",
                partitions: int | None = None, total: str | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (unique), computed without a
    global window: range-partition, sort within partitions, then add the row
    count of all earlier partitions (a table of one row per partition).
    ``total`` names a column for the number of all rows."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_cm_mid", F.monotonically_increasing_id()))
    ranged = (ranged.withColumn("_cm_pid", F.shiftright(F.col("_cm_mid"), 33))
                    .withColumn("_cm_local", F.col("_cm_mid").bitwiseAND(F.lit((1 << 33) - 1)))
                    .drop("_cm_mid"))
    # counts and rows must come from one evaluation: range bounds are sampled,
    # and a second evaluation would cut elsewhere
    ranged = write_once(ranged, "dense-index")
    counts = ranged.groupBy("_cm_pid").agg(F.count(F.lit(1)).alias("_cm_pn"))
    wprev = Window.orderBy("_cm_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_cm_pid", F.coalesce(F.sum("_cm_pn").over(wprev), F.lit(0)).alias("_cm_poff"),
                            *([F.sum("_cm_pn").over(Window.partitionBy()).alias(total)] if total else []))
    # one row per partition: a proven small broadcast
    return (ranged.join(F.broadcast(offsets), "_cm_pid")
                  .withColumn(out, F.col("_cm_poff") + F.col("_cm_local"))
                  .drop("_cm_pid", "_cm_local", "_cm_poff"))
