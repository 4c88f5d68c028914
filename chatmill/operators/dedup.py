"""First-occurrence deduplication.

The first row of each ``(scope, key)`` group is found with an aggregate
(``min(order)``), not a window: the aggregate combines map-side, so a key
holding a third of all rows costs one row per map task in the shuffle, where
a window would sort the whole hot group in one task.  The winners are then
matched back on the unique order column, whose hash spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chat import content_hash


def with_content_key(df: DataFrame, messages: str = "messages", out: str = "content_key") -> DataFrame:
    return df.withColumn(out, F.when(F.col(messages).isNotNull(), content_hash(messages)))


def first_orders(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key group: the smallest ``order`` and the group size."""
    return df.groupBy(*keys).agg(F.min(order).alias(order), F.count(F.lit(1)).alias("group_rows"))


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows that come first (smallest unique ``order``) within their key group.
    Rows with a NULL key are kept.  Two passes over ``df``: the key
    aggregate and one join on ``order``."""
    firsts = (first_orders(df.select(*keys, order), keys, order)
              .filter(F.col(keys[-1]).isNotNull())
              .select(order, F.lit(True).alias("_cm_first")))
    joined = df.join(firsts, order, "left")
    return joined.filter(F.col("_cm_first") | F.col(keys[-1]).isNull()).drop("_cm_first")


def flag_duplicates(df: DataFrame, keys: list[str], order: str, out: str = "is_duplicate") -> DataFrame:
    """Adds ``out``: TRUE for every row after the first of its key group,
    NULL where the key is NULL."""
    firsts = (first_orders(df.select(*keys, order), keys, order)
              .filter(F.col(keys[-1]).isNotNull())
              .select(order, F.lit(True).alias("_cm_first")))
    flagged = df.join(firsts, order, "left")
    return flagged.withColumn(
        out, F.when(F.col(keys[-1]).isNotNull(), F.col("_cm_first").isNull())).drop("_cm_first")


def duplicate_groups(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Key groups with more than one row, their size and first ``order``."""
    return first_orders(df.select(*keys, order), keys, order).filter(F.col("group_rows") > 1)
