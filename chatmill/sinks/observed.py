"""Counts taken while rows are written.

The counts that manifests need come from metrics observed on the very rows a
writer writes, so there is no second scan and no cached copy.  The observed
frame feeds the writer directly: Spark counts a partition when its writing
task succeeds, so a retried task is not counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], metrics: dict[str, Column]) -> dict:
    """``write(df)``, returning the values of the aggregate ``metrics`` over the rows written."""
    observation = Observation()
    write(df.observe(observation, *[c.alias(n) for n, c in metrics.items()]))
    return observation.get


def write_counted(df: DataFrame, write: Callable[[DataFrame], None], group: str, values: Sequence, measures: dict[str, Column]) -> dict:
    """``write(df)``, returning for each of ``values`` of ``group`` (a short
    list, such as a registry's sources; NULL may be in it) how many rows
    fulfil each of ``measures``: ``{value: {measure: n}}``.  A row of a group that
    is not listed is an error, raised after the write."""
    listed = [F.col(group).eqNullSafe(F.lit(v)) for v in values]
    any_listed = F.lit(False)
    for own in listed:
        any_listed = any_listed | own
    metrics = {f"{i}|{name}": F.count_if(own & F.coalesce(m, F.lit(False))) for i, own in enumerate(listed) for name, m in measures.items()}
    found = write_observed(df, write, metrics | {"unlisted": F.count_if(~any_listed)})
    if found["unlisted"]:
        raise ValueError(f"{found['unlisted']} rows have a {group} that is not among {list(values)}")
    return {v: {name: found[f"{i}|{name}"] for name in measures} for i, v in enumerate(values)}


def counts_table(spark, counts: dict, group: str) -> DataFrame:
    """The counts as a table, one row per listed value."""
    names = list(next(iter(counts.values()))) if counts else []
    schema = f"{group} string, " + ", ".join(f"{n} long" for n in names)
    return spark.createDataFrame([(v, *c.values()) for v, c in counts.items()], schema)
