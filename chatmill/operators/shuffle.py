"""Seeded global shuffle by a keyed bijection.

A shuffled order does not need a sort by random keys: a permutation of the
positions ``0 .. n-1`` that can be computed for each row says where it goes.
The permutation is a Feistel network over the grid ``Z_a x Z_b`` (``a * b`` just
above ``n``): each half-round adds a keyed function of one coordinate to the
other, which can be undone, so the whole is a bijection of the grid.  A
position that lands outside ``0 .. n-1`` is walked on along its cycle until it
is inside again; at most ``a`` positions of the grid are outside, about the
square root of ``n``.

Rows need dense positions first (:func:`~.ranking.dense_index` over the light
keys).  Everything is integer arithmetic below 2^63, so the same permutation
can be written in SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import dense_index

HALF_ROUNDS = 8
MULTIPLIER = 1_103_515_245
PRIME = 2_147_483_647
#: positions the network can take: the products in it stay below 2^63
MAX_ROWS = 1 << 60


def round_keys(seed: int, half_rounds: int = HALF_ROUNDS) -> list[int]:
    return [int.from_bytes(hashlib.md5(f"{seed}:{r}".encode()).digest()[:4], "big") % PRIME for r in range(half_rounds)]


def _quotient(x: Column, y: Column) -> Column:
    """Whole quotient of non-negative longs, without a detour through doubles."""
    return F.call_function("div", x, y)


def grid(n: Column) -> tuple[Column, Column]:
    """``a`` and ``b`` with ``a * b`` above ``n`` by at most ``a``."""
    a = F.floor(F.sqrt(n.cast("double"))).cast("long") + 1
    return a, _quotient(n, a) + 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _mixed(x: Column, key: Column) -> Column:
    y = (x * F.lit(MULTIPLIER).cast("long") + key) % F.lit(PRIME).cast("long")
    return (y * y + key) % F.lit(PRIME).cast("long")


def _network(p: Column, a: Column, b: Column, keys: list[int]) -> Column:
    """All half-rounds: ``u`` of ``Z_mu`` takes the keyed function of ``v``, then they change places."""
    start = F.struct(_quotient(p, b).alias("u"), (p % b).alias("v"), a.alias("mu"), b.alias("mv"))
    step = lambda s, k: F.struct(s["v"].alias("u"), ((s["u"] + _mixed(s["v"], k)) % s["mu"]).alias("v"), s["mv"].alias("mu"), s["mu"].alias("mv"))
    return F.aggregate(F.array(*[F.lit(k).cast("long") for k in keys]), start, step, lambda s: s["u"] * s["mv"] + s["v"])


def permuted(position: Column, n: Column, seed: int) -> Column:
    """Place of dense ``position`` (0 .. n-1) in the shuffled order of ``n``
    rows: another number of 0 .. n-1, each once."""
    keys = round_keys(seed)
    a, b = grid(n)
    # most rows are inside after one application; only the others walk on, for as many steps as there are places outside
    walk = lambda p: F.aggregate(F.sequence(F.lit(1).cast("long"), a * b - n), p,
                                 lambda at, _: F.when(at < n, at).otherwise(_network(at, a, b, keys)))
    return _let(_network(position.cast("long"), a, b, keys), lambda p: F.when(p < n, p).otherwise(walk(p)))


def shuffled(df: DataFrame, order: list[str], seed: int, out: str = "position", total: str = "n_rows") -> DataFrame:
    """Adds ``out``, the row's place in the seeded shuffled order, and
    ``total``, the number of rows.  ``order`` must be unique: it makes the
    shuffle independent of partitions and input order.  Give it the light keys
    only, and join the payload afterwards."""
    indexed = dense_index(df, order, out="_cm_index", total=total)
    return indexed.withColumn(out, permuted(F.col("_cm_index"), F.col(total), seed)).drop("_cm_index")


def prefix_split(df: DataFrame, ratio: float, position: str = "position", total: str = "n_rows", out: str = "split") -> DataFrame:
    """The first ``floor(n * ratio)`` places are ``train``, the rest ``validation``."""
    return df.withColumn(out, F.when(F.col(position) < F.floor(F.col(total) * F.lit(float(ratio))), F.lit("train")).otherwise(F.lit("validation")))


def in_parts(df: DataFrame, rows_per_part: int, position: str = "position", by: list[str] | None = None) -> DataFrame:
    """Rows in shuffled order, ``rows_per_part`` places to a part: adds
    ``part`` (part ``k`` holds the places from ``k * rows_per_part`` on), one
    part to a task and sorted there, so a writer's files are in order.  With
    ``by`` (e.g. the split) a part holds rows of one value only."""
    keys = [*(by or []), "part"]
    numbered = df.withColumn("part", _quotient(F.col(position), F.lit(rows_per_part)))
    return numbered.repartitionByRange(*keys).sortWithinPartitions(*keys, position)
