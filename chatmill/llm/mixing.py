"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources.  Documents with the same membership
pattern are exchangeable, so their words are summed by pattern and a flow is
solved over patterns and sources only: each pattern offers its words once at no
cost, a second time at a cost, a third time at a higher one (convex costs), and
each source takes as many as its target.  The flow fills the targets with as
little repetition as can be.

The documents of a pattern stand in a seeded order.  A flow of ``x`` words out
of a pattern is a cut of that order: all documents once for each time ``x``
holds the whole pattern, and the first ones up to the rest.  Cuts are found by
sums of hash buckets and a ranking inside the one bucket that a cut falls into.
What the last cut leaves open, because the next document is too long, goes to
the next documents that fit, again in order, and at last to the shortest one
left if that brings the source nearer to its target.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 3
#: a source may miss its target by this part; less is not worth another pass
TOLERANCE = 0.001
#: the plan has one row for each membership pattern; it lies in the driver and is broadcast
MAX_PATTERNS = 100_000

Source = tuple[bool, str]  # (no name, name): names by code point, then the documents without a source


def capped_targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = MAX_REPEATS) -> list[float]:
    """``total`` dealt by weight; no target is more than ``most`` times its
    size, and what that leaves over is dealt among the others again."""
    targets, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in sorted(open_))
        over = {i for i in open_ if left * weights[i] / weight > most * sizes[i]} if weight else set(open_)
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in sorted(over):
            targets[i] = float(most * sizes[i]) if weight else 0.0
            left -= targets[i]
        open_ -= over
    return targets


def min_cost_flow(patterns: Sequence[tuple[Sequence[int], int]], targets: Sequence[int], repeats: int = MAX_REPEATS) -> list[dict[int, int]]:
    """``patterns``: (sources, words).  How many words of each pattern go to
    each source, so that the targets are filled as far as can be and the words
    given again cost least: ``k`` for the ``k``-th repetition of a pattern.

    Shortest augmenting paths; the cost of a path is what the repetitions it
    begins cost."""
    start, end = len(patterns) + len(targets), len(patterns) + len(targets) + 1
    to, room, cost, out = [], [], [], [[] for _ in range(end + 1)]

    def arc(a: int, b: int, capacity: int, price: int) -> int:
        for u, v, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            out[u].append(len(to))
            to.append(v)
            room.append(c)
            cost.append(p)
        return len(to) - 2

    routes = []
    for p, (sources, words) in enumerate(patterns):
        for k in range(repeats):
            arc(start, p, words, k)
        routes.append({s: arc(p, len(patterns) + s, repeats * words, 0) for s in sources})
    for s, words in enumerate(targets):
        arc(len(patterns) + s, end, words, 0)
    while True:
        far, by, queue, waits = [None] * (end + 1), [0] * (end + 1), deque([start]), [False] * (end + 1)
        far[start] = 0
        while queue:
            u = queue.popleft()
            waits[u] = False
            for e in out[u]:
                if room[e] and (far[to[e]] is None or far[u] + cost[e] < far[to[e]]):
                    far[to[e]], by[to[e]] = far[u] + cost[e], e
                    if not waits[to[e]]:
                        waits[to[e]] = True
                        queue.append(to[e])
        if far[end] is None:
            return [{s: room[e ^ 1] for s, e in r.items()} for r in routes]
        path, v = [], end
        while v != start:
            path.append(by[v])
            v = to[by[v] ^ 1]
        most = min(room[e] for e in path)
        for e in path:
            room[e] -= most
            room[e ^ 1] += most


@dataclass
class Pattern:
    """One membership pattern's part of the plan."""

    sources: list[Source]
    words: int
    rows: int
    flow: dict[int, int] = field(default_factory=dict)
    #: (source, layer, bucket, key) of the last document of each source's share
    cuts: list[tuple[int, int, int, int]] = field(default_factory=list)
    #: (words left open, bucket, key): documents of at most so many words up to here, not taken yet, are taken too
    fills: list[tuple[int, int, int]] = field(default_factory=list)
    gap: int = 0
    #: words left open that no document fits: the shortest one left comes too if it ends nearer to the target
    over: int = 0

    @property
    def taken(self) -> int:
        return sum(self.flow.values())

    @property
    def buckets(self) -> int:
        """As many as a bucket has rows, so neither is many."""
        return max(1, round(self.rows ** 0.5))


_LEAST = -(1 << 63)
_PLAN = ("pid int, buckets int, last_layer int, cuts array<struct<at:struct<layer:int, bucket:int, key:long>, source:int>>, "
         "fills array<struct<need:long, at:struct<bucket:int, key:long>>>, gap long")


def _plan_rows(patterns: list[Pattern]) -> list[tuple]:
    return [(i, p.buckets, p.cuts[-1][1] if p.cuts else 0, [((layer, b, k), s) for s, layer, b, k in p.cuts], [(n, (b, k)) for n, b, k in p.fills], p.gap) for i, p in enumerate(patterns)]


def _placed(rows: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """Rows with their bucket, and ``extra``: whether the rest of the last cut was filled with them."""
    plan = rows.sparkSession.createDataFrame(_plan_rows(patterns), _PLAN)
    rows = rows.join(F.broadcast(plan), "pid").withColumn("bucket", F.pmod("key", "buckets").cast("int"))
    before = F.exists("cuts", lambda c: F.struct(F.col("last_layer").alias("layer"), "bucket", "key") <= c["at"])
    filled = F.exists("fills", lambda f: (F.col("size") <= f["need"]) & (F.struct("bucket", "key") <= f["at"]))
    return rows.withColumn("extra", ~before & filled).withColumn("within", before)


def _cut(rows: DataFrame, needs: DataFrame) -> list:
    """``rows`` (pid, bucket, key, size), ``needs`` (pid, cut, need): for each
    cut the last bucket and key so that the documents up to there have at most
    ``need`` words, and how many they have.  None within the bucket: the key is
    the least there is."""
    sums = rows.groupBy("pid", "bucket").agg(F.sum("size").alias("words"))
    ahead = F.sum("words").over(Window.partitionBy("pid").orderBy("bucket"))  # as many rows as a bucket has
    sums = sums.withColumn("upto", ahead).withColumn("before", F.col("upto") - F.col("words"))
    # the bucket the cut falls into; the last one if the cut is past the end
    last = F.max("upto").over(Window.partitionBy("pid"))
    hit = (sums.withColumn("all", last).join(F.broadcast(needs), "pid")
           .filter((F.col("before") < F.col("need")) & ((F.col("upto") >= F.col("need")) | (F.col("upto") == F.col("all")) & (F.col("words") > 0)))
           .select("pid", "cut", "need", "bucket", "before"))
    hit = staged(hit, "mix-buckets")
    ranked = rows.join(hit, ["pid", "bucket"]).withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("pid", "cut").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)))
    inside = ranked.filter("upto <= need").groupBy("pid", "cut").agg(F.max("key").alias("key"), F.max("upto").alias("words"))
    # one row for each route of a pattern
    return hit.join(inside, ["pid", "cut"], "left").select("pid", "cut", "need", "bucket", F.coalesce("key", F.lit(_LEAST)).alias("key"), F.coalesce("words", "before").alias("words")).collect()


@dataclass
class Mix:
    """``rows``: ``doc_id, members, size, pid, taken`` and ``routes`` (source
    number and words, a copy each).  ``sources`` in order, with their sizes and
    targets."""

    rows: DataFrame
    sources: list[Source]
    sizes: list[int]
    targets: list[float]
    patterns: list[Pattern]


def mix(docs: DataFrame, members: Column, weight_of: Callable[[int], float], repeats: int = MAX_REPEATS, seed: int = 42) -> Mix:
    """Choose documents so that source number ``i``, by code point and those
    without a source last, takes its share by ``weight_of(i)`` of all words.

    ``members`` is an array of the sources a document belongs to; a NULL in it
    is the source without a name, a NULL or empty array no source at all: such
    a document is not taken.  A document's size is its number of words (runs of
    other than blanks and line breaks; NULL: 0).  A source's target is at most
    ``repeats`` times its size, and no document is taken more often than that.
    Documents are taken whole.

    Repeated rows and ids are documents of their own (equal rows are numbered,
    so reruns agree); ties in the seeded order cannot be told apart; an empty
    table gives no rows; a very long document that fits no target is left out;
    columns other than doc_id, text and those of ``members`` are not looked at."""
    spark = docs.sparkSession
    named = F.array_sort(F.array_distinct(F.transform(F.coalesce(members, F.array().cast("array<string>")), lambda m: F.struct(m.isNull().alias("none"), F.coalesce(m, F.lit("")).alias("name")))))
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text")
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), named.alias("members"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"))
    each = each.groupBy("doc_id", "members", "size", "key").agg(F.count("*").alias("n")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    light = staged(each.select("doc_id", "members", "size", F.when(F.col("copy") == 1, F.col("key")).otherwise(F.xxhash64("key", "copy")).alias("key")), "mix-rows")

    found = light.groupBy("members").agg(F.sum("size").alias("words"), F.count("*").alias("rows")).orderBy("members").limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns: their plan would not fit into the driver")
    patterns = [Pattern([(m["none"], m["name"]) for m in r["members"]], r["words"], r["rows"]) for r in found]
    sources = sorted({s for p in patterns for s in p.sources}, key=lambda s: (s[0], s[1].encode()))
    number = {s: i for i, s in enumerate(sources)}
    sizes = [0] * len(sources)
    for p in patterns:
        for s in p.sources:
            sizes[number[s]] += p.words
    targets = capped_targets(sizes, [weight_of(i) for i in range(len(sources))], sum(p.words for p in patterns if p.sources), repeats)
    for p, flow in zip(patterns, min_cost_flow([([number[s] for s in p.sources], p.words) for p in patterns], [int(t) for t in targets], repeats)):
        p.flow = flow

    schema = "pid int, members array<struct<none:boolean,name:string>>"
    pids = spark.createDataFrame([(i, r["members"]) for i, r in enumerate(found)], schema)
    rows = light.join(F.broadcast(pids), "members")

    # where each source's share of a pattern ends
    needs = []
    for i, p in enumerate(patterns):
        upto = 0
        for s in sorted(p.flow):
            if p.flow[s]:
                upto += p.flow[s]
                p.cuts.append((s, upto // p.words, -1, _LEAST))
                needs.append((i, len(p.cuts) - 1, upto % p.words))
    asked = spark.createDataFrame([n for n in needs if n[2]], "pid int, cut int, need long")
    for r in _cut(_placed(rows, patterns), asked):
        p = patterns[r["pid"]]
        s, layer, _, _ = p.cuts[r["cut"]]
        p.cuts[r["cut"]] = s, layer, r["bucket"], r["key"]
        if r["cut"] == len(p.cuts) - 1:
            p.gap = r["need"] - r["words"]
    while any(p.gap > TOLERANCE * p.taken for p in patterns):
        asked = spark.createDataFrame([(i, 0, p.gap) for i, p in enumerate(patterns) if p.gap > TOLERANCE * p.taken], "pid int, cut int, need long")
        open_ = _placed(rows, patterns).filter("NOT within AND NOT extra AND size > 0 AND size <= gap")
        steps = {r["pid"]: r for r in _cut(open_, asked)}
        for i, p in enumerate(patterns):
            if p.gap > TOLERANCE * p.taken:
                if i in steps:
                    p.fills.append((p.gap, steps[i]["bucket"], steps[i]["key"]))
                    p.gap -= steps[i]["words"]
                else:
                    p.over, p.gap = p.gap, 0  # nothing fits any more
    asked = spark.createDataFrame([(i, 2 * p.over) for i, p in enumerate(patterns) if p.over], "pid int, under long")
    least = _placed(rows, patterns).filter("NOT within AND NOT extra").join(F.broadcast(asked), "pid").filter("size < under").groupBy("pid").agg(F.min(F.struct("size", "bucket", "key")).alias("least"))
    for r in least.collect() if any(p.over for p in patterns) else []:
        patterns[r["pid"]].fills.append((r["least"]["size"], r["least"]["bucket"], r["least"]["key"]))

    placed = _placed(rows, patterns)
    layers = F.array(*[F.lit(k) for k in range(repeats)])
    routes = F.filter(F.transform(layers, lambda k: F.get(F.filter("cuts", lambda c: F.struct(k.alias("layer"), "bucket", "key") <= c["at"]), F.lit(0))["source"]), lambda s: s.isNotNull())
    routes = F.when(F.col("extra"), F.concat(routes, F.array(F.try_element_at("cuts", F.lit(-1))["source"]))).otherwise(routes)
    out = placed.select("doc_id", "members", "size", "pid", F.transform(routes, lambda s: F.struct(s.alias("source"), F.col("size").alias("words"))).alias("routes"))
    return Mix(out.withColumn("taken", F.col("size") * F.size("routes")), sources, sizes, targets, patterns)


def mixed_documents(docs: DataFrame, source: str = "source", weights: Sequence[float] = (5, 2, 1), repeats: int = MAX_REPEATS, seed: int = 42) -> DataFrame:
    """:func:`mix` where each document has one source: ``doc_id, size,
    source_size, target, taken``.  The weights repeat over the sources."""
    found = mix(docs, F.array(F.col(source).cast("string")), lambda i: weights[i % len(weights)], repeats, seed)
    of = [(none, name, size, target) for (none, name), size, target in zip(found.sources, found.sizes, found.targets)]
    table = docs.sparkSession.createDataFrame(of, "none boolean, name string, source_size long, target double")
    own = F.col("members")[0]
    rows = found.rows.withColumn("none", own["none"]).withColumn("name", own["name"])
    return rows.join(F.broadcast(table), ["none", "name"]).select("doc_id", "size", "source_size", "target", "taken")
