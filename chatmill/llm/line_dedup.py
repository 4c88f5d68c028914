"""Near-duplicate lines by a segment-partition edit join.

Lines are linked if their edit distance is at most ``THRESHOLD``.  A line is
split into THRESHOLD + 1 segments; a line within the threshold of it holds at
least one of them as a substring, at a place that the lengths of both narrow
down to a few (multi-match-aware selection).  Each different line sends the
hashes of its segments, and of its substrings that could be segments of a
line of its length or up to THRESHOLD shorter; lines that meet are verified
with a banded bit-parallel edit distance.  Where more than ``HOT`` lines meet,
they are compared in blocks of ``BLOCK`` that return their clusters instead of
pairs; no link between clusters is lost.  Of each class of linked lines the
first occurrence (smallest doc_id, row, line) stays.

Lines under ``MIN_CHARS`` characters are linked only if they are equal: two
edits would turn them into other words.  Blank lines are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .bpe import texts_of
from .common import free_name, map_arrow, rows_of, staged, with_row_id
from .components import components

THRESHOLD = 2
MIN_CHARS = 20
HOT = 64
BLOCK = 2000
BITMAP = 1 << 26
_WORD = 64
_MASK = (1 << _WORD) - 1


def line_id(line: str, seed: int) -> int:
    """Signed 64 bits."""
    h = xxh64_intdigest(line.encode("utf-8", "replace"), seed)
    return h - (1 << 64) if h >> 63 else h


def lines_of(text: str) -> list[tuple[int, str]]:
    """Number and content of the lines that are not blank, white space at the ends off."""
    return [(i, s) for i, line in enumerate(text.split("\n")) if (s := line.strip())]


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """Start and size of each part; the last ones are longer by one where it does not divide."""
    size, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        n = size + (i >= parts - longer)
        out.append((at, n))
        at += n
    return out


def substrings(length: int, own: int, threshold: int) -> list[tuple[int, int, int]]:
    """(segment, start, size): where a line of ``own`` characters may hold
    segments of a line of ``length`` <= own characters."""
    apart, out = own - length, []
    for i, (at, n) in enumerate(segments(length, threshold + 1)):
        low = max(0, at - i, at + apart - (threshold - i))
        high = min(own - n, at + i, at + apart + (threshold - i))
        out += [(i, start, n) for start in range(low, high + 1)]
    return out


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance is at most ``k``: a band of diagonals in one
    machine word, moved down by one row with each character."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > k:
        return False
    start = next((i for i in range(0, len(b), 32) if a[i:i + 32] != b[i:i + 32]), len(b))
    while start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if not b:
        return len(a) <= k
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    plus, minus, distance = (_MASK << (_WORD - k - 1)) & _MASK, 0, k
    down, across, shift = 1 << _WORD - 1, 1 << _WORD - 2, k + 1 - _WORD
    worst = 2 * k + len(b) - len(a)  # what the last rows can still mend
    for j, c in enumerate(b):
        at = places.get(c, 0)
        equal = (at >> shift if shift >= 0 else at << -shift) & _MASK
        diagonal = ((((equal & plus) + plus) ^ plus) | equal | minus) & _MASK
        up = (minus | ~(diagonal | plus)) & _MASK
        low = diagonal & plus
        if j < len(a) - k:
            distance += not diagonal & down
        else:
            distance += bool(up & across) - bool(low & across)
            across >>= 1
        if distance > worst and distance > 2 * k:
            return False
        half = diagonal >> 1
        plus = (low | ~(half | up)) & _MASK
        minus = half & up
        shift += 1
    return distance <= k


def _hash(length: int, segment: int, part: str) -> int:
    return xxh64_intdigest(part.encode("utf-8", "replace"), length * 64 + segment)


def _occurrences(docs: DataFrame, seed: int) -> DataFrame:
    """``_row, doc_id, line_no, line, check`` of every line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r, d, i, line_id(s, seed), line_id(s, seed + 1)) for r, d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)))
                    for i, s in lines_of(t)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], names=["_row", "doc_id", "line_no", "line", "check"])

    return map_arrow(_bytes(docs), run, "_row long, doc_id long, line_no int, line long, check long")


def _bytes(docs: DataFrame) -> DataFrame:
    return docs.select("_row", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data"))


def _entries(docs: DataFrame, seed: int, threshold: int, min_chars: int) -> DataFrame:
    """``key, line, probe``: hashes of segments (probe 0) and of substrings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                keys, ids, probes = [], [], []
                for s in {s for t in texts_of(batch.column(2).slice(at, 1000)) for _, s in lines_of(t) if len(s) >= min_chars}:
                    n = len(s)
                    if n not in cuts:
                        cuts[n] = ([(i, a, k) for i, (a, k) in enumerate(segments(n, threshold + 1))],
                                   [(m, *x) for m in range(max(min_chars, n - threshold), n + 1) for x in substrings(m, n, threshold)])
                    own, probe = cuts[n]
                    keys += [_hash(n, i, s[a:a + k]) for i, a, k in own] + [_hash(m, i, s[a:a + k]) for m, i, a, k in probe]
                    ids += [line_id(s, seed)] * (len(own) + len(probe))
                    probes += [0] * len(own) + [1] * len(probe)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(ids, pa.int64()), pa.array(probes, pa.int8())],
                                                 names=["key", "line", "probe"])

    return map_arrow(_bytes(docs), run, "key long, line long, probe byte")


def _meet(hot: int):
    """From entries sorted by key: ``a, b`` pairs of different lines that meet,
    or, where more than ``hot`` do, ``hot_key`` with each of them as ``a``."""
    def found(key, line, probe):
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        first, last = cut[:-1], cut[1:]
        several = line[first] != line[last - 1]  # sorted by line within a key
        a, b, hot_key = [], [], []
        for s, e in zip(first[several], last[several]):
            lines = np.unique(line[s:e])
            if len(lines) > hot:
                a += lines.tolist()
                b += [None] * len(lines)
                hot_key += [int(key[s])] * len(lines)
                continue
            index, probes = np.unique(line[s:e][probe[s:e] == 0]).tolist(), np.unique(line[s:e][probe[s:e] == 1]).tolist()
            pairs = {(min(x, y), max(x, y)) for x in index for y in probes if x != y}
            a += [x for x, _ in pairs]
            b += [y for _, y in pairs]
            hot_key += [None] * len(pairs)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(hot_key, pa.int64())], names=["a", "b", "hot_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8)]
        for batch in batches:
            held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
            end = np.flatnonzero(held[0][1:] != held[0][:-1])
            if len(end):
                cut = int(end[-1]) + 1
                yield found(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield found(*held)

    return run


def clusters(ids: list[int], texts: list[str], side: list[int], k: int) -> list[tuple[int, int]]:
    """Links that join what pairs within ``k`` join.  ``side`` 0 and 1: two
    blocks, compared with each other and, being one block, each with itself.
    A line is compared with a cluster's members until one is near; these then
    move to the front, as the next line is likely near them too."""
    groups: list[list[int]] = []
    out = []
    for x in range(len(ids)):
        near = []
        for g in groups:
            hit = next((j for j, y in enumerate(g) if abs(len(texts[x]) - len(texts[y])) <= k and within(texts[x], texts[y], k)), None)
            if hit is not None:
                g.insert(0, g.pop(hit))
                out.append((ids[g[0]], ids[x]))
                near.append(g)
        if near:
            keep = near[0]
            for g in near[1:]:
                keep += g
                groups = [h for h in groups if h is not g]
            keep.append(x)
        else:
            groups.append([x])
    return out


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """A bit for each slot that a wanted line falls in: BITMAP / 8 bytes at any
    size of the data.  It keeps most other lines out of the join that follows,
    which decides; as it fills up, more of them reach that join."""
    slot = F.col("line").bitwiseAND(F.lit(BITMAP - 1))
    words = (wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).toArrow())
    out = np.zeros(BITMAP // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def links(docs: DataFrame, seed: int, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """Links (u, v) between different lines that join all lines within the threshold."""
    entries = _entries(docs, seed, threshold, min_chars)
    met = staged(map_arrow(entries.repartition("key").sortWithinPartitions("key", "line"), _meet(hot), "a long, b long, hot_key long"), "lines-met")
    pairs = met.filter("hot_key IS NULL").select("a", "b").distinct()
    crowds = met.filter("hot_key IS NOT NULL").select("hot_key", F.col("a").alias("line")).distinct()
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("line")).unionByName(crowds.select("line")).distinct(), "lines-wanted")

    seen = _bitmap(wanted)

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = list({s for t in texts_of(batch.column(2)) for _, s in lines_of(t) if len(s) >= min_chars})
            ids = np.array([line_id(s, seed) for s in some], np.int64)
            slot = ids.view(np.uint64) & np.uint64(BITMAP - 1)
            likely = (seen[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array(ids[likely]), pa.array([s for s, x in zip(some, likely) if x], pa.string())], names=["line", "content"])

    every = map_arrow(_bytes(docs), contents, "line long, content string")
    texts = staged(every.join(wanted, "line", "left_semi").groupBy("line").agg(F.min("content").alias("content")), "line-texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pa.array([within(x, y, threshold) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield batch.select(["u", "v"]).filter(near)

    both = (pairs.join(texts.select(F.col("line").alias("a"), F.col("content").alias("x")), "a")
            .join(texts.select(F.col("line").alias("b"), F.col("content").alias("y")), "b").select(F.col("a").alias("u"), F.col("b").alias("v"), "x", "y"))
    found = staged(map_arrow(both, verify, "u long, v long"), "line-links")
    # crowds: blocks of lines, each with each
    sizes = crowds.groupBy("hot_key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = crowds.join(sizes, "hot_key").withColumn("own", F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int"))
    dealt = own.select("hot_key", "line", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "hot_key", "line", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.col("own").alias("side"))

    def cluster(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("line").to_pylist(), group.column("content").to_pylist(), group.column("side").to_pylist()))
        out = clusters([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], threshold)
        return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([y for _, y in out], pa.int64())})

    crowded = dealt.join(texts, "line").groupBy("hot_key", "i", "j").applyInArrow(cluster, "u long, v long")
    return found.unionByName(staged(crowded, "crowd-links"))


def line_classes(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, hot: int = HOT, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """``docs``: ``_row`` (written numbers), ``doc_id, text``.  One row per line that is not blank: ``_row, doc_id, line_no, line,
    first`` (doc_id, _row, line_no of its class's first occurrence), ``kept``."""
    lines = staged(_occurrences(docs, seed), "lines")
    first = F.min(F.struct("doc_id", "_row", "line_no")).alias("first")
    known = staged(lines.groupBy("line").agg(first, F.min("check").alias("least"), F.max("check").alias("most")), "line-firsts")
    if not known.filter("least <> most").isEmpty():  # two lines of one hash: take another
        return line_classes(docs, threshold, min_chars, hot, block, seed + 2)
    of = components(links(docs, seed, threshold, min_chars, hot, block)).withColumnRenamed("node", "line")
    linked = known.join(of, "line")
    roots = linked.groupBy("root").agg(F.min("first").alias("class_first"))
    near = staged(linked.join(roots, "root").select("line", "class_first"), "line-classes")
    firsts = staged(known.join(near, "line", "left").select("line", F.coalesce("class_first", "first").alias("first")), "line-class-firsts")
    return lines.drop("check").join(firsts, "line").withColumn("kept", (F.col("first._row") == F.col("_row")) & (F.col("first.line_no") == F.col("line_no")))


def line_report(docs: DataFrame, row: str | None = None, **options) -> DataFrame:
    """One row per row of ``docs``: ``_row, doc_id, n_lines`` (not blank),
    ``n_dropped``, ``dropped`` (line numbers from 0) and ``copies_of`` (doc_ids
    that hold the lines kept instead).

    NULL, empty and blank texts have no lines; the smallest doc_id's occurrence
    stays (NULL is smallest); lines repeated in one document count as copies;
    an empty table gives no rows; other columns are not looked at.  ``row``
    names a column of written row numbers; without it the rows are numbered
    (see ``with_row_id``)."""
    docs = rows_of(docs, row)
    lines = line_classes(docs, **options)
    by_row = lines.groupBy("_row").agg(
        F.count("*").alias("n_lines"), F.count(F.when(~F.col("kept"), 1)).alias("n_dropped"),
        F.array_sort(F.collect_list(F.when(~F.col("kept"), F.col("line_no")))).alias("dropped"),
        F.array_sort(F.collect_set(F.when(~F.col("kept"), F.col("first.doc_id")))).alias("copies_of"))
    rows = docs.select("_row", F.col("doc_id").cast("long").alias("doc_id"))
    none = F.array()
    return rows.join(by_row, "_row", "left").select(
        "_row", "doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        F.coalesce("dropped", none.cast("array<int>")).alias("dropped"), F.coalesce("copies_of", none.cast("array<bigint>")).alias("copies_of"))


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; every row and other column stays."""
    row, dropped = free_name(docs, "_line_row"), free_name(docs, "_dropped")
    rows = with_row_id(docs, row)
    gone = line_report(rows, row, **options).filter("n_dropped > 0").select(F.col("_row").alias(row), F.col("dropped").alias(dropped))
    rows = rows.join(gone, row, "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(dropped, i))
    return rows.withColumn("text", F.when(F.col(dropped).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).select(*docs.columns)
