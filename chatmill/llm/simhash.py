"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints within ``max_bits`` of each other agree on at least one of
``max_bits + 1`` equal blocks of their bits.  Each distinct fingerprint is
dealt once per block, rotated so that this block leads; the leading bits are
the top of the hierarchy.  A group that holds more than ``hot`` fingerprints
is dealt again by blocks of its remaining bits (the pair still agrees on one
of them), as often as needed, so no group grows with the data and no pair is
lost.  Within a group, fingerprints are sorted by Gray rank, which puts codes
of few differences side by side; runs of them become nodes that hold the bits
all members share (mask and pattern).  Pairs of nodes whose shared bits
already differ in more than ``max_bits`` places are pruned with all that is
below; differences accumulate from level to level, and what is left at the
leaves is compared in full.  A group returns its links as stars, not as
pairs; components follow from those.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import free_name, map_arrow, number_rows, rows_of, staged, text_bytes, with_row_id
from .components import components

BITS = 64
HOT = 2048
LEAF, NODE = 8, 64


def fingerprint(data: bytes, shingle_words: int = 3, block: int = 1 << 18) -> int:
    """SimHash of a text: a bit is 1 if more than half the shingles' hashes
    have it.  Words are split at ASCII white space, repeats count, a text of
    fewer words is one shingle, a text of none gives 0."""
    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, block):
        part = words[at:at + block + shingle_words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle_words)))) if n > 1 or len(words) >= shingle_words else [b" ".join(words)]
        hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(42)), np.uint64)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """One row per row of ``docs`` (_row, doc_id, text): _row, doc_id, fp (signed 64 bits).  NULL text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle_words) for x in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["_row", "doc_id", "fp"])

    rows = docs.select("_row", F.col("doc_id").cast("long"), text_bytes().alias("data"))
    return map_arrow(rows, run, "_row long, doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """The position of a code in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _dealt(rows: DataFrame, fixed: int, blocks: int) -> DataFrame:
    """Deal each row once per block of the bits after the first ``fixed``,
    rotating these so that the block comes first.  The leading bits so fixed,
    and the path of blocks, are the group."""
    rest = BITS - fixed
    width, mask = rest // blocks, (1 << rest) - 1
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask
    low = F.col("code").bitwiseAND(F.lit(mask))
    turned = [F.shiftleft(low, i * width).bitwiseOR(F.shiftrightunsigned(low, rest - i * width)).bitwiseAND(F.lit(mask)) if i else low for i in range(blocks)]
    high = F.col("code").bitwiseAND(F.lit(~mask))
    copies = F.array(*(F.struct((F.col("path") * (blocks + 1) + i + 1).alias("path"), high.bitwiseOR(t).alias("code")) for i, t in enumerate(turned)))
    return (rows.select("fp", F.explode(copies).alias("c")).select("fp", "c.path", "c.code")
            .withColumn("top", F.shiftrightunsigned("code", rest - width)))


def _runs(group: np.ndarray, parent: np.ndarray, size: int) -> np.ndarray:
    """Starts of runs of at most ``size`` that stay within ``parent`` runs."""
    place = np.arange(len(group)) - parent[np.searchsorted(parent, np.arange(len(group)), "right") - 1]
    return np.flatnonzero(place % size == 0)


def _shared(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits that all of a run's codes share, and these bits."""
    every, some = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    mask = ~(every ^ some)
    return mask, every & mask


def _expand(a, b, starts, ends, fan):
    """Child pairs of the node pairs (a, b); for a node with itself, each pair once."""
    for i in range(fan):
        x = starts[a] + i
        for j in range(fan):
            y = starts[b] + j
            yield x, y, (x < ends[a]) & (y < ends[b]) & ((a != b) | (x <= y))


def linked_pairs(group: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of codes of one group within ``max_bits``; the
    codes come sorted by group and Gray rank."""
    n = len(codes)
    tops = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    nodes = _runs(group, tops, NODE)
    leaves = _runs(group, nodes, LEAF)
    levels = [(nodes, *_shared(codes, nodes)), (leaves, *_shared(codes, leaves)), (np.arange(n), np.full(n, ~np.uint64(0)), codes)]
    node_group = group[nodes]
    found_a, found_b = [], []
    for apart in range(len(nodes)):
        a = np.flatnonzero(node_group[apart:] == node_group[:len(nodes) - apart])
        if not len(a):
            break
        b = a + apart
        mask = levels[0][1][a] & levels[0][1][b]
        acc = np.bitwise_count((levels[0][2][a] ^ levels[0][2][b]) & mask).astype(np.int64)
        keep = acc <= max_bits
        a, b, mask, acc = a[keep], b[keep], mask[keep], acc[keep]
        for upper, (starts, masks, patterns), fan in ((nodes, levels[1], NODE // LEAF), (leaves, levels[2], LEAF)):
            first = np.searchsorted(starts, upper)
            last = np.r_[first[1:], len(starts)]
            parts = []
            for x, y, valid in _expand(a, b, first, last, fan):
                x, y, old, so_far = x[valid], y[valid], mask[valid], acc[valid]
                both = masks[x] & masks[y]
                now = so_far + np.bitwise_count((patterns[x] ^ patterns[y]) & both & ~old)
                ok = now <= max_bits
                parts.append((x[ok], y[ok], both[ok], now[ok]))
            a, b, mask, acc = (np.concatenate(p) for p in zip(*parts))
        other = a != b
        found_a.append(a[other])
        found_b.append(b[other])
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (np.zeros(0, np.int64),) * 2


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each position the smallest one linked with it, directly or not."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _index(max_bits: int, block: int = 1 << 16):
    def links(path, top, code, fp):
        group = np.cumsum(np.r_[True, (path[1:] != path[:-1]) | (top[1:] != top[:-1])])
        a, b = linked_pairs(group, code, max_bits)
        root = _stars(len(code), a, b)
        member = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fp[member]), pa.array(fp[root[member]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.int64)]
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new[2] = new[2].view(np.uint64)
            held = [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]) < block:
                continue
            end = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))
            if len(end):  # the last group may go on in the next batch
                cut = int(end[-1]) + 1
                yield links(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield links(*held)

    return run


def links(codes: DataFrame, max_bits: int = 3, hot: int = HOT) -> DataFrame:
    """``codes``: distinct ``fp`` (signed 64 bits).  Returns links (u, v) that
    connect exactly the fingerprints connected by pairs within ``max_bits``."""
    blocks = max_bits + 1
    rows = codes.select("fp", F.lit(0).cast("long").alias("path"), F.col("fp").alias("code"))
    fixed, found = 0, None
    while True:
        width = (BITS - fixed) // blocks
        dealt = _dealt(rows, fixed, blocks)
        fixed += width
        last = BITS - fixed <= 11
        if last:
            cold = dealt
        else:
            large = staged(dealt.groupBy("path", "top").count().filter(F.col("count") > hot).select("path", "top"), "hot-groups")
            hot_groups = large.count()
            cold = dealt.join(large, ["path", "top"], "left_anti") if hot_groups else dealt
        ordered = (cold.repartition("path", "top").withColumn("rank", gray_rank(F.col("code")))
                   .sortWithinPartitions("path", "top", "rank").select("path", "top", "code", "fp"))
        out = staged(map_arrow(ordered, _index(max_bits), "u long, v long"), "fingerprint-links")
        found = out if found is None else found.unionByName(out)
        if last or not hot_groups:
            return found
        rows = staged(dealt.join(large, ["path", "top"], "left_semi").select("fp", "path", "code"), "hot-rows")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, hot: int = HOT, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``_row, doc_id, fingerprint`` (16 hex
    digits) and ``component_id``, the smallest doc_id reachable over links of
    at most ``max_bits`` differing bits (NULL if all of them are NULL), and
    ``kept``: the one row of each component that stays, the smallest doc_id's
    (then the first row).  An empty table gives no rows.  ``row`` names a
    column of written row numbers; without it the one pass over ``docs`` makes
    and writes them."""
    docs = rows_of(docs, row) if row else number_rows(docs.select("doc_id", "text"))
    rows = staged(fingerprints(docs, shingle_words), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "_row"))
    codes = staged(rows.groupBy("fp").agg(least.alias("least")), "codes")
    roots = components(links(codes.select("fp"), max_bits, hot)).select(F.col("node").alias("fp"), "root")
    rooted = staged(codes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"), "rooted")
    first = staged(rooted.groupBy("root").agg(F.min("least").alias("first")), "components")
    of = staged(rooted.select("fp", "root").join(first, "root").select("fp", "first"), "component-of")
    return rows.join(of, "fp").select(
        "_row", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"),
        (F.col("_row") == F.col("first._row")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component; all columns stay."""
    row = free_name(docs, "_simhash_row")
    rows = with_row_id(docs, row)
    gone = near_duplicates(rows, row=row, **options).filter("NOT kept").select(F.col("_row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)
