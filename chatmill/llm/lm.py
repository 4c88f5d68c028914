"""Language-model scores by deleted interpolation.

    P(w | v) = l2(b) c(vw)/c(v) + l1(b) c(w)/N + l0(b) / (V + 1),   b = bucket of c(v)

The counts come from the training documents.  The weights of each
context-frequency bucket are learned by expectation-maximisation on one tenth
of them, held out, with counts of the other nine tenths.  Tokens are words
and one end per document, which is also the context of the first word;
unseen words share the last term's extra place.

Documents are written in blocks of bounded size.  A block's different words and
word pairs (64-bit hashes, sorted) travel once to the ranges of the hash space,
where the counts of all blocks meet, and the totals travel back to the block
in the same order; there they are put to the documents' tokens.  No task holds
a model, no key is larger than one entry per block, and what is moved grows
with the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import fold_of, map_arrow, staged, text_bytes

BLOCK_TOKENS = 3 << 18
RANGE_BYTES = 8 << 20
TRAIN, TUNE, TEST = 0, 1, 2
END = xxh64_intdigest(b"\n", 1)
STEPS_A_BIT = 4  # probabilities of held-out tokens are binned by quarter powers of two
_Q = 50 * STEPS_A_BIT


def hashes(data: bytes) -> np.ndarray:
    """Hashes of the words, then of the end."""
    words = data.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxh64_intdigest, words, repeat(1)), np.uint64, len(words))
    out[-1] = END
    return out


def pair_hashes(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    x = contexts * np.uint64(0x9E3779B97F4A7C15) + words
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


class Block:
    """Tokens of some documents: word and context hashes, and the different words and pairs, sorted."""

    def __init__(self, texts: list[bytes]):
        each = [hashes(t) for t in texts]
        self.sizes = np.array([len(e) for e in each])
        self.words = np.concatenate(each)
        self.contexts = np.r_[np.uint64(END), self.words[:-1]]  # an end comes before each document
        self.keys, self.place = [], []
        for tokens in (self.words, pair_hashes(self.words, self.contexts)):
            keys, place = np.unique(tokens, return_inverse=True)
            self.keys.append(keys)
            self.place.append(place)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list, list[bytes]]]:
    """(block, part of the data, doc_ids, texts).  A document is never divided.
    The numbers hold for one pass, which is written."""
    part, number = TaskContext.get().partitionId(), 0
    held: dict[int, tuple[list, list, int]] = {k: ([], [], 0) for k in (TRAIN, TUNE, TEST)}
    for batch in batches:
        for doc_id, text, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            ids, texts, n = held[kind]
            ids.append(doc_id)
            texts.append(text)
            held[kind] = ids, texts, n + len(text.split()) + 1
            if held[kind][2] >= BLOCK_TOKENS:
                yield part << 32 | number, kind, ids, texts
                held[kind], number = ([], [], 0), number + 1
    for kind, (ids, texts, _) in held.items():
        if texts:
            yield part << 32 | number, kind, ids, texts
            number += 1


def _give_back() -> None:
    """Return what Arrow holds on to between groups: a worker serves many of
    them, and several stages."""
    pa.default_memory_pool().release_unused()


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(block, part of the data, texts) of the written documents, a block's
    together; a scan that splits a file may give a block in pieces."""
    held, texts = None, []
    for batch in batches:
        for block, kind, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if held != (block, kind) and texts:
                yield *held, texts
                texts = []
            held = block, kind
            texts.append(text)
    if texts:
        yield *held, texts


def _entries(ranges: int):
    """Each block's different words and pairs, cut by ranges of the hash space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
        for block, kind, texts in _written(batches):
            _give_back()
            b = Block(texts)
            for order, (keys, place) in enumerate(zip(b.keys, b.place)):
                counts = np.bincount(place, minlength=len(keys)).astype("<u4")
                cuts = np.r_[0, np.searchsorted(keys, bounds), len(keys)]
                rows = [(r, block, kind, order, keys[s:e].tobytes(), counts[s:e].tobytes()) for r, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])) if e > s]
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["range", "block", "kind", "gram", "keys", "counts"])

    return run


def _values(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    """The numbers in each value of a binary column, not copied."""
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _totals(group: pa.Table) -> pa.Table:
    """Counts over all blocks of one range and order, back to each block."""
    _give_back()
    rows = group.select(["range", "block", "kind", "gram"]).to_pylist()
    keys, counts = _values(group.column("keys"), "<u8"), _values(group.column("counts"), "<u4")
    starts = np.cumsum([0] + [len(k) for k in keys])
    unique, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = []
    for kind in (TRAIN, TUNE):
        total = np.zeros(len(unique), "<u8")  # a block's count has 32 bits, a total may need more
        for r, c, s, e in zip(rows, counts, starts, starts[1:]):
            if r["kind"] == kind:
                total[place[s:e]] += c  # a key is there once
        sums.append(total)
    both = sums[0] + sums[1]
    blocks: dict[int, tuple[dict, list]] = {}
    for r, s, e in zip(rows, starts, starts[1:]):
        blocks.setdefault(r["block"], (r, []))[1].append(place[s:e])
    out = []
    for r, pieces in blocks.values():
        own = pieces[0] if len(pieces) == 1 else np.unique(np.concatenate(pieces))  # in the order of the keys
        out.append((r["range"], r["block"], r["kind"], r["gram"], both[own].tobytes(), sums[0][own].tobytes() if r["kind"] == TUNE else None, None, None, None, None))
    stats = (rows[0]["range"], None, None, rows[0]["gram"], None, None, *(int(x) for s in (both, sums[0]) for x in (np.count_nonzero(s), s.sum(dtype=np.int64))))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, stats), _ARROW)], schema=_ARROW)


_TOTALS = ("range int, block long, kind int, gram int, totals binary, train_totals binary, "
           "types long, tokens long, train_types long, train_tokens long")
_ARROW = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("gram", pa.int32()), ("totals", pa.binary()),
                    ("train_totals", pa.binary()), *((n, pa.int64()) for n in ("types", "tokens", "train_types", "train_tokens"))])


def bucket(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the binary logarithm of its count."""
    return np.frexp(context_count.astype(float))[1]


def _token_counts(texts: list[bytes], totals: list[dict], column: str):
    """Per token: count of the word, of its context, of the pair."""
    b = Block(texts)
    c = []
    for order in (0, 1):
        parts = sorted((r["range"], r[column]) for r in totals if r["gram"] == order)
        c.append(np.frombuffer(b"".join(p for _, p in parts), "<u8").astype(np.int64))
    word = c[0][b.place[0]]
    at = np.searchsorted(b.keys[0], END)
    first = c[0][at]  # every block has an end
    context = np.r_[first, word[:-1]]
    return b, word, context, c[1][b.place[1]]


def _parts(words, contexts, pairs, types: int, tokens: int):
    p2 = np.divide(pairs, contexts, out=np.zeros(len(pairs)), where=contexts > 0)
    p1 = words / max(1, tokens)
    return p2, p1, 1 / (types + 1)


def learn_weights(cells: list[tuple[int, int, int, int]], p0: float, rounds: int = 60) -> np.ndarray:
    """EM over the binned held-out tokens (bucket, bin of p2, bin of p1,
    tokens): weights (l2, l1, l0) of each of 64 buckets.  A bucket without
    held-out tokens gets the weights of all buckets together."""
    def em(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = p * w
            share *= (n / np.maximum(share.sum(axis=1), 1e-300))[:, None]
            w = (share.sum(axis=0) + 1e-3) / (n.sum() + 3e-3)
        return w

    out = np.tile([0.0, 0.5, 0.5], (64, 1))
    if cells:
        b, q2, q1, n = np.array(cells, float).T
        p = np.stack([np.where(q2 > 0, 2.0 ** (-(q2 - 1) / STEPS_A_BIT), 0), np.where(q1 > 0, 2.0 ** (-(q1 - 1) / STEPS_A_BIT), 0), np.full(len(b), p0)], axis=1)
        out[:] = em(p, n)
        for k in np.unique(b).astype(int):
            out[k] = em(p[b == k], n[b == k])
    out[0, 0] = 0  # an unseen context says nothing
    return out / out.sum(axis=1, keepdims=True)


def score(docs: DataFrame, folds: int = 7, held_out: int = 2, tune_every: int = 10) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score``.

    NULL counts as empty: its only token is the end.  A NULL doc_id is a
    training document.  Repeated rows count each for itself.  An empty table
    gives no rows; without training documents every token is unseen.  Other
    columns are not looked at."""
    doc_id = F.col("doc_id").cast("long")
    test = fold_of(doc_id, folds) == held_out
    tune = F.coalesce((F.crc32(F.concat(F.lit("tune"), doc_id.cast("string")).cast("binary")) % tune_every) == 0, F.lit(False))
    rows = docs.select(doc_id.alias("doc_id"), text_bytes().alias("data"), F.when(test, TEST).when(tune, TUNE).otherwise(TRAIN).alias("kind"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(4, math.ceil(size / RANGE_BYTES))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, kind, ids, texts in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(ids), pa.int64()), pa.array([kind] * len(ids), pa.int32()), pa.array(ids, pa.int64()),
                                              pa.array(texts, pa.binary())], names=["block", "kind", "doc_id", "data"])

    placed = staged(map_arrow(rows, place, "block long, kind int, doc_id long, data binary"), "lm-blocks")
    entries = map_arrow(placed.select("block", "kind", "data"), _entries(ranges), "range int, block long, kind int, gram int, keys binary, counts binary")
    totals = staged(entries.groupBy("range", "gram").applyInArrow(_totals, _TOTALS), "lm-totals")
    types, tokens, train_types, train_tokens = (x or 0 for x in totals.filter("block IS NULL AND gram = 0").agg(
        *(F.sum(c) for c in ("types", "tokens", "train_types", "train_tokens"))).first())

    back = totals.filter("block IS NOT NULL")

    def cells(left: pa.Table, right: pa.Table) -> pa.Table:
        _give_back()
        _, word, context, pair = _token_counts(left.column("data").to_pylist(), right.to_pylist(), "train_totals")
        p2, p1, _ = _parts(word, context, pair, train_types, train_tokens)
        with np.errstate(divide="ignore"):
            q2, q1 = (np.where(p > 0, 1 + np.clip(np.rint(-STEPS_A_BIT * np.log2(p)), 0, _Q), 0).astype(np.int64) for p in (p2, p1))
        cell, n = np.unique((bucket(context) * (_Q + 2) + q2) * (_Q + 2) + q1, return_counts=True)
        return pa.table({"cell": cell.astype(np.int64), "n": n.astype(np.int64)})

    binned = (placed.filter(F.col("kind") == TUNE).groupBy("block").cogroup(back.filter(F.col("kind") == TUNE).groupBy("block"))
              .applyInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect())  # at most 64 * 202 * 202 cells
    weights = learn_weights([(c // (_Q + 2) ** 2, c // (_Q + 2) % (_Q + 2), c % (_Q + 2), n) for c, n in binned], 1 / (train_types + 1))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        _give_back()
        if not left.num_rows:
            return _SCORED.empty_table()
        b, word, context, pair = _token_counts(left.column("data").to_pylist(), right.to_pylist(), "totals")
        w = weights[np.minimum(bucket(context), 63)]
        p2, p1, p0 = _parts(word, context, pair, types, tokens)
        starts = np.r_[0, np.cumsum(b.sizes)[:-1]]
        of_doc = lambda x: np.add.reduceat(x, starts)
        base = of_doc(np.log10((word + 1) / (tokens + types + 1)))
        model = of_doc(np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0))
        n = len(starts)
        return pa.Table.from_arrays([left.column("doc_id"), pa.array(np.array(left.column("kind")) == TEST), pa.array(b.sizes), pa.array(of_doc((word > 0).astype(np.int64))),
                                     pa.array([tokens] * n, pa.int64()), pa.array(base), pa.array(model)], schema=_SCORED)

    return placed.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])
