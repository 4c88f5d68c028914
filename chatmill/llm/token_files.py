"""Token-id files compressed by Re-Pair grammars.

Documents go in ascending doc_id order into shards of about ``shard_ids`` ids.
Each shard has a grammar of its own: again and again, the pairs of
neighbouring ids that occur most become nonterminals, until no pair occurs
twice.  A shard is one row of a Parquet table, so the files can lie wherever
Spark writes:

    part, shard     place in the order
    doc_ids, sizes  int64 each, of its documents (a NULL doc_id as the least int64)
    base            first nonterminal
    rules           uint32 pairs: what nonterminal base + i stands for
    lengths         uint32: ids that nonterminal base + i expands to
    sequence        uint32: ids and nonterminals
    n_ids           ids after expansion

The lengths give random access: a document is decoded from the symbols that
cover it, without the rest of the shard.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import codec, texts_of
from .common import map_arrow, staged

SHARD_IDS = 1 << 20
SLICE_BYTES = 1 << 23
NULL_ID = -(1 << 63)
_FIELDS = ("part", "shard", "doc_ids", "sizes", "base", "rules", "lengths", "sequence", "n_ids")
_SHARD = "part int, shard int, doc_ids binary, sizes binary, base int, rules binary, lengths binary, sequence binary, n_ids long"


def _joined_odd(at: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Of places in a row with one pair, which overlap, every other one from the second."""
    joined = np.flatnonzero((at[1:] - at[:-1] == 1) & (pair[1:] == pair[:-1])) + 1
    if not len(joined):
        return joined
    new = np.r_[True, joined[1:] - joined[:-1] != 1]
    return joined[(joined - joined[new][np.cumsum(new) - 1]) & 1 == 0]


def _numbered(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs, ascending, and the number of each place's pair."""
    symbol, place = (int(x).bit_length() for x in (max(left.max(), right.max()), len(left)))
    if 2 * symbol + place <= 64:  # pair and place in one word sort several times faster than by argsort
        key = left.astype(np.uint64)
        key <<= np.uint64(symbol)
        key |= right
        key <<= np.uint64(place)
        key |= np.arange(len(left), dtype=np.uint64)
        key.sort()
        order, ranked = (key & np.uint64((1 << place) - 1)).view(np.int64), key >> np.uint64(place)
    else:
        symbol, pair = 32, left.astype(np.uint64) << np.uint64(32) | right
        order = np.argsort(pair)
        ranked = pair[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    number = np.empty(len(order), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    found = ranked[new]
    return np.stack([found >> np.uint64(symbol), found & np.uint64((1 << symbol) - 1)], axis=1).astype(np.uint32), number


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids to (rules, lengths, sequence); in the end no pair occurs twice
    without overlap.  Each round counts the pairs exactly and replaces a pair
    wherever no pair it overlaps occurs more often, so the most frequent pair
    goes everywhere.  A pair that occurs once will not occur twice later, unless
    one of its symbols is put in again: its places are not counted till then."""
    sequence, rules, lengths = ids.astype(np.uint32), [np.zeros((0, 2), np.uint32)], np.ones(base, np.uint32)
    live = np.ones(len(sequence), bool)  # places whose pair may occur twice: all of a pair or none
    live[-1:] = False
    known, known_as = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # pairs with a rule, ascending, and their nonterminals
    weight = np.zeros(len(sequence) + 1, np.int64)  # by count, ties by pair; the last stands before the first place as well
    while (at := np.flatnonzero(live)).size:
        pairs, number = _numbered(sequence[at], sequence[at + 1])
        overlaps = _joined_odd(at, number)
        counts = np.bincount(number, minlength=len(pairs)) - np.bincount(number[overlaps], minlength=len(pairs))
        often = counts >= 2
        again = often[number]
        live[at] = again
        again[overlaps] = False
        at, number = at[again], number[again]
        here = (counts << 32 | np.arange(len(pairs)))[number]
        weight[at] = here
        chosen = here > weight[at - 1]
        chosen &= here > weight[at + 1]
        weight[at] = 0
        put, number = at[chosen], number[chosen]
        good = np.bincount(number, minlength=len(pairs)) >= 2  # overlaps may have used a pair's places up
        chosen = good[number]
        put, number = put[chosen], number[chosen]
        if not len(put):
            break
        own = pairs[good].astype(np.uint64)
        own = own[:, 0] << np.uint64(32) | own[:, 1]
        place = np.searchsorted(known, own)
        old = np.r_[known, ~np.uint64(0)][place] == own  # overlaps had kept some places from an earlier round
        symbol = np.where(old, np.r_[known_as, 0][place], len(lengths) + np.cumsum(~old) - 1)
        known, known_as = np.insert(known, place[~old], own[~old]), np.insert(known_as, place[~old], symbol[~old])
        new = pairs[good][~old]
        rules.append(new)
        lengths = np.r_[lengths, lengths[new[:, 0]] + lengths[new[:, 1]]]
        becomes = np.zeros(len(pairs), np.uint32)
        becomes[good] = symbol
        sequence[put] = becomes[number]
        live[put] = live[put[put > 0] - 1] = True
        left = np.ones(len(sequence), bool)
        left[put + 1] = False
        sequence, live = sequence[left], live[left]
        if old.any():  # pairs with these are more now
            more = np.zeros(len(lengths), bool)
            more[symbol[old]] = True
            more = more[sequence]
            live |= more
            live[:-1] |= more[1:]
        live[-1:] = False
    return np.concatenate(rules), lengths[base:], sequence


def expand(sequence: np.ndarray, base: int, rules: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
    """All ids of a sequence, level by level; what is expanded is not looked at again."""
    size = np.ones(base + len(rules), np.int64)
    if lengths is None:
        while (more := size[rules].sum(axis=1)).tolist() != size[base:].tolist():
            size[base:] = more
    else:
        size[base:] = lengths
    ends = np.cumsum(size[sequence])
    out = np.empty(ends[-1] if len(ends) else 0, np.uint32)
    at = ends - size[sequence]
    while len(sequence):
        inner = sequence >= base
        out[at[~inner]] = sequence[~inner]
        at, pairs = at[inner], rules[sequence[inner] - base]
        at = np.stack([at, at + size[pairs[:, 0]]], axis=1).ravel()
        sequence = pairs.ravel()
    return out


class Shard:
    """Reads one row of the table."""

    def __init__(self, row: dict):
        self.base, self.n_ids = row["base"], row["n_ids"]
        self.doc_ids, self.sizes = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["sizes"], "<i8")
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        self.lengths, self.sequence = np.frombuffer(row["lengths"], "<u4"), np.frombuffer(row["sequence"], "<u4")

    def all_ids(self) -> np.ndarray:
        return expand(self.sequence, self.base, self.rules, self.lengths)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start..end of the shard, from the symbols that cover them."""
        inner = self.sequence >= self.base
        sizes = np.ones(len(self.sequence), np.int64)
        sizes[inner] = self.lengths[self.sequence[inner] - self.base]
        ends = np.cumsum(sizes)
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "left")
        before = int(ends[first - 1]) if first else 0
        return expand(self.sequence[first:last + 1], self.base, self.rules, self.lengths)[start - before:end - before]

    def document(self, k: int) -> np.ndarray:
        ends = np.cumsum(self.sizes)
        return self.ids(int(ends[k] - self.sizes[k]), int(ends[k]))


def _shard_row(part: int, shard: int, doc_ids: list, blobs: list[bytes], base: int) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(blobs), "<u4")
    rules, lengths, sequence = compress(ids, base)
    sizes = np.array([len(b) // 4 for b in blobs], "<i8")
    values = (part, shard, np.array([NULL_ID if d is None else d for d in doc_ids], "<i8").tobytes(), sizes.tobytes(), base,
              rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), sequence.astype("<u4").tobytes(), len(ids))
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=list(_FIELDS))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose texts begin in the same ``SLICE_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
    number = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    bounds = np.r_[0, np.flatnonzero(number[1:] != number[:-1]) + 1, batch.num_rows].tolist()
    for a, b in zip(bounds, bounds[1:]):
        yield batch.slice(a, b - a)


class Encoder:
    """Texts to ids as the library gives them, without special tokens added;
    the string of a special token inside a text is that token.  Texts that hold
    one are encoded whole by the library, the others by the codec."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.codec, self.library = codec(path), Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        out = self.codec.encode_words(texts)
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return out


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each document and
    write the shards to ``path`` in ascending doc_id order: NULL first, ties by
    a hash of the text.  NULL and empty texts are the end id alone; repeated
    rows are documents of their own; an empty table writes no shard; other
    columns are not looked at."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, shard = Encoder(vocabulary), TaskContext.get().partitionId(), 0
        doc_ids, blobs, held = [], [], 0
        gc.disable()  # lists of words are long and hold no cycles: a collection would walk through them for nothing
        try:
            for batch in batches:
                for piece in _slices(batch):
                    for doc_id, ids in zip(piece.column(0).to_pylist(), own.encode_many(texts_of(piece.column(1)))):
                        doc_ids.append(doc_id)
                        blobs.append(ids + end)
                        held += len(ids) // 4 + 1
                        if held >= shard_ids:
                            yield _shard_row(part, shard, doc_ids, blobs, len(own.codec.tokens))
                            doc_ids, blobs, held, shard = [], [], 0, shard + 1
            if blobs:
                yield _shard_row(part, shard, doc_ids, blobs, len(own.codec.tokens))
        finally:
            gc.enable()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data")).withColumn("tie", F.xxhash64("data"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "data")
    map_arrow(ordered, run, _SHARD).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the shards at ``path``: ``doc_id, start`` (ids
    of all documents before it), ``n_tokens``, ``ids_crc32`` and, if asked,
    ``ids`` (binary)."""
    shards = spark.read.schema(_SHARD).parquet(path)
    sizes = staged(shards.select("part", "shard", "n_ids"), "shard-sizes")
    # one row per partition of the writer, then one per shard of a partition
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    starts = sizes.withColumn("within", within).join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("within")).alias("shard_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shard = Shard(row)
                data = shard.all_ids().astype("<u4").tobytes()
                ends = np.cumsum(shard.sizes)
                blobs = [data[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), shard.sizes.tolist())]
                n = len(blobs)
                columns = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                           pa.array([None if d == NULL_ID else d for d in shard.doc_ids.tolist()], pa.int64()),
                           pa.array(ends - shard.sizes), pa.array(shard.sizes), pa.array([zlib.crc32(b) for b in blobs], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(blobs, pa.binary())] * with_ids, names=names)

    names = ["part", "shard", "doc_id", "before", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "part int, shard int, doc_id long, before long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return (map_arrow(shards, run, schema).join(starts, ["part", "shard"])
            .select("doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids))
