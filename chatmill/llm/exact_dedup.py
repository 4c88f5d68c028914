"""Exact deduplication by composable polynomial fingerprints.

A text (NULL counts as empty), lower-cased over A-Z, is cut into chunks of
``CHUNK`` bytes.  A chunk's hash is ``sum(byte * B**(m-1-i)) mod P`` for two
primes; hashes of neighbours combine by length-shifted arithmetic,
``H(xy) = H(x) * B**len(y) + H(y)``, so the chunks of a huge text are hashed
side by side and in any order.  Rows of equal fingerprint and length form a
class.  Classes of several rows are then compared chunk by chunk: a class
whose ``min`` and ``max`` agree for every chunk holds one text; one where they
differ (a collision) is regrouped by its texts.  Both aggregates combine on
the map side, so a text that makes up a third of all rows costs one row per
map task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, rows_of, staged, text_bytes, with_row_id

CHUNK = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1_000_003_927, 1_318_699_831)

_KEYED = "_row long, doc_id long, fp long, n_bytes long, text_sha256 string"
_CHUNKS = "fp long, n_bytes long, chunk_no long, chunk binary"


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**(n-1) ... base**0 modulo prime."""
    out = np.ones(n, np.uint64)
    for i in range(n - 2, -1, -1):
        out[i] = int(out[i + 1]) * base % prime
    return out


def combine(left: int, right: int, right_len: int, base: int, prime: int) -> int:
    """The hash of two neighbouring pieces from their hashes."""
    return (left * pow(base, right_len, prime) + right) % prime


class Fingerprinter:
    """Fingerprints of byte strings; ``primes`` may be small to force collisions in tests."""

    def __init__(self, chunk: int = CHUNK, primes: tuple[int, int] = PRIMES):
        self.chunk, self.primes = chunk, primes
        self.powers = [powers(b, p, chunk) for b, p in zip(BASES, primes)]

    def chunk_hashes(self, data: bytes) -> list[tuple[int, int, int]]:
        """(length, hash, hash) of each chunk; whole chunks as one matrix product."""
        codes = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        whole = len(codes) // self.chunk
        head, tail = codes[:whole * self.chunk].reshape(whole, self.chunk), codes[whole * self.chunk:]
        hashes = [((head * pw).sum(axis=1) % p).tolist() + ([int((tail * pw[self.chunk - len(tail):]).sum() % p)] if len(tail) else [])
                  for pw, p in zip(self.powers, map(np.uint64, self.primes))]
        lengths = [self.chunk] * whole + [len(tail)] * (len(tail) > 0)
        return list(zip(lengths, *hashes))

    def __call__(self, data: bytes) -> int:
        a = b = 0
        for n, x, y in self.chunk_hashes(data):
            a = combine(a, x, n, BASES[0], self.primes[0])
            b = combine(b, y, n, BASES[1], self.primes[1])
        return a << 31 | b


def _fingerprint(data: bytes, of: Fingerprinter, piece_bytes: int = 1 << 22) -> int:
    """Over pieces of whole chunks, so that a huge text needs little memory."""
    if len(data) <= piece_bytes:
        return of(data)
    step = of.chunk * max(1, piece_bytes // of.chunk)
    a = b = 0
    for at in range(0, len(data), step):
        piece = data[at:at + step]
        fp = of(piece)
        a = combine(a, fp >> 31, len(piece), BASES[0], of.primes[0])
        b = combine(b, fp & (1 << 31) - 1, len(piece), BASES[1], of.primes[1])
    return a << 31 | b


def keyed(docs: DataFrame, chunk: int = CHUNK, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per row of ``docs`` (_row, doc_id, text): its number, doc_id, fingerprint, length and SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprinter(chunk, primes)
        for batch in batches:
            fps, sizes, digests = [], [], []
            for data in batch.column(2):
                data = data.as_py().lower()  # bytes: A-Z only
                fps.append(_fingerprint(data, of))
                sizes.append(len(data))
                digests.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests)],
                names=["_row", "doc_id", "fp", "n_bytes", "text_sha256"])

    rows = docs.select("_row", F.col("doc_id").cast("long"), text_bytes().alias("data"))
    return map_arrow(rows, run, _KEYED)


def _chunk_rows(rows: DataFrame, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp, n, data in zip(batch.column(0), batch.column(1), batch.column(2)):
                data = data.as_py().lower()
                pieces = [data[i:i + chunk] for i in range(0, len(data), chunk)]
                for at in range(0, len(pieces), 256):
                    some = pieces[at:at + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([fp.as_py()] * len(some), pa.int64()), pa.array([n.as_py()] * len(some), pa.int64()),
                         pa.array(range(at, at + len(some)), pa.int64()), pa.array(some, pa.binary())],
                        names=["fp", "n_bytes", "chunk_no", "chunk"])

    return map_arrow(rows.select("fp", "n_bytes", "data"), run, _CHUNKS)


def duplicates(docs: DataFrame, chunk: int = CHUNK, primes: tuple[int, int] = PRIMES, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``_row, doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest doc_id stays (NULL is smallest);
    among repeated rows of that doc_id exactly one.  NULL and empty texts are
    equal.  An empty table gives no rows; other columns are not looked at.
    ``row`` names a column of written row numbers; without it the rows are
    numbered (see ``with_row_id``)."""
    docs = rows_of(docs, row)
    rows = staged(keyed(docs, chunk, primes), "exact-keys")
    best = F.max(F.struct("doc_id", "_row"))
    groups = staged(rows.groupBy("fp", "n_bytes").agg(F.count("*").alias("group_size"), best.alias("best"))
                    .filter("group_size > 1"), "exact-groups")
    # the texts of those groups, met by position so that no text is shuffled needlessly
    members = rows.join(groups.select("fp", "n_bytes"), ["fp", "n_bytes"], "left_semi").select("_row", "fp", "n_bytes")
    texts = (docs.select("_row", text_bytes().alias("data"))
             .join(members, "_row").filter("n_bytes > 0"))
    mixed = staged(_chunk_rows(texts, chunk).groupBy("fp", "n_bytes", "chunk_no")
                   .agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
                   .filter("least <> most").select("fp", "n_bytes").distinct(), "exact-mixed")
    one = rows.join(groups, ["fp", "n_bytes"], "left").withColumn(
        "best", F.coalesce("best", F.struct("doc_id", "_row"))).withColumn("group_size", F.coalesce("group_size", F.lit(1)))
    if not mixed.isEmpty():  # fingerprints that collided: regroup these rows by their texts
        odd = F.broadcast(mixed) if mixed.count() <= 10_000 else mixed
        again = texts.join(odd, ["fp", "n_bytes"], "left_semi").join(rows.select("_row", "doc_id", "text_sha256"), "_row")
        parts = _folded(again)
        sizes = staged(parts.groupBy("data").agg(F.count("*").alias("group_size"), best.alias("best")), "exact-regrouped")
        fixed = parts.join(sizes, "data").select("_row", "doc_id", "text_sha256", "group_size", "best")
        one = (one.join(odd, ["fp", "n_bytes"], "left_anti").select("_row", "doc_id", "text_sha256", "group_size", "best")
               .unionByName(fixed))
    return one.select("_row", "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
                      (F.col("_row") == F.col("best._row")).alias("kept"), "text_sha256")


def _folded(rows: DataFrame) -> DataFrame:
    """The same rows with A-Z of ``data`` lower-cased."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = pa.array([x.as_py().lower() for x in batch.column("data")], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("data"), "data", low)

    rows = rows.select("_row", "doc_id", "text_sha256", "data")
    return map_arrow(rows, run, rows.schema)


def drop_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns stay."""
    row = free_name(docs, "_exact_row")
    rows = with_row_id(docs, row)
    gone = duplicates(rows, row=row, **options).filter("NOT kept").select(F.col("_row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)
