"""Language identification by nearest centroid.

A text's vector holds its character n-grams (1 to 3 characters of the
lower-cased letters, other characters as one space), hashed into ``DIM``
places, weighted by (1 + log tf) * idf and normalised.  Document frequencies
are counted over all training rows.  Each language has several centroids,
found by spherical k-means over a bounded sample of its rows.  A text gets
the language of the centroid with the largest cosine; ``rejected`` marks texts
that are farther from it than nearly all rows of its own cluster.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import texts_of
from .common import map_arrow, staged

DIM = 1 << 13
CENTROIDS = 3
SAMPLE_ROWS = 600  # at most about so many rows of each language are clustered
REJECT_QUANTILE = 0.001
UNKNOWN = "und"
OTHERS = re.compile(r"[\W\d_]+")
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts; None if the text has no letter."""
    letters = OTHERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):  # numerals and fractions are word characters, but no letters
        return None
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le"), "<u4")
    out = np.zeros(DIM, np.int64)
    mixed = np.zeros(len(codes), np.uint32)
    for n, factor in enumerate(_FACTORS):
        mixed = (mixed[:len(codes) - n] ^ codes[n:]) * factor
        out += np.bincount((mixed ^ mixed >> np.uint32(15)) % np.uint32(DIM), minlength=DIM)
        mixed = mixed[:-1] if n + 1 < len(_FACTORS) else mixed
    return out


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    farthest: np.ndarray

    def vector(self, text: str) -> np.ndarray | None:
        tf = counts(text)
        if tf is None:
            return None
        v = np.where(tf > 0, (1 + np.log(np.maximum(tf, 1))) * self.idf, 0)
        return v / np.linalg.norm(v)

    def predict(self, text: str) -> tuple[str, float, bool]:
        v = self.vector(text)
        if v is None or not len(self.centroids):
            return UNKNOWN, 0.0, True
        cosines = self.centroids @ v
        best = int(np.argmax(cosines))
        return self.languages[self.owner[best]], float(np.clip(cosines[best], 0, 1)), bool(cosines[best] < self.farthest[best])


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How many rows have each n-gram place, and how many rows there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIM + 1, np.int64)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                if (tf := counts(text)) is not None:
                    seen[:DIM] += tf > 0
                    seen[DIM] += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used])], names=["place", "n"])

    found = map_arrow(rows.select(F.col("text").cast("binary")), run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(DIM + 1, np.int64)
    for place, n in found:  # at most DIM + 1 of them
        out[place] = n
    return out[:DIM], int(out[DIM])


def cluster(vectors: np.ndarray, k: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out first centroids: (centroids, cluster of each row)."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[own == j].sum(axis=0) if (own == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, k: int = CENTROIDS) -> Model:
    """Fit on ``rows`` (text, lang, pick: a hash of 32 bits).  The driver gets
    the n-gram frequencies and the sampled texts' counts.  No row: a model
    that knows no language."""
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL")
    frequencies, total = document_frequencies(rows)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    sizes = staged(rows.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    sample = rows.join(sizes, "lang").filter(F.col("pick") * F.col("n") < F.lit(float(sample_rows)) * (1 << 32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(lang, tf) for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))) if (tf := counts(text)) is not None]
            used = [np.flatnonzero(tf) for _, tf in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.string()), pa.array([u.astype("<i4").tobytes() for u in used], pa.binary()),
                 pa.array([tf[u].astype("<i4").tobytes() for u, (_, tf) in zip(used, found)], pa.binary())], names=["lang", "places", "counts"])

    got = map_arrow(sample.select("lang", F.col("text").cast("binary")), run, "lang string, places binary, counts binary").toArrow().to_pylist()
    languages, owner, centroids, farthest = sorted({r["lang"] for r in got}), [], [], []
    for i, lang in enumerate(languages):
        own = [r for r in got if r["lang"] == lang]
        vectors = np.zeros((len(own), DIM), np.float32)
        for v, r in zip(vectors, own):
            places = np.frombuffer(r["places"], "<i4")
            v[places] = (1 + np.log(np.frombuffer(r["counts"], "<i4"))) * idf[places]
            v /= np.linalg.norm(v)
        found, of = cluster(vectors, k)
        cosines = (vectors @ found.T)[np.arange(len(own)), of]
        owner += [i] * len(found)
        centroids.append(found)
        farthest += [np.quantile(cosines[of == j], REJECT_QUANTILE) - 0.05 if (of == j).any() else 0.0 for j in range(len(found))]
    return Model(idf.astype(np.float32), languages, np.array(owner, int), np.concatenate(centroids).astype(np.float32) if centroids else np.zeros((0, DIM), np.float32),
                 np.array(farthest, np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs``
    (doc_id, text).  NULL, empty and letterless texts are ``und`` with score
    0; equal cosines go to the first language by name; repeated rows count
    each for itself; other columns are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()),
                                              pa.array([x[2] for x in found], pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("data"))
    return map_arrow(rows, run, "doc_id long, lang_pred string, score double, rejected boolean")
