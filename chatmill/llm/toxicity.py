"""Counterfactual-regularised toxicity classifier.

Features of a text are its different words (lower-cased runs of letters) and
their prefixes, hashed.  Document frequencies by label are counted over at most
about ``sample_rows`` labelled training rows; the features that set the labels
apart most keep a weight.  The weights are fitted on the same rows by
logistic loss plus an L2 term plus a counterfactual term: in each sentence
that mentions an identity term, the term is swapped for others and the change
of the score is penalised, so that a group's name carries no weight of its
own.  Scoring sums the weights of a text's features where the text is read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_of, free_name, map_arrow, ship, staged

SAMPLE_ROWS = 20_000
FEATURES = 4096
BUCKETS = 1 << 22
MIN_ROWS = 4
CACHE_WORDS = 60_000
WORDS = re.compile(r"[^\W\d_]+")
#: terms that name groups; swapped for each other
IDENTITY = tuple("women men woman man girls boys female male muslim muslims christian christians jewish jews hindu buddhist atheist "
                 "black white asian latino african european american mexican immigrant immigrants refugee refugees gay straight lesbian "
                 "bisexual transgender queer old young disabled deaf blind frauen männer muslime christen juden femmes hommes musulmans "
                 "chrétiens juifs mujeres hombres musulmanes cristianos judíos".split())


def word_features(word: str) -> list[int]:
    """The word and its prefixes of 3 to 6 letters, as buckets."""
    forms = ["=" + word] + ["^" + word[:n] for n in range(3, 7) if n <= len(word)]
    return [zlib.crc32(f.encode()) % BUCKETS for f in forms]


def words_of(text: str) -> set[str]:
    return set(WORDS.findall(text.lower()))


def features(words: set[str], cache: dict | None = None) -> set[int]:
    """The features of the words; ``cache`` (bounded) holds those of words met before."""
    cache = {} if cache is None else cache
    if len(cache) > CACHE_WORDS:
        cache.clear()
    found: set[int] = set()
    for w in words:
        own = cache.get(w)
        if own is None:
            own = cache[w] = word_features(w)
        found.update(own)
    return found


def swapped(words: set[str], identity: tuple[str, ...], times: int = 2) -> list[set[str]]:
    """The words with each identity term replaced by another, ``times`` ways."""
    present = [w for w in words if w in identity]
    if not present:
        return []
    out = []
    for turn in range(times):
        other = {w: identity[(identity.index(w) + 1 + turn * 7 + zlib.crc32(w.encode()) % (len(identity) - 8)) % len(identity)] for w in present}
        out.append({other.get(w, w) for w in words})
    return out


@dataclass
class Model:
    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, words: set[str], cache: dict | None = None) -> float:
        z = self.bias + sum(self.weights[f] for f in self._known(words, cache))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))

    def _known(self, words: set[str], cache: dict | None) -> set[int]:
        cache = {} if cache is None else cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        found: set[int] = set()
        for w in words:
            known = cache.get(w)
            if known is None:
                known = cache[w] = tuple(f for f in word_features(w) if f in self.weights)
            found.update(known)
        return found


def labelled(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, toxic, pick`` of training rows with a label: of at most about
    ``sample_rows`` labelled ids, drawn by hash from the light table of labels
    and broadcast to the scan of the texts, so that no text is shuffled."""
    marks = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(fold_of(F.col("doc_id"), folds) != held_out)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    marks = staged(marks, "labels")
    limit = int(min(1.0, sample_rows / max(1, marks.count())) * (1 << 32))
    drawn = marks.filter(F.crc32(F.concat(F.lit("drawn"), F.col("doc_id").cast("string")).cast("binary")) < limit)
    return (docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
            .select(F.coalesce("text", F.lit("")).alias("text"), "toxic", F.crc32(F.concat(F.lit("pick"), F.col("doc_id").cast("string")).cast("binary")).alias("pick")))


def document_frequencies(rows: DataFrame) -> DataFrame:
    """``feature, toxic, clean``: rows of each label that have the feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, cache = np.zeros((2, BUCKETS), np.int32), {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.fromiter(features(words_of(text), cache), np.int64)
                seen[int(toxic > 0), found] += 1
        used = np.flatnonzero(seen.any(axis=0))
        for at in range(0, len(used), 50_000):
            some = used[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[1, some], pa.int64()), pa.array(seen[0, some], pa.int64())],
                                             names=["feature", "toxic", "clean"])

    counted = map_arrow(rows.select("text", "toxic"), run, "feature long, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, n_features: int = FEATURES, identity: tuple[str, ...] = IDENTITY,
        penalty: float = 2.0, l2: float = 1e-4, steps: int = 300) -> Model:
    """Fit on ``rows`` (text, toxic, pick).  The driver receives at most
    ``n_features`` chosen features and, of at most about ``sample_rows`` rows
    (chosen by hash), which of these they have.  No labelled row: every score
    is 0; rows of one label only: the bias says which."""
    rows = staged(rows, "labelled")
    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") > 0).cast("int")), F.lit(0))).first()
    if not total:
        return Model(-50.0)
    rate = F.lit(positive / total)
    seen = F.col("toxic") + F.col("clean")
    # how far the toxic share of a feature's rows is from the share of all
    z = (F.col("toxic") - seen * rate) / F.sqrt(seen * rate * (1 - rate) + 1)
    chosen = (document_frequencies(rows).filter(seen >= MIN_ROWS).withColumn("z", F.abs(z)).filter("z > 3")
              .orderBy(F.desc("z"), "feature").limit(n_features).select("feature").collect())
    place = {r[0]: i for i, r in enumerate(chosen)}
    limit, named = int(min(1.0, sample_rows / total) * (1 << 32)), set(identity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}

        def own(words: set[str]) -> bytes:
            return np.array(sorted(place[f] for f in features(words, cache) if f in place), "<i4").tobytes()

        for batch in batches:
            out = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, pairs = words_of(text), []
                if words & named:
                    sentences = map(words_of, re.split(r"[.!?\n]+", text))
                    pairs = [(own(s), own(other)) for s in sentences for other in swapped(s, identity)]
                out.append((int(toxic > 0), own(words), [a for a, _ in pairs], [b for _, b in pairs]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()),
                                              *(pa.array([x[k] for x in out], pa.list_(pa.binary())) for k in (2, 3))], names=["y", "x", "real", "swap"])

    sample = map_arrow(rows.filter(F.col("pick") < limit).select("text", "toxic"), run, "y int, x binary, real array<binary>, swap array<binary>").toArrow()
    as_ids = lambda blobs: [np.frombuffer(b, "<i4") for b in blobs]
    real = [b for x in sample.column("real").to_pylist() for b in x]
    swap = [b for x in sample.column("swap").to_pylist() for b in x]
    weights, bias = train(as_ids(sample.column("x").to_pylist()), np.array(sample.column("y").to_pylist(), float), len(place),
                          (as_ids(real), as_ids(swap)), penalty, l2, steps)
    return Model(bias, {f: float(weights[i]) for f, i in place.items()})


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return row, np.concatenate(rows) if rows else np.zeros(0, np.int32)


def train(x: list[np.ndarray], y: np.ndarray, n: int, pairs: tuple[list, list], penalty: float, l2: float, steps: int) -> tuple[np.ndarray, float]:
    """Adam on the mean logistic loss + l2 |w|^2 + penalty * mean squared
    change of the logit between a sentence and its swapped form."""
    row, col = _flat(x)
    (ra, ca), (rb, cb) = _flat(pairs[0]), _flat(pairs[1])
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for step in range(1, steps + 1):
        z = np.bincount(row, w[col], len(x)) + w[n]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / max(1, len(y))
        g = np.r_[np.bincount(col, error[row], n) + 2 * l2 * w[:n], error.sum()]
        if len(pairs[0]):
            change = np.bincount(ra, w[ca], len(pairs[0])) - np.bincount(rb, w[cb], len(pairs[0]))
            change *= 2 * penalty / len(pairs[0])
            g[:n] += np.bincount(ca, change[ra], n) - np.bincount(cb, change[rb], n)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:n], float(w[n])


def scorer(model: Model):
    """A column function: text to score; NULL as empty."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        cache: dict = {}
        return pa.array([model.score(words_of(t or ""), cache) for t in texts.to_pylist()], pa.float64())

    return score


def with_score(docs: DataFrame, model: Model, name: str = "score", text: Column | None = None) -> DataFrame:
    """``docs`` with a score from 0 to 1; every row stays, NULL and empty texts
    get the bias's score, an existing column of that name is replaced."""
    ship(docs.sparkSession)
    return docs.withColumn(name, scorer(model)(F.col("text") if text is None else text))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    score = free_name(docs, "_toxic_score")
    return with_score(docs, model, score).filter(F.col(score) < threshold).drop(score)
