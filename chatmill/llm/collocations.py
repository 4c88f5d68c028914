"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and pieces into words.  Each place of a piece gives
one gram only: the longest that starts there.  Grams of ``longest`` words are
the edges of the graph, from the node of their first ``longest - 1`` words to
the node of their last; shorter ones are what is left where a piece ends.  A
shorter phrase's count is then the flow out of its node (the counts of the
next longer phrases that begin with it) plus the piece ends that equal it, so
one count of long grams gives the counts of all.

Most grams are rare and no phrase needs them.  A first pass counts 64-bit
hashes of all grams in ranges of the hash space (four bytes for a hash that
occurs once in a block) and marks those that may reach ``min_count`` in a
bitmap of fixed size.  The second pass ends each place's gram where the next
longer one is not marked: every part of a frequent phrase is frequent, so no
count of one is lost, and a mark too many costs space only.  The bitmap's size
does not grow with the input; where it is too full to keep rare grams out,
more of them are counted and the result is the same.

Unary paths (nodes with one edge in and one out) are compacted by pointer
doubling into rows of words and edge counts; long repeated passages become one
path instead of an edge for every word.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import map_arrow, number_rows, staged, text_bytes

BLOCK_TOKENS = 1 << 19
#: text bytes for each range of the hash space
RANGE_BYTES = 16 << 20
BITMAP_BITS = 26
#: edges in one row of a compacted path; a longer path is several rows
SEGMENT = 4096
NO_LANG = "und"
_END = b"\xff"  # in no UTF-8 text
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + _END * 10)


class _Ids(dict):
    """Numbers words as they come; 0 is a piece's end."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n


class Block:
    """The tokens of some texts: numbers of (language, word), 0 at piece ends."""

    def __init__(self):
        self.words: list[bytes] = [b""]
        self.ids: dict[str, _Ids] = {}
        self.langs: list[str] = []
        self.spans: list[tuple[int, int, int]] = []  # language, first and last word number that came with it
        self.tokens: list[np.ndarray] = []
        self.lang_of: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.ids:
            self.ids[lang] = _Ids(self.words)
            self.langs.append(lang)
        before = len(self.words)
        words = text.translate(_FOLD).replace(_END, b" \xff ").split()
        words.append(_END)
        tokens = np.fromiter(map(self.ids[lang].__getitem__, words), np.int32, len(words))
        at = self.langs.index(lang)
        self.spans.append((at, before, len(self.words)))
        self.tokens.append(tokens)
        self.lang_of.append(np.full(len(tokens), at, np.int32))
        self.size += len(tokens)

    def grams(self, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Tokens, their languages, how many words (at most ``longest``) the
        piece has from each place, and the hash of the gram of 1, 2, .. words
        from each place (of use only where the piece has as many)."""
        tokens, lang_of = np.concatenate(self.tokens), np.concatenate(self.lang_of)
        n = len(tokens)
        place = np.arange(n)
        ends = np.where(tokens == 0, place, n)
        left = np.minimum(np.minimum.accumulate(ends[::-1])[::-1] - place, longest)
        hashed = np.zeros(len(self.words), np.uint64)
        for lang, first, last in self.spans:
            seed = zlib.crc32(self.langs[lang].encode())
            for w in range(first, last):
                hashed[w] = xxh64_intdigest(self.words[w], seed)
        each = np.r_[hashed[tokens], np.zeros(longest, np.uint64)]
        out = [_mixed(each[:n])]
        for k in range(1, longest):
            out.append(_mixed(out[-1] * np.uint64(0x9E3779B97F4A7C15) + each[k:n + k]))
        return tokens, lang_of, left, out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def _range_and_key(hashed: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range of the hash space, and the 32 bits that tell hashes of a range apart."""
    return (hashed >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), (hashed & np.uint64(0xFFFFFFFF)).astype("<u4")


def _bit(part, key: np.ndarray, bits: int) -> np.ndarray:
    """Place in the bitmap of a key of range ``part``."""
    x = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(part).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x >> np.uint64(64 - bits)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    block = Block()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            block.add(lang, text)
            if block.size >= BLOCK_TOKENS:
                yield block
                block = Block()
    if block.size:
        yield block


def _hash_counts(longest: int, ranges: int):
    """Each block's different grams as keys, cut by ranges: those that occur once, and the others with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            _, _, left, hashes = block.grams(longest)
            rows = []
            every = np.concatenate([h[left > k] for k, h in enumerate(hashes)])
            del hashes, left
            every.sort()
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][:len(every)])
            counts = np.diff(np.r_[first, len(every)])
            part, key = _range_and_key(every[first], ranges)  # ascending, as the hashes are
            cuts = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
            for r, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
                if e > s:
                    once = counts[s:e] == 1
                    rows.append((r, key[s:e][once].tobytes(), key[s:e][~once].tobytes(), counts[s:e][~once].astype("<u4").tobytes()))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + 64]), kinds)], names=["range", "once", "more", "counts"])

    return run


def _frequent(min_count: int, bits: int):
    """The places in the bitmap of a range's keys that all blocks together hold often enough, as (word of 64 bits, its bits)."""
    def run(group: pa.Table) -> pa.Table:
        part = group.column("range")[0].as_py()
        once, more, n = (np.frombuffer(b"".join(group.column(c).to_pylist()), "<u4") for c in ("once", "more", "counts"))
        keys = np.concatenate([once, more])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], np.r_[np.ones(len(once), np.int64), n.astype(np.int64)][order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        total = np.add.reduceat(n, first)
        bit = np.unique(_bit(part, keys[first][total >= min_count], bits))
        word, at = np.unique(bit >> np.uint64(6), return_index=True)
        value = np.bitwise_or.reduceat(np.uint64(1) << (bit & np.uint64(63)), at) if len(at) else np.zeros(0, np.uint64)
        return pa.table({"word": word.astype(np.int64), "bits": value.view(np.int64)})

    return run


def _longest_grams(longest: int, ranges: int, marked, bits: int):
    """Each block's longest grams of which every beginning is marked, with their counts; words not marked count as
    a gram of no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(marked.value, np.uint64)
        for block in _blocks(batches):
            tokens, lang_of, left, hashes = block.grams(longest)
            words = np.zeros(len(tokens), np.int8)
            open_ = left > 0
            for k, h in enumerate(hashes):
                at = np.flatnonzero(open_)
                bit = _bit(*_range_and_key(h[at], ranges), bits)
                found = (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
                words[at[found]] = k + 1
                open_[:] = False
                open_[at[found]] = left[at[found]] > k + 1
            texts, sizes, langs, ns = [], [], [], []
            none = np.bincount(lang_of[(left > 0) & (words == 0)], minlength=len(block.langs))
            for lang in np.flatnonzero(none).tolist():
                texts.append("")
                sizes.append(0)
                langs.append(block.langs[lang])
                ns.append(int(none[lang]))
            for k in range(1, longest + 1):
                at = np.flatnonzero(words == k)
                for i, n in zip(*_counted(tokens, at, hashes[k - 1][at], k)):
                    texts.append(b" ".join([block.words[w] for w in tokens[i:i + k].tolist()]).decode("utf-8", "replace"))
                    sizes.append(k)
                    langs.append(block.langs[lang_of[i]])
                    ns.append(n)
            for s in range(0, len(texts), 20_000):
                cut = slice(s, s + 20_000)
                yield pa.RecordBatch.from_arrays([pa.array(langs[cut], pa.string()), pa.array(sizes[cut], pa.int32()), pa.array(texts[cut], pa.string()), pa.array(ns[cut], pa.int64())],
                                                 names=["lang", "k", "phrase", "n"])

    return run


def _counted(tokens: np.ndarray, at: np.ndarray, hashed: np.ndarray, k: int) -> tuple[list[int], list[int]]:
    """Of the grams of ``k`` words at these places: a place of each different
    one, and how often it is there.  Equal hashes are compared word by word."""
    if not len(at):
        return [], []
    order = np.argsort(hashed, kind="stable")
    at, hashed = at[order], hashed[order]
    grams = np.stack([tokens[at + j] for j in range(k)], axis=1)
    same = hashed[1:] == hashed[:-1]
    if (same & (grams[1:] != grams[:-1]).any(axis=1)).any():  # different grams share a hash
        _, first, counts = np.unique(grams, axis=0, return_index=True, return_counts=True)
        return at[first].tolist(), counts.tolist()
    first = np.flatnonzero(np.r_[True, ~same])
    return at[first].tolist(), np.diff(np.r_[first, len(at)]).tolist()


def longest_grams(docs: DataFrame, longest: int = 4, min_count: int = 30, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """``lang, k, phrase, n``: how many places' longest gram is ``phrase``, of
    ``k`` words (0: the word there is rare).  Summed over the grams that begin
    with it, a phrase's ``n`` is its exact count if that is ``min_count`` or
    more, and less than ``min_count`` otherwise."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text_bytes().alias("data"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(4, math.ceil(size / RANGE_BYTES))
    hashed = map_arrow(rows, _hash_counts(longest, ranges), "range int, once binary, more binary, counts binary")
    marks = (hashed.groupBy("range").applyInArrow(_frequent(min_count, bitmap_bits), "word long, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())  # at most 2^(bits - 6) rows
    bitmap = np.zeros(1 << (bitmap_bits - 6), np.int64)
    bitmap[marks.column("word").to_numpy()] = marks.column("bits").to_numpy()
    marked = spark.sparkContext.broadcast(bitmap.tobytes())
    grams = map_arrow(rows, _longest_grams(longest, ranges, marked, bitmap_bits), "lang string, k int, phrase string, n long")
    return staged(grams.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")), "longest-grams")


def _ranked(links: DataFrame, edges: DataFrame) -> DataFrame:
    """``edge, head, dist`` for each edge: the first edge of its path and the
    steps from there, by pointer doubling along ``links`` (edge, before).  The
    rounds are the logarithm of the longest path.  A path that returns to
    itself begins at its smallest edge."""
    state = staged(edges.join(links, "edge", "left").select(
        "edge", F.coalesce("before", "edge").alias("jump"), F.col("before").isNotNull().cast("long").alias("dist"),
        F.col("before").isNotNull().alias("going"), F.least("edge", F.coalesce("before", "edge")).alias("least")), "path-state")
    going = links.count()
    for _ in range(max(1, going).bit_length() + 1):
        if not state.filter("going").limit(1).count():
            return state.select("edge", F.col("jump").alias("head"), "dist")
        far = state.select(F.col("edge").alias("jump"), F.col("jump").alias("jump2"), F.col("dist").alias("dist2"), F.col("going").alias("going2"), F.col("least").alias("least2"))
        moved = state.filter("going").join(far, "jump").select(
            "edge", F.col("jump2").alias("jump"), (F.col("dist") + F.col("dist2")).alias("dist"), F.col("going2").alias("going"), F.least("least", "least2").alias("least"))
        state = staged(state.filter("NOT going").unionByName(moved), "path-state")
    # what still goes on runs in circles: each is cut before its smallest edge
    cut = state.filter("going AND edge = least").select("edge")
    rest = links.join(state.filter("going").select("edge"), "edge", "left_semi").join(cut, "edge", "left_anti")
    circles = _ranked(rest, state.filter("going").select("edge"))
    return state.filter("NOT going").select("edge", F.col("jump").alias("head"), "dist").unionByName(circles)


def paths(grams: DataFrame, longest: int = 4) -> DataFrame:
    """The graph's edges with unary paths compacted: ``lang, path, segment,
    words, counts``, where edge ``i`` of a row is ``longest`` words from word
    ``i`` on and occurs ``counts[i]`` times."""
    edges = staged(number_rows(grams.filter(F.col("k") == longest).select(
        "lang", "phrase", "n", F.substring_index("phrase", " ", longest - 1).alias("out_of"), F.substring_index("phrase", " ", 1 - longest).alias("into")), "edge"), "edges")
    ins = edges.groupBy("lang", F.col("into").alias("node")).agg(F.count("*").alias("n_in"), F.min("edge").alias("before"))
    outs = edges.groupBy("lang", F.col("out_of").alias("node")).agg(F.count("*").alias("n_out"), F.min("edge").alias("edge"))
    links = ins.filter("n_in = 1").join(outs.filter("n_out = 1"), ["lang", "node"]).filter("edge <> before").select("edge", "before")
    ranked = _ranked(staged(links, "path-links"), edges.select("edge"))
    step = F.struct("dist", "phrase", "n")
    rows = (edges.join(ranked, "edge").groupBy("lang", F.col("head").alias("path"), F.floor(F.col("dist") / SEGMENT).alias("segment"))
            .agg(F.array_sort(F.collect_list(step)).alias("steps")))  # at most SEGMENT edges
    last = F.transform("steps", lambda s: F.substring_index(s["phrase"], " ", -1))
    first = F.split(F.substring_index(F.col("steps")[0]["phrase"], " ", longest - 1), " ")
    return staged(rows.select("lang", "path", "segment", F.concat(first, last).alias("words"), F.transform("steps", lambda s: s["n"]).alias("counts")), "paths")


def phrase_counts(grams: DataFrame, compacted: DataFrame, longest: int = 4) -> DataFrame:
    """``lang, k, phrase, f`` of all phrases of 0 (rare words) to ``longest``
    words: an edge's count is read from its path, a shorter phrase's is the
    flow out of its node plus the piece ends that equal it."""
    edge = F.posexplode(F.col("counts")).alias("i", "f")
    level = (compacted.select("lang", "words", edge)
             .select("lang", F.array_join(F.slice("words", F.col("i") + 1, longest), " ").alias("phrase"), "f"))
    levels = [level]
    for k in range(longest - 1, 0, -1):
        flow = level.select("lang", F.substring_index("phrase", " ", k).alias("phrase"), "f")
        ends = grams.filter(F.col("k") == k).select("lang", "phrase", F.col("n").alias("f"))
        level = staged(flow.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), f"phrases-{k}")
        levels.insert(0, level)
    out = grams.filter("k = 0").select("lang", F.lit(0).alias("k"), "phrase", F.col("n").alias("f"))
    for k, level in enumerate(levels, 1):
        out = out.unionByName(level.select("lang", F.lit(k).alias("k"), "phrase", "f"))
    return out


def scored(counts: DataFrame, min_count: int = 30, scale: int = 2_000_000, cover_percent: int = 80) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer
    candidate covers."""
    often = staged(counts.filter((F.col("f") >= min_count) & (F.col("k") > 0)), "frequent-phrases")
    found = often.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("first"), F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"))
    cuts = cuts.join(often.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(often.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # decimals: the product and the sum may pass 64 bits, and a decimal's div is exact
    score = F.expr(f"(cast({scale} as decimal(12,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("lowest"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.col("k") - k + 1), lambda i: F.array_join(F.slice(F.split("phrase", " "), i, k), " "))))
    covered = (found.filter("k > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
               .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = lowest.join(covered, ["lang", "phrase"], "left").filter(
        F.expr(f"longer IS NULL OR cast(longer as decimal(19,0)) * 100 < cast(a as decimal(19,0)) * {cover_percent}"))
    return kept.select("lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score")


def collocations(docs: DataFrame, longest: int = 4, min_count: int = 30, top: int = 2000, cover_percent: int = 80, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words: ``lang, rank,
    phrase, a, l, r, n, score``.

    A-Z is lower-cased; pieces end at ``.,;:!?`` and line breaks, words at
    blanks and tabs.  ``a`` is the phrase's count (``min_count`` or more), ``l``
    and ``r`` those of the two parts of its lowest-scoring cut, ``n`` all words
    of the language, ``score`` = floor(2000000 a / (l + r)).  A phrase inside a
    longer candidate with at least ``cover_percent`` of its count is left out.

    A NULL lang is ``und``; NULL and empty texts have no words; repeated rows
    count each for itself; ties go by count, then by the phrase's bytes; an
    empty table gives no rows; a text is never cut, whatever its length; columns
    other than text and lang are not looked at."""
    grams = longest_grams(docs, longest, min_count, bitmap_bits)
    counts = phrase_counts(grams, paths(grams, longest), longest)
    total = counts.filter("k <= 1").groupBy("lang").agg(F.sum("f").alias("n"))
    found = staged(scored(counts, min_count, cover_percent=cover_percent), "collocations")
    # first within 64 parts of each language, then among what they keep
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
