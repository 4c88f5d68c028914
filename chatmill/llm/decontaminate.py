"""Benchmark decontamination with DataFrame functions only.

Texts are lower-cased over A-Z and cut into words (runs of characters other
than ASCII white space, punctuation and controls).  A benchmark item's
windows are its runs of ``window`` consecutive words; an item of fewer words,
but not none, is one window.  Every document's windows are hashed where they
are scanned and looked up in the hash set of benchmark windows.  The set is
sent to every task inside the plan as long as its counted size is within
``SET_LIMIT``; beyond that the lookup is a semi-join, planned by adaptive
execution, with the same results.  Hits are verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_ascii, free_name, number_rows, rows_of, staged, with_row_id

WINDOW = 10
SET_LIMIT = 200_000
#: everything that is not part of a word, after lower-casing
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text in order; NULL has none."""
    return F.coalesce(F.array_remove(F.split(fold_ascii(text), BREAKS), ""), F.array().cast("array<string>"))


def with_hashes(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Add ``hashes_n`` for each length n: the hash of each run of n words of
    ``w`` (none if there are fewer), put together from runs of 1, 2, 4, 8
    words.  Every step is its own projection, so none is computed twice."""
    def joined(left: str, right: str, right_from: int, total: int) -> Column:
        count = F.greatest(F.size("w") - total + 1, F.lit(0))
        return F.zip_with(F.slice(left, 1, count), F.slice(right, right_from + 1, count), lambda a, b: F.xxhash64(a, b))

    rows = rows.withColumn("run_1", F.transform("w", lambda x: F.xxhash64(x)))
    powers = [1 << i for i in range(max(lengths, default=1).bit_length())]
    for p in powers[1:]:
        rows = rows.withColumn(f"run_{p}", joined(f"run_{p // 2}", f"run_{p // 2}", p // 2, p))
    for n in lengths:
        name, done = None, 0
        for p in reversed(powers):
            if n & p:
                if name:
                    rows = rows.withColumn(f"part_{n}_{done + p}", joined(name, f"run_{p}", done, done + p))
                name, done = (f"part_{n}_{done + p}" if name else f"run_{p}"), done + p
        rows = rows.withColumn(f"hashes_{n}", F.col(name))
    return rows


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per different window: ``n`` (its words), ``hash``, ``run``
    (array of words) and ``items`` (ids of the items that hold it)."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    items = items.withColumn("n", F.least(F.size("w"), F.lit(window)))
    runs = items.select("item_id", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.slice("w", i, F.col("n")))).alias("run"))
    found = runs.groupBy("n", "run").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    found = with_hashes(found.withColumnRenamed("run", "w"), list(range(1, window + 1)))
    own = F.coalesce(*(F.when(F.col("n") == k, F.col(f"hashes_{k}")[0]) for k in range(1, window + 1)))
    return found.select("n", own.alias("hash"), F.col("w").alias("run"), "items")


def _places_in(hashes: str, keys: list[int]) -> Column:
    """The places of ``hashes`` whose hash is one of ``keys`` (a literal set)."""
    places = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0)))
    return F.filter(places, lambda i: F.get(hashes, i).isin(keys))


def _placed(n: int) -> Column:
    return F.transform(f"hashes_{n}", lambda h, i: F.struct(F.lit(n).alias("n"), i.alias("at"), h.alias("hash")))


def _runs_at(n: int) -> Column:
    """Place, length and words of each likely hit."""
    places = F.coalesce(f"at_{n}", F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.slice("w", i + 1, n).alias("run")))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_limit: int = SET_LIMIT, row: str | None = None) -> DataFrame:
    """One row per row of ``docs`` and verified occurrence: ``_row, doc_id,
    n_words, at`` (first word, from 0), ``n``, ``items``; and for each document
    at least one row, with ``at`` NULL if it has none."""
    found = staged(benchmark_windows(benchmark, window), "benchmark-windows")
    lengths = [r[0] for r in found.select("n").distinct().sort("n").collect()]  # at most `window` of them
    literal = found.count() <= set_limit  # then one pass over the rows, else two
    rows = number_rows(docs.select("doc_id", "text")) if literal and row is None else rows_of(docs, row)
    rows = with_hashes(rows.select("_row", "doc_id", words(F.col("text")).alias("w")), lengths)
    if literal:
        keys = {n: [r[0] for r in found.filter(F.col("n") == n).select("hash").distinct().collect()] for n in lengths}
        for n in lengths:
            rows = rows.withColumn(f"at_{n}", _places_in(f"hashes_{n}", keys[n]))
    else:
        flat = rows.select("_row", F.explode(F.concat(*map(_placed, lengths))).alias("x")).select("_row", "x.*")
        met = flat.join(found.select("n", "hash").distinct(), ["n", "hash"], "left_semi")
        met = met.groupBy("_row").agg(*(F.collect_list(F.when(F.col("n") == n, F.col("at"))).alias(f"at_{n}") for n in lengths))
        rows = rows.join(met, "_row", "left")
    runs = F.concat(*map(_runs_at, lengths)) if lengths else F.array().cast("array<struct<at:int,n:int,run:array<string>>>")
    likely = rows.select("_row", "doc_id", F.size("w").alias("n_words"), runs.alias("runs")).select(
        "_row", "doc_id", "n_words", F.explode_outer("runs").alias("x")).select("_row", "doc_id", "n_words", "x.*")
    # word by word: the runs themselves are compared
    same = likely.join(found.select(F.col("run").alias("real"), "items"), F.col("run") == F.col("real"), "left")
    hit = F.col("real").isNotNull()
    return same.select("_row", "doc_id", "n_words", F.when(hit, F.col("at")).alias("at"), F.when(hit, F.col("n")).alias("n"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_limit: int = SET_LIMIT, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``_row, doc_id, n_words, n_hit`` (words
    inside any hit), ``n_items`` and ``items`` (ids of items with a hit, as
    sorted strings), ``spans`` (first word and length of each hit) and
    ``contaminated``.

    NULL and empty texts have no words and no hits; items of no words match
    nothing; a NULL item_id is matched but cannot be listed; repeated rows
    count each for itself; an empty benchmark hits nothing.  ``row`` names a
    column of written row numbers; without it the rows are numbered."""
    by_row = hits(docs, benchmark, window, set_limit, row).groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("at").isNotNull(), F.struct("at", "n"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    inside = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))))
    return by_row.withColumn("n_hit", F.size(inside)).select(
        "_row", "doc_id", "n_words", "n_hit", F.size("items").alias("n_items"), "items", F.array_sort("spans").alias("spans"),
        (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns stay."""
    row = free_name(docs, "_leak_row")
    rows = with_row_id(docs, row)
    gone = contamination(rows, benchmark, window, row=row).filter("contaminated").select(F.col("_row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, clean_words``: each row's words without those inside a hit."""
    docs = with_row_id(docs.select("doc_id", "text"))
    found = contamination(docs, benchmark, window, row="_row").select(F.col("_row"), "spans")
    rows = docs.select("_row", "doc_id", words(F.col("text")).alias("w"))
    inside = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))
    return rows.join(found, "_row").withColumn("inside", inside).select(
        "doc_id", F.filter("w", lambda x, i: ~F.array_contains("inside", i)).alias("clean_words"))
