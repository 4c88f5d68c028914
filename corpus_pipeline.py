"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, benchmark
decontamination, byte-level BPE.  Each stage takes all its predecessor kept;
its result is written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chatmill.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from chatmill.llm.common import read, staged

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more go.  It learns from
    the labelled documents of its input's training folds."""
    model = toxicity.fit(toxicity.labelled(docs, read(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id's row stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fingerprints linked within 3 bits the smallest doc_id's row stays."""
    return simhash.drop_near_duplicates(docs, shingle_words=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a run of 10 benchmark words (or a whole shorter item) go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids, their number and the bytes they decode to."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), with_decoded=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", tokenize),
]

#: toxicity scores, SimHash fingerprints and BPE ids have no SQL form; the tests run a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
