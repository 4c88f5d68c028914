"""The registered queries of this subpackage: each applies its operator to the
whole of its tables and derives the columns that are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from chatmill.session import scratch_path

from . import alignment, bpe, chat_format, collocations, decontaminate, exact_dedup, langid, line_dedup, lm, mixing, simhash, token_files, toxicity
from .common import fold_of, read, staged


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read(spark, sf_dir, "documents")).drop("_row")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = fold_of(F.col("doc_id"), 3)
    pick = F.pmod(F.xxhash64(F.lit("pick"), F.col("doc_id"), F.col("text")), F.lit(1 << 32))  # a row without an id has its own, too
    model = langid.fit(docs.filter(fold != 1).select("text", "lang", pick.alias("pick")))
    return langid.identify(docs, model).select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.labelled(docs, read(spark, sf_dir, "labels")))
    scored = toxicity.with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")
    return bpe.decode(encoded, vocabulary).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "n_split")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(read(spark, sf_dir, "documents")).drop("_row")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
                        F.col("n_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.read_tokens(spark, path)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.with_probe(spark, read(spark, sf_dir, "conversations"))
    out = staged(chat_format.format_turns(turns), "formatted")
    out = out.withColumn("turns", chat_format.parse(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(read(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).drop("row")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_simhash_near_dedup, op3_language_id, op4_toxicity, op5_lm_score, op6_byte_bpe, op7_exact_dedup, op8_decontaminate, op9_token_files, op10_chat_format,
    op11_collocations, op12_mixing, op13_alignment, pipeline)}
