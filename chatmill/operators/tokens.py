"""Tokenization-stage operators: ChatML token ids, assistant-only labels,
truncation, statistics and batch padding.

Labels are built per message segment -- ``<|im_start|>``, ``role\\n``,
content, ``<|im_end|>``, ``\\n`` -- where assistant segments label their
content and end marker, everything else -100.  The segments are flattened
once and both arrays are sliced to the maximum length, so a turn cut by
truncation keeps what remains labelled.  (Scanning the token stream for
markers, as the reference does, mislabels content that itself contains a
marker; segments do not.)

The built-in tokenizer is a regex word/digit/punctuation splitter with hashed
ids, entirely JVM-side.  Any Python tokenizer can be plugged in through
``tokenize_with`` (``mapInPandas``: Arrow batches, one call per segment).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chat import IM_END, IM_START
from .ranking import dense_index, running_totals

IGNORE_INDEX = -100
PAD_MULTIPLE = 8
# word runs, single digits, whitespace runs, any other single character
TOKEN_RE = r"[A-Za-z]+|[0-9]|[\t\n\x{b}\x{c}\r ]+|[^A-Za-z0-9\t\n\x{b}\x{c}\r ]"


class RegexTokenizer:
    """Regex tokenizer with hashed ids in ``[0, vocab_size)`` and marker ids
    just above it."""

    def __init__(self, vocab_size: int = 65_536, pattern: str = TOKEN_RE):
        self.vocab_size = vocab_size
        self.pattern = pattern
        self.im_start_id = vocab_size
        self.im_end_id = vocab_size + 1
        self.pad_id = vocab_size + 2

    def pieces(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), 0)

    def ids(self, text: Column) -> Column:
        return F.transform(self.pieces(text),
                           lambda t: F.pmod(F.xxhash64(t), F.lit(self.vocab_size)).cast("int"))

    def count(self, text: Column) -> Column:
        return F.size(self.pieces(text))

    def marker_id(self, marker: str) -> int:
        return {IM_START: self.im_start_id, IM_END: self.im_end_id}[marker]


def tokenize_messages(df: DataFrame, tokenizer: RegexTokenizer | None = None, messages: str = "messages",
                      max_length: int = 2048) -> DataFrame:
    """Adds ``input_ids``, ``attention_mask``, ``labels`` (ARRAY<INT>) and
    ``full_length`` (tokens before truncation)."""
    tok = tokenizer or RegexTokenizer()
    start = F.array(F.lit(tok.im_start_id))
    end = F.array(F.lit(tok.im_end_id))
    staged = df.withColumn("_cm_parts", F.transform(F.col(messages), lambda m: F.struct(
        m["role"].alias("role"),
        tok.ids(F.concat(m["role"], F.lit("\n"))).alias("head"),
        tok.ids(m["content"]).alias("body"),
        tok.ids(F.lit("\n")).alias("nl"))))

    def seg_ids(p):
        return F.concat(start, p["head"], p["body"], end, p["nl"])

    def seg_labels(p):
        masked = lambda a: F.array_repeat(F.lit(IGNORE_INDEX), F.size(a))
        return F.when(p["role"] == "assistant",
                      F.concat(masked(start), masked(p["head"]), p["body"], end, masked(p["nl"]))
                      ).otherwise(masked(seg_ids(p)))

    staged = (staged.withColumn("_cm_ids", F.flatten(F.transform("_cm_parts", seg_ids)))
                    .withColumn("_cm_lab", F.flatten(F.transform("_cm_parts", seg_labels))))
    out = (staged.withColumn("full_length", F.size("_cm_ids"))
                 .withColumn("input_ids", F.slice("_cm_ids", 1, max_length))
                 .withColumn("labels", F.slice("_cm_lab", 1, max_length))
                 .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))))
    return out.drop("_cm_parts", "_cm_ids", "_cm_lab")


def tokenize_with(df: DataFrame, encode: Callable[[str], list[int]] | None = None, im_start_id: int = 0,
                  im_end_id: int = 1, messages: str = "messages", keep: list[str] | None = None,
                  max_length: int = 2048,
                  encode_batch: Callable[[list[str]], list[list[int]]] | None = None) -> DataFrame:
    """Same layout as :func:`tokenize_messages` with any Python tokenizer,
    run in Arrow batches by ``mapInPandas``.  Give ``encode(text) -> ids``
    or, faster, ``encode_batch(texts) -> ids per text`` (one call per Arrow
    batch, e.g. :func:`hf_tokenizer_encoder`).  ``keep`` columns pass
    through."""
    keep = keep or []
    if encode_batch is None:
        if encode is None:
            raise ValueError("give encode or encode_batch")
        enc = encode

        def encode_batch(texts):  # noqa: F811 - per-text fallback
            return [list(enc(t)) for t in texts]
    schema = T.StructType([df.schema[c] for c in keep] + [
        T.StructField("input_ids", T.ArrayType(T.IntegerType())),
        T.StructField("attention_mask", T.ArrayType(T.IntegerType())),
        T.StructField("labels", T.ArrayType(T.IntegerType())),
        T.StructField("full_length", T.IntegerType()),
    ])

    def run(batches):
        nl = list(encode_batch(["\n"])[0])
        for pdf in batches:
            convs = [list(m) if m is not None else [] for m in pdf[messages]]
            texts = []
            for conv in convs:
                for m in conv:
                    texts.append(f"{m['role']}\n")
                    texts.append(m["content"] or "")
            encoded = encode_batch(texts) if texts else []
            pos = 0
            ids_col, lab_col, mask_col, full_col = [], [], [], []
            for conv in convs:
                ids, labels = [], []
                for m in conv:
                    head, body = list(encoded[pos]), list(encoded[pos + 1])
                    pos += 2
                    seg = [im_start_id] + head + body + [im_end_id] + nl
                    ids += seg
                    if m["role"] == "assistant":
                        labels += [IGNORE_INDEX] * (1 + len(head)) + body + [im_end_id] + [IGNORE_INDEX] * len(nl)
                    else:
                        labels += [IGNORE_INDEX] * len(seg)
                full_col.append(len(ids))
                ids, labels = ids[:max_length], labels[:max_length]
                ids_col.append(ids)
                lab_col.append(labels)
                mask_col.append([1] * len(ids))
            out = pdf[keep].copy() if keep else pd.DataFrame(index=pdf.index)
            out["input_ids"] = ids_col
            out["attention_mask"] = mask_col
            out["labels"] = lab_col
            out["full_length"] = full_col
            yield out

    return df.select(*keep, messages).mapInPandas(run, schema)


_LOADED_TOKENIZERS: dict = {}


def hf_tokenizer_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """``encode_batch`` for a Hugging Face ``tokenizers`` JSON file (the
    model's own BPE).  The file is read once per Python worker; special
    tokens are not added (the chat markers are placed by the segments)."""

    def encode_batch(texts: list[str]) -> list[list[int]]:
        tok = _LOADED_TOKENIZERS.get(path)
        if tok is None:
            from tokenizers import Tokenizer
            tok = _LOADED_TOKENIZERS[path] = Tokenizer.from_file(path)
        return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]

    return encode_batch


def labeled_count(labels="labels") -> Column:
    lab = F.col(labels) if isinstance(labels, str) else labels
    return F.size(F.filter(lab, lambda x: x != IGNORE_INDEX))


def labeled_ids(input_ids="input_ids", labels="labels") -> Column:
    """Token ids whose label is not -100."""
    z = F.arrays_zip(F.col(input_ids).alias("i"), F.col(labels).alias("l"))
    return F.transform(F.filter(z, lambda x: x["l"] != IGNORE_INDEX), lambda x: x["i"])


def label_coverage(df: DataFrame) -> DataFrame:
    """Per example: total, labelled and masked tokens and labelled percent."""
    return (df.withColumn("total_tokens", F.size("input_ids"))
              .withColumn("labeled_tokens", labeled_count("labels"))
              .withColumn("masked_tokens", F.col("total_tokens") - F.col("labeled_tokens"))
              .withColumn("labeled_pct", F.when(F.col("total_tokens") > 0,
                                                 F.col("labeled_tokens").cast("double") * 100 / F.col("total_tokens"))))


def token_statistics(df: DataFrame, max_length: int, groups: list[str] | None = None) -> DataFrame:
    """Length statistics (per ``groups``, e.g. split) of the ids as cut to
    ``max_length``, and how much the cut takes: all tokens and the longest
    example before it, and the examples it shortens.  ``median`` keeps one
    counter per distinct length, which is bounded by ``max_length``; exact
    quantiles of uncut lengths: :func:`~.quantiles.exact_quantiles`."""
    length = F.size("input_ids")
    lab = labeled_count("labels")
    aggs = [
        F.count(F.lit(1)).alias("total_examples"),
        F.round(F.avg(length), 1).alias("avg_length"),
        F.round(F.median(length), 1).alias("median_length"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
        F.round(F.coalesce(F.stddev_samp(length), F.lit(0.0)), 1).alias("stdev_length"),
        F.round(F.avg(lab), 1).alias("avg_labeled_tokens"),
        F.sum(length).alias("total_tokens"),
        F.sum(lab).alias("total_labeled_tokens"),
        F.round(F.avg(F.when(length >= max_length, 1.0).otherwise(0.0)) * 100, 1).alias("pct_at_max_length"),
    ]
    if "full_length" in df.columns:
        full = F.col("full_length")
        aggs += [F.sum(full).alias("total_tokens_uncut"), F.max(full).alias("max_length_uncut"),
                 F.count_if(full > max_length).alias("examples_cut")]
    return df.groupBy(*(groups or [])).agg(*aggs)


def truncate_prompt(df: DataFrame, ids: str = "prompt_ids", limit: int = 3584) -> DataFrame:
    """Right truncation of prompt ids with a flag."""
    return (df.withColumn("was_truncated", F.size(ids) > limit)
              .withColumn(ids, F.slice(ids, 1, limit)))


def pad_batches(df: DataFrame, order: list[str], batch_size: int, pad_id: int,
                multiple: int = PAD_MULTIPLE) -> DataFrame:
    """Dynamic padding: consecutive rows (in ``order``) form batches; each row
    is padded to the batch's longest row rounded up to ``multiple``.  Batches
    are bounded, so the per-batch window never holds more than
    ``batch_size`` rows."""
    idx = dense_index(df, order, out="_cm_idx")
    batched = idx.withColumn("batch", F.floor(F.col("_cm_idx") / batch_size))
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch"))
    target = (F.ceil(longest / multiple) * multiple).cast("int")
    pad = F.col("_cm_pad")
    return (batched.withColumn("padded_length", target)
                   .withColumn("_cm_pad", F.col("padded_length") - F.size("input_ids"))
                   .withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), pad)))
                   .withColumn("attention_mask", F.concat("attention_mask", F.array_repeat(F.lit(0), pad)))
                   .withColumn("labels", F.concat("labels", F.array_repeat(F.lit(IGNORE_INDEX), pad)))
                   .drop("_cm_idx", "_cm_pad"))


def turn_label_coverage(turns: DataFrame, conv: str, turn: str, role: str, text: str,
                        tokenizer: RegexTokenizer | None = None, max_length: int = 2048) -> DataFrame:
    """Label coverage per conversation from a table of turns, without
    building a conversation array: token counts per turn, each turn's offset
    from block-wise running sums, the labelled span of assistant turns cut
    at ``max_length``, then per-conversation sums (combined map-side).  A
    conversation holding a huge share of all turns never lands whole in one
    task.  Same numbers as ``label_coverage(tokenize_messages(..))``."""
    tok = tokenizer or RegexTokenizer()
    t = (turns.select(conv, turn, role, tok.count(F.col(text)).alias("_c"),
                      tok.count(F.concat(F.col(role), F.lit("\n"))).alias("_h"))
              .withColumn("_m", F.col("_c") + F.col("_h") + 3))
    rt = running_totals(t, [conv], turn, {"m": F.col("_m")})
    s = F.col("running_m") - F.col("_m")
    start = s + 1 + F.col("_h")
    lab = F.when(F.col(role) == "assistant",
                 F.greatest(F.lit(0), F.least(start + F.col("_c") + 1, F.lit(max_length)) - start)).otherwise(F.lit(0))
    per = rt.groupBy(conv).agg(F.sum("_m").alias("_full"), F.sum(lab).alias("labeled_tokens"),
                               F.count(F.lit(1)).alias("turns"))
    return (per.withColumn("total_tokens", F.least(F.col("_full"), F.lit(max_length)))
               .withColumn("masked_tokens", F.col("total_tokens") - F.col("labeled_tokens"))
               .withColumn("labeled_pct", F.when(F.col("total_tokens") > 0,
                                                 F.col("labeled_tokens").cast("double") * 100 / F.col("total_tokens")))
               .drop("_full"))
