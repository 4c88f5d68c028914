"""Registered queries: each reads the driver tables from ``sf_dir`` and runs
one capability of the engine over whole tables.  ``oracle.py`` holds the
equivalent DuckDB SQL for the correctness gate.

The driver tables are not chat corpora, so each query first maps a table to
the raw shape the capability expects (e.g. a document becomes a
question/answer pair: first line / rest).  The same mapping is written in
the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions.chat import content_hash, messages_fingerprint, render_chat, roles_text
from ..functions.text import alnum_count, is_valid_content, normalize_text
from ..operators import convert as C
from ..operators import mix as M
from ..operators import report as R
from ..operators import score as S
from ..operators import tokens as TK
from ..operators.dedup import keep_first
from ..operators.outcomes import classify_lines, outcome_counts_single_pass, outcome_summary
from ..operators.verify import required_key_check
from ..sources.jsonl import parse_json
from ..sources.registry import baselines_df
from ..session import materialize
from ..sources.tables import read_table, read_text_table

DEFAULT_SYSTEM = C.DEFAULT_SYSTEM
SEED = 42
MAX_LEN = 2048
PAD_BATCH = 8


# tables with regex-heavy per-row work, and the key their scan is spread on
# (unique per row, so the spread is even even when one conversation is hot)
_TEXT_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": ["conv_id", "turn"],
              "benchmark": "item_id", "orders": "o_orderkey", "events": "event_id"}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name in _TEXT_KEYS:
        return read_text_table(spark, sf, name, _TEXT_KEYS[name])
    return read_table(spark, sf, name)


# --- table -> raw shape adapters -------------------------------------------

def doc_triples(spark, sf, keep_text: bool = False) -> DataFrame:
    """documents -> (system_prompt = source, question = first line,
    response = the rest)."""
    d = _t(spark, sf, "documents")
    nl = F.instr(F.col("text"), "\n")
    return d.select(
        "doc_id", "source", "lang", *(["text"] if keep_text else []),
        F.col("source").alias("system_prompt"),
        F.substring_index(F.col("text"), "\n", 1).alias("question"),
        F.when(nl > 0, F.expr("substr(text, instr(text, '\n') + 1)")).otherwise(F.lit("")).alias("response"))


def doc_messages(spark, sf) -> DataFrame:
    return C.drop_failed(C.convert_triples(doc_triples(spark, sf), default_system=DEFAULT_SYSTEM))


def conv_turn_arrays(spark, sf) -> DataFrame:
    """conversations -> one row per conversation with its turns in order.
    A conversation is one example, so the group is bounded."""
    # the groupBy shuffle spreads the per-conversation work: no spread here
    c = read_table(spark, sf, "conversations")
    return c.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def conv_raw_messages(spark, sf) -> DataFrame:
    """Turns as messages without cleaning (role and text as stored)."""
    return conv_turn_arrays(spark, sf).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"),
                                                           t["text"].alias("content"))).alias("messages"))


# --- text -------------------------------------------------------------------

def q_normalize_text(spark, sf):
    n = normalize_text(F.col("text"))
    d = _t(spark, sf, "documents").select("doc_id", n.alias("t"))
    return d.select("doc_id", F.length("t").alias("norm_length"), F.md5("t").alias("norm_md5"))


def q_quality_filter(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", normalize_text(F.col("text")).alias("t"))
    return (d.filter(is_valid_content(F.col("t")))
             .select("doc_id", F.length("t").alias("norm_length"), alnum_count(F.col("t")).alias("alnum_chars")))


# --- converters -------------------------------------------------------------

def q_convert_turns(spark, sf):
    conv = conv_turn_arrays(spark, sf).select(
        "conv_id", F.transform("turns", lambda t: F.struct(
            F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt")
             .otherwise(t["role"]).alias("from"),
            t["text"].alias("value"))).alias("conversations"))
    out = C.drop_failed(C.convert_turns(conv, default_system=DEFAULT_SYSTEM))
    kept_system = F.exists("conversations", lambda t: (t["from"] == "system") & is_valid_content(normalize_text(t["value"])))
    return out.select("conv_id", F.size("messages").alias("n_messages"), roles_text("messages").alias("roles"),
                      kept_system.alias("has_system_turn"),
                      messages_fingerprint("messages").alias("fingerprint"))


def conv_alternating(spark, sf) -> DataFrame:
    conv = conv_turn_arrays(spark, sf).select("conv_id", F.transform("turns", lambda t: t["text"]).alias("data"))
    return C.convert_alternating(conv, default_system=DEFAULT_SYSTEM)


def q_convert_alternating(spark, sf):
    out = C.drop_failed(conv_alternating(spark, sf))
    return out.select("conv_id", F.size("messages").alias("n_messages"), roles_text("messages").alias("roles"),
                      messages_fingerprint("messages").alias("fingerprint"))


def q_convert_triples(spark, sf):
    out = doc_messages(spark, sf)
    return out.select("doc_id",
                      (F.col("messages")[0]["content"] == F.lit(DEFAULT_SYSTEM)).alias("system_is_default"),
                      messages_fingerprint("messages").alias("fingerprint"))


def q_convert_code_pairs(spark, sf):
    p = _t(spark, sf, "pages").select(
        "page_id", F.col("html").alias("func_code_string"),
        F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("func_documentation_string"),
        F.lit("html").alias("language"))
    out = C.drop_failed(C.convert_code_pairs(p, default_system=DEFAULT_SYSTEM))
    return out.select("page_id", F.length(F.col("messages")[1]["content"]).alias("user_length"),
                      F.length(F.col("messages")[2]["content"]).alias("assistant_length"),
                      messages_fingerprint("messages").alias("fingerprint"))


def order_qa(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" was placed by customer "),
                 F.col("o_custkey").cast("string"), F.lit(". What is its status and priority?")).alias("question"),
        F.concat(F.lit("Status "), F.col("o_orderstatus"), F.lit(", priority "), F.col("o_orderpriority"),
                 F.lit(".")).alias("answer"))


def q_convert_qa(spark, sf):
    out = C.drop_failed(C.convert_qa(order_qa(spark, sf), default_system=DEFAULT_SYSTEM))
    return out.select("o_orderkey", messages_fingerprint("messages").alias("fingerprint"))


# --- dedup and cleaning outcomes --------------------------------------------

def q_dedup_first(spark, sf):
    # convert and key every document once; both dedup passes read the
    # checkpointed light keys
    keyed = materialize(doc_messages(spark, sf).select("doc_id", "source",
                                                        content_hash("messages").alias("content_key")))
    kept = keep_first(keyed, ["source", "content_key"], "doc_id")
    return kept.select("doc_id", "source", "content_key")


def doc_json_lines(spark, sf) -> DataFrame:
    """documents as raw JSON lines of the triple shape; a document without a
    line break cannot be split and is written as plain text (not JSON)."""
    t = doc_triples(spark, sf, keep_text=True)
    line = F.when(F.instr(F.col("text"), "\n") > 0,
                  F.to_json(F.struct("system_prompt", "question", "response"))).otherwise(F.col("text"))
    return (t.select("doc_id", "source", line.alias("value"))
             .withColumn("parsed", parse_json("value")))


def q_clean_outcomes(spark, sf):
    """Per-source outcome counts with a Total row (one pass)."""
    conv = C.convert_parsed(doc_json_lines(spark, sf), "triples", default_system=DEFAULT_SYSTEM)
    keyed = conv.withColumn("content_key", F.when(F.col("messages").isNotNull(), content_hash("messages")))
    return outcome_summary(outcome_counts_single_pass(keyed, "source"), "source")


def q_clean_rows(spark, sf):
    """Row-level outcome of every line (first copy kept per source)."""
    classified = classify_lines(doc_json_lines(spark, sf), "triples", default_system=DEFAULT_SYSTEM,
                                scope="source", order="doc_id", keep_messages=False, materialize=True)
    return classified.select("doc_id", "source", "outcome", "content_key")


def q_manifest_summary(spark, sf):
    """Cleaning-manifest totals: sources, input, output, dropped, and how
    many sources kept every line."""
    per = q_clean_outcomes(spark, sf).filter(F.col("source") != "Total")
    return per.agg(F.count(F.lit(1)).alias("sources"), F.sum("input").alias("total_input"),
                   F.sum("output").alias("total_output"), F.sum("dropped").alias("total_dropped"),
                   F.count_if(F.col("dropped") == 0).alias("sources_without_drops"))


def q_validate_examples(spark, sf):
    out = C.drop_failed(conv_alternating(spark, sf))
    return out.select("conv_id", F.size("messages").alias("n_messages"),
                      M.is_valid_example("messages").alias("valid_example"))


# --- mixing -----------------------------------------------------------------

def doc_sampling_config(spark, sf) -> DataFrame:
    """Per document source: a cap and a weight (rule below, mirrored in SQL):
    src0 no cap (NULL), src1 cap 0 (= no cap), src2 cap 1000 (> size),
    others cap 40; weight 2.5 for src3, 0.5 for src4, 3.0 for src5, else 1."""
    s = read_table(spark, sf, "documents").select("source").distinct()
    cap = (F.when(F.col("source") == "src0", F.lit(None).cast("bigint"))
            .when(F.col("source") == "src1", F.lit(0).cast("bigint"))
            .when(F.col("source") == "src2", F.lit(1000).cast("bigint"))
            .otherwise(F.lit(40).cast("bigint")))
    weight = (F.when(F.col("source") == "src3", F.lit(2.5)).when(F.col("source") == "src4", F.lit(0.5))
               .when(F.col("source") == "src5", F.lit(3.0)).otherwise(F.lit(1.0)))
    return s.select("source", weight.alias("weight"), cap.alias("max_samples"), F.lit("instruction").alias("category"))


def q_cap_per_source(spark, sf):
    # light columns only: no need to spread the scan for CPU-heavy work
    d = read_table(spark, sf, "documents").select("doc_id", "source")
    return M.cap_per_source(d, doc_sampling_config(spark, sf), "doc_id", SEED).select("source", "doc_id")


def q_oversample(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "source")
    cfg = doc_sampling_config(spark, sf)
    capped = materialize(M.cap_per_source(d, cfg, "doc_id", SEED))
    return M.oversample(capped, cfg, "doc_id", SEED).select("source", "doc_id", "copy")


def q_oversample_fractional(spark, sf):
    """Only the extra copies drawn for fractional weights (seed + 1)."""
    d = read_table(spark, sf, "documents").select("doc_id", "source")
    cfg = doc_sampling_config(spark, sf)
    capped = materialize(M.cap_per_source(d, cfg, "doc_id", SEED))
    over = M.oversample(capped, cfg, "doc_id", SEED)
    frac = F.broadcast(cfg.filter(F.col("weight") > F.floor("weight"))
                       .filter(F.col("weight") > 1)
                       .select("source", F.floor("weight").cast("int").alias("copy")))
    return over.join(frac, ["source", "copy"], "left_semi").select("source", "doc_id", "copy")


def mixed_ids(spark, sf) -> DataFrame:
    """(source, doc_id, copy) of the mixed corpus."""
    cfg = doc_sampling_config(spark, sf)
    raw = doc_triples(spark, sf)
    convert = lambda r: C.convert_triples(r, default_system=DEFAULT_SYSTEM)
    # rows that failed conversion still take cap slots, then fail validation;
    # messages are built only for rows that survive the caps
    light = read_table(spark, sf, "documents").select("doc_id", "source")
    return M.mix_sources(raw, cfg, "doc_id", SEED, prepare=convert, light=light)


def mixed_split(spark, sf) -> DataFrame:
    key = M.seeded_key(SEED, "source", "doc_id", "copy")
    return M.exact_split(mixed_ids(spark, sf), key, ["source", "doc_id", "copy"])


def q_mix_split(spark, sf):
    return mixed_split(spark, sf).select("source", "doc_id", "copy", "split")


def q_source_distribution(spark, sf):
    train = mixed_split(spark, sf).filter(F.col("split") == "train")
    return M.source_distribution(train, "source").select("source", "count", "percent")


def q_split_leakage(spark, sf):
    return M.split_leakage(mixed_split(spark, sf), ["source", "doc_id"]).select("source", "doc_id", "n_splits", "copies")


# --- tokenization -----------------------------------------------------------

def q_render_chat(spark, sf):
    m = conv_raw_messages(spark, sf).withColumn("chat", render_chat("messages"))
    return m.select("conv_id", F.length("chat").alias("chat_length"), F.md5("chat").alias("chat_md5"))


def q_token_stats(spark, sf):
    tok = TK.tokenize_messages(doc_messages(spark, sf), max_length=MAX_LEN)
    return TK.token_statistics(tok, MAX_LEN)


def q_label_coverage(spark, sf):
    """Turn-level: no conversation array is built (skew-safe)."""
    cov = TK.turn_label_coverage(_t(spark, sf, "conversations"), "conv_id", "turn", "role", "text", max_length=MAX_LEN)
    return cov.select("conv_id", "total_tokens", "labeled_tokens", "masked_tokens", "labeled_pct")


def q_label_coverage_arrays(spark, sf):
    """Array form: tokenize whole conversations, then count labels."""
    tok = TK.tokenize_messages(conv_raw_messages(spark, sf), max_length=MAX_LEN)
    return TK.label_coverage(tok).select("conv_id", "total_tokens", "labeled_tokens", "masked_tokens", "labeled_pct")


def q_label_mask(spark, sf):
    """Where the labels sit: count, first and last labelled position (0-based)
    of each tokenized conversation."""
    tok = TK.tokenize_messages(conv_raw_messages(spark, sf), max_length=MAX_LEN)
    hit = F.transform("labels", lambda x: x != TK.IGNORE_INDEX)
    first = F.array_position(hit, True)
    last_from_end = F.array_position(F.reverse(hit), True)
    return tok.select("conv_id", TK.labeled_count("labels").alias("labeled_tokens"),
                      F.when(first > 0, first - 1).alias("first_labeled"),
                      F.when(last_from_end > 0, F.size("labels") - last_from_end).alias("last_labeled"))


def q_pad_batches(spark, sf):
    tok = TK.tokenize_messages(conv_raw_messages(spark, sf), max_length=MAX_LEN)
    padded = TK.pad_batches(tok, ["conv_id"], PAD_BATCH, TK.RegexTokenizer().pad_id)
    return padded.select("conv_id", "batch", "padded_length",
                         F.size("input_ids").alias("ids_length"), TK.labeled_count("labels").alias("labeled_tokens"))


# --- benchmark scoring ------------------------------------------------------

def part_choices(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part")
    return p.select(
        "p_partkey",
        F.concat(F.lit("Which of these describes part "), F.col("p_name"), F.lit("?")).alias("question"),
        F.array(F.col("p_brand"), F.col("p_type"), F.col("p_name"),
                F.concat(F.lit("Size "), F.col("p_size").cast("string")), F.lit("None of these")).alias("choices"))


def q_build_choice_prompts(spark, sf):
    pr = part_choices(spark, sf).withColumn("prompt", A.choice_prompt(F.col("question"), F.col("choices")))
    return pr.select("p_partkey", F.length("prompt").alias("prompt_length"), F.md5("prompt").alias("prompt_md5"))


def doc_responses(spark, sf) -> DataFrame:
    """English documents wrapped in a fenced block, others left bare."""
    d = _t(spark, sf, "documents")
    resp = F.when(F.col("lang") == "en",
                  F.concat(F.lit("Here is the code:\n```python\n"), F.col("text"), F.lit("\n```\nDone.")))
    return d.select("doc_id", F.coalesce(resp, F.col("text")).alias("response"))


def q_extract_code(spark, sf):
    r = doc_responses(spark, sf).withColumn("code", A.extract_code(F.col("response")))
    return r.select("doc_id", F.length("code").alias("code_length"), F.md5("code").alias("code_md5"))


def order_numeric(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Gold: '#### <total quantity>' per order with lines; prediction: a
    sentence ending with the quantity of its first six lines."""
    li = _t(spark, sf, "lineitem")
    per = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").cast("bigint").alias("qty"),
        F.sum(F.when(F.col("l_linenumber") <= 6, F.col("l_quantity"))).cast("bigint").alias("qty6"))
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("item_id"))
    gold = (o.join(per, o.item_id == per.l_orderkey)
             .select("item_id", F.concat(F.lit("#### "), F.format_number(F.col("qty"), 0)).alias("answer")))
    pred = per.filter(F.col("qty6").isNotNull()).select(
        F.col("l_orderkey").alias("item_id"),
        F.concat(F.lit("Summing "), F.col("n_lines").cast("string"), F.lit(" lines gives "),
                 F.col("qty6").cast("string"), F.lit(".")).alias("response"))
    return gold, pred


def q_numeric_answers(spark, sf):
    gold, pred = order_numeric(spark, sf)
    g = S.grade_numeric(gold, pred)
    return g.select(F.col("item_id").alias("o_orderkey"), "ground_truth", "predicted", "correct")


def event_choices(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Gold: answer = event_id % 4, subject = event_type-<k div 10>.
    Prediction text in five styles chosen by user_id % 5."""
    e = _t(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    gold = e.select(F.col("event_id").alias("item_id"), (F.col("event_id") % 4).cast("int").alias("answer"),
                    F.concat(F.col("event_type"), F.lit("-"), F.floor(k / 10).cast("string")).alias("subject"))
    letter = F.substring(F.lit("ABCD"), ((F.col("event_id") + F.col("user_id")) % 4 + 1).cast("int"), 1)
    style = F.col("user_id") % 5
    resp = (F.when(style == 0, letter)
             .when(style == 1, F.concat(F.lit("Answer: "), letter))
             .when(style == 2, F.concat(F.lit("The ("), letter, F.lit(")")))
             .when(style == 3, F.lit("zzz"))
             .otherwise(F.concat(F.lower(letter), F.lit(" is right"))))
    pred = e.select(F.col("event_id").alias("item_id"), resp.alias("response"))
    return gold, pred


def graded_choices(spark, sf) -> DataFrame:
    gold, pred = event_choices(spark, sf)
    return S.grade_choice(gold, pred)


def q_choice_accuracy_by_subject(spark, sf):
    return S.subject_accuracy(graded_choices(spark, sf), "subject", "item_id").select(
        "subject", "correct", "total", "accuracy")


def q_running_accuracy(spark, sf):
    g = graded_choices(spark, sf)
    e = read_table(spark, sf, "events").select(F.col("event_id").alias("item_id"), "event_type")
    ra = S.running_accuracy(g.join(e, "item_id"), "item_id", ["event_type"], every=S.REPORT_EVERY["gsm8k"])
    return ra.select(F.col("item_id").alias("event_id"), "event_type", "running_rows", "running_correct",
                     "running_accuracy", "is_report_point")


def benchmark_results(spark, sf) -> DataFrame:
    lab = _t(spark, sf, "labels").withColumn("passed", F.col("quality") == 1)
    code = S.accuracy(lab, "humaneval", "pass@1", "passed")
    gold, pred = order_numeric(spark, sf)
    math = S.accuracy(S.grade_numeric(gold, pred), "gsm8k")
    mc = S.accuracy(graded_choices(spark, sf), "mmlu")
    return code.unionByName(math).unionByName(mc)


def q_baseline_delta(spark, sf):
    r = R.with_baselines(benchmark_results(spark, sf), baselines_df(spark))
    return r.select("benchmark", "metric", "score", "correct", "total", "baseline", "delta",
                    R.terminal_delta(F.col("delta")).alias("delta_text"),
                    R.markdown_delta(F.col("delta")).alias("delta_markdown"))


def q_report_summary(spark, sf):
    return R.report_summary(benchmark_results(spark, sf), baselines_df(spark))


def q_subject_top_bottom(spark, sf):
    subj = S.subject_accuracy(graded_choices(spark, sf), "subject", "item_id")
    return R.top_bottom_subjects(subj, 10).select("list", "position", "subject", "accuracy")


def q_pass_at_k(spark, sf):
    """Unbiased pass@k per document source: n = labelled documents, c = those
    with quality 1 (stand-in for sampled completions that pass)."""
    lab = read_table(spark, sf, "labels").join(read_table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    g = lab.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 1).alias("c"))
    return g.select("source", "n", "c", F.round(A.pass_at_k(F.col("n"), F.col("c"), 10), 6).alias("pass_at_10"))


# --- verification -----------------------------------------------------------

EVENT_CONTRACTS = [("view", ["k"]), ("click", ["k"]), ("purchase", ["k", "amount"]),
                   ("signup", ["k"]), ("error", ["code", "k"])]


def q_required_fields(spark, sf):
    e = read_table(spark, sf, "events").select(F.col("event_type").alias("name"), F.col("event_id").alias("seq"),
                                       F.col("props").alias("value"))
    contracts = spark.createDataFrame(EVENT_CONTRACTS, "name string, required array<string>")
    return required_key_check(e, contracts).select("name", "lines_checked", "first_failing_line",
                                                   "missing_field", "passed")


def q_file_verdicts(spark, sf):
    """Each document source as a JSON-lines file (the triple shape): parse
    check, field contract, line count against the documents per source,
    verdict."""
    from ..operators.verify import line_verdicts
    lines = doc_json_lines(spark, sf).select(F.col("source").alias("name"), F.col("doc_id").alias("seq"), "value")
    contracts = (lines.select("name").distinct()
                 .withColumn("required", F.array(*[F.lit(k) for k in ("system_prompt", "question", "response")])))
    expected = (read_table(spark, sf, "documents").groupBy(F.col("source").alias("name"))
                .agg(F.count(F.lit(1)).alias("num_examples")))
    v = line_verdicts(lines, contracts, "name", "seq", "value", expected)
    return v.select("name", "line_count", "first_bad_line", "parse_ok", "fields_ok", "missing_field", "fields_line",
                    "count_ok", "passed")


# --- ingest, holdout, reports, re-aimed stages ---------------------------------

def doc_registry(spark, sf) -> DataFrame:
    """A registry over the document sources (rule mirrored in SQL): src18 and
    src19 are evaluation sets, src17 has no converter, the rest are training
    sources with the triple shape."""
    s = _t(spark, sf, "documents").select("source").distinct()
    cat = F.when(F.col("source").isin("src18", "src19"), F.lit("evaluation")).otherwise(F.lit("instruction"))
    shape = F.when(F.col("source") == "src17", F.lit(None).cast("string")).otherwise(F.lit("triples"))
    return s.select(F.col("source").alias("name"), cat.alias("category"), shape.alias("shape"))


def q_holdout_sources(spark, sf):
    from ..sources.registry import holdout_filter
    d = read_table(spark, sf, "documents").select("doc_id", "source")
    kept = holdout_filter(d, doc_registry(spark, sf), "source")
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))


def q_capped_ingest(spark, sf):
    from ..sources.ingest import capped_ingest
    d = read_table(spark, sf, "documents").select("doc_id", "source")
    return capped_ingest(d, ["source"], "doc_id", 25).select("source", "doc_id")


def q_json_roundtrip(spark, sf):
    """Prepared-dataset encoding (messages as JSON text, source defaulted to
    'unknown') parsed back into nested messages."""
    from ..sinks.writers import prepared_columns
    from ..sources.jsonl import messages_from_json
    m = (conv_raw_messages(spark, sf).withColumn("split", F.lit("train"))
         .withColumn("source", F.lit(None).cast("string")))
    back = prepared_columns(m, keep=["conv_id"]).withColumn("parsed", messages_from_json("messages"))
    return back.select("conv_id", "source", F.size("parsed").alias("n_messages"),
                       messages_fingerprint("parsed").alias("fingerprint"))


def q_benchmark_prompts(spark, sf):
    b = read_table(spark, sf, "benchmark")
    p = b.select("item_id", A.code_prompt(F.col("text")).alias("code"), A.math_prompt(F.col("text")).alias("math"))
    return p.select("item_id", F.length("code").alias("code_prompt_length"), F.md5("code").alias("code_prompt_md5"),
                    F.length("math").alias("math_prompt_length"), F.md5("math").alias("math_prompt_md5"))


def q_choice_details(spark, sf):
    """Detail rows of every graded item, with the whole question text."""
    g = graded_choices(spark, sf).join(read_table(spark, sf, "events").select(F.col("event_id").alias("item_id"), "props"),
                                       "item_id")
    return S.detail_rows(g, {"item_id": F.col("item_id"), "question": F.col("props"), "subject": F.col("subject"),
                             "ground_truth": F.col("ground_truth"), "predicted": F.col("predicted"), "correct": F.col("correct")})


def q_markdown_report(spark, sf):
    r = R.with_baselines(benchmark_results(spark, sf), baselines_df(spark))
    line = R.markdown_result_line(F.col("benchmark"), F.col("metric"), F.col("score"), F.col("baseline"),
                                  F.col("delta"))
    return r.select("benchmark", line.alias("line"))


def q_clean_summary_table(spark, sf):
    from ..sinks.writers import summary_table_row
    counts = q_clean_outcomes(spark, sf).filter(F.col("source") != "Total")
    row = summary_table_row(F.col("source"), F.lit("success"), F.col("input"), F.col("output"), F.col("dropped"),
                            F.lit(0).cast("bigint"))
    return counts.select(F.inline(F.array(row)))


def q_training_plan(spark, sf):
    from ..operators.serving import profiles_df, training_plan
    train = mixed_split(spark, sf).filter(F.col("split") == "train").agg(F.count(F.lit(1)).alias("train_examples"))
    return training_plan(train, profiles_df(spark)).select(
        "profile", "train_examples", "total_steps", "warmup_steps", "effective_batch")


def q_request_validation(spark, sf):
    from ..operators.serving import validate_requests
    e = read_table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    req = e.select(
        "event_id",
        F.when(F.col("event_type") == "signup", F.array().cast("array<struct<role:string,content:string>>"))
         .otherwise(F.array(F.struct(F.lit("user").alias("role"), F.col("event_type").alias("content"))))
         .alias("messages"),
        (F.col("value") / 100).alias("temperature"),
        (F.col("user_id") * 30).alias("max_tokens"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(k / F.lit(100.0)).alias("top_p"),
        (F.lit(1.0) + k / F.lit(50.0)).alias("repetition_penalty"))
    return validate_requests(req).select("event_id", "temperature", "max_tokens", "top_p", "repetition_penalty",
                                         "valid", "reason")


def q_usage(spark, sf):
    from ..operators.serving import usage
    cov = TK.turn_label_coverage(_t(spark, sf, "conversations"), "conv_id", "turn", "role", "text", max_length=1 << 40)  # whole conversations
    base = cov.select("conv_id", F.col("masked_tokens").alias("prompt_tokens"),
                      F.col("labeled_tokens").alias("completion_tokens"),
                      (F.col("turns") - 2).alias("elapsed"))
    return usage(base, "prompt_tokens", "completion_tokens", "elapsed").select(
        "conv_id", "prompt_tokens", "completion_tokens", "total_tokens", "tokens_per_second")


# --- streaming --------------------------------------------------------------

def q_incremental_clean(spark, sf):
    from ..streaming.incremental import incremental_distinct_keys
    return incremental_distinct_keys(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_text": q_normalize_text,
    "quality_filter": q_quality_filter,
    "convert_turns": q_convert_turns,
    "convert_alternating": q_convert_alternating,
    "convert_triples": q_convert_triples,
    "convert_code_pairs": q_convert_code_pairs,
    "convert_qa": q_convert_qa,
    "dedup_first": q_dedup_first,
    "clean_outcomes": q_clean_outcomes,
    "clean_rows": q_clean_rows,
    "manifest_summary": q_manifest_summary,
    "validate_examples": q_validate_examples,
    "cap_per_source": q_cap_per_source,
    "oversample": q_oversample,
    "oversample_fractional": q_oversample_fractional,
    "mix_split": q_mix_split,
    "source_distribution": q_source_distribution,
    "split_leakage": q_split_leakage,
    "render_chat": q_render_chat,
    "token_stats": q_token_stats,
    "label_coverage": q_label_coverage,
    "label_coverage_arrays": q_label_coverage_arrays,
    "label_mask": q_label_mask,
    "pad_batches": q_pad_batches,
    "build_choice_prompts": q_build_choice_prompts,
    "extract_code": q_extract_code,
    "numeric_answers": q_numeric_answers,
    "choice_accuracy_by_subject": q_choice_accuracy_by_subject,
    "running_accuracy": q_running_accuracy,
    "baseline_delta": q_baseline_delta,
    "report_summary": q_report_summary,
    "subject_top_bottom": q_subject_top_bottom,
    "pass_at_k": q_pass_at_k,
    "required_fields": q_required_fields,
    "file_verdicts": q_file_verdicts,
    "incremental_clean": q_incremental_clean,
    "holdout_sources": q_holdout_sources,
    "capped_ingest": q_capped_ingest,
    "json_roundtrip": q_json_roundtrip,
    "benchmark_prompts": q_benchmark_prompts,
    "choice_details": q_choice_details,
    "markdown_report": q_markdown_report,
    "clean_summary_table": q_clean_summary_table,
    "training_plan": q_training_plan,
    "request_validation": q_request_validation,
    "usage": q_usage,
}
