"""Registered queries, part two: JSON scans, mixed shapes, shuffled output and
whole-table statistics.  ``corpus_sql.py`` holds their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions import sql
from ..functions.chat import content_hash, messages_fingerprint
from ..functions.text import title_from_key
from ..operators import convert as C
from ..operators import report as R
from ..operators import score as S
from ..operators import tokens as TK
from ..operators.quantiles import exact_quantiles
from ..operators.shuffle import prefix_split, shuffled
from ..operators.verify import check_table, verdicts
from ..session import scratch_path, write_once
from ..sinks.observed import counts_table, write_counted
from ..sources.digest import merged, split_digests
from ..sources.ingest import capped_scan
from ..sources.jsonl import number_lines, parse_json, read_lines
from ..sources.registry import TRAIN_RATIO, baselines_df
from ..sources.tables import read_table
from ..streaming import requests
from ..streaming.incremental import run_to_completion
from ..streaming.keep_first import changes, first_copies
from ..streaming.requests import run_requests
from .queries import DEFAULT_SYSTEM, MAX_LEN, SEED, benchmark_results, doc_json_lines, doc_messages, doc_triples, event_choices, graded_choices, mixed_ids, mixed_split, order_numeric

# --- shuffled output ----------------------------------------------------------


def q_shuffled_order(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every example of the mixed corpus in the shuffled order, and
    the split that the place decides."""
    placed = shuffled(mixed_ids(spark, sf), ["source", "doc_id", "copy"], SEED)
    return prefix_split(placed, TRAIN_RATIO).select("source", "doc_id", "copy", "position", "split")


# --- JSON lines ------------------------------------------------------------------

def odd_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """documents as JSON lines of the triple shape, with what json.loads takes
    and does not take mixed in by doc_id: special numbers, a repeated key, text
    after the value, two values, white space around, an array."""
    line = F.to_json(F.struct("system_prompt", "question", "response"))
    rest = F.expr("substr(line, 2)")
    kind = F.pmod("doc_id", F.lit(12))
    odd = (F.when(kind == 5, F.concat(F.lit('{"score":NaN,'), rest))
            .when(kind == 6, F.concat(F.lit('{"question":"the first of two","n":1,"n":2,'), rest))
            .when(kind == 7, F.concat("line", F.lit(" trailing")))
            .when(kind == 8, F.concat("line", "line"))
            .when(kind == 9, F.concat(F.lit("  "), "line", F.lit(" \t")))
            .when(kind == 10, F.concat(F.lit("["), "line", F.lit("]")))
            .when(kind == 11, F.concat(F.lit('{"low":-Infinity,"note":"NaN and \\"Infinity\\"",'), rest))
            .otherwise(F.col("line")))
    return doc_triples(spark, sf).withColumn("line", line).select("doc_id", "source", odd.alias("value"))


def q_json_lines_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written to files (a folder per source) and scanned back: physical
    line number in the source, whether the line is JSON, and its question."""
    path = scratch_path(spark, "json-lines")
    ordered = odd_json_lines(spark, sf).repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id")
    ordered.select("source", "value").write.partitionBy("source").text(path)
    lines = read_lines(spark, path).withColumn("source", F.regexp_extract("file", "/source=([^/]+)/", 1))
    question = C.variant_string(F.col("parsed"), "question")
    checked = write_once(lines.select("source", "seq", F.col("parsed").isNotNull().alias("json_ok"), F.md5(question).alias("question_md5")), "scanned-lines")
    return number_lines(checked, by="source").select("source", F.col("line").cast("long").alias("line"), "json_ok", "question_md5")


# --- mixed shapes -----------------------------------------------------------------

#: source -> raw shape of the mixed table; "logs" has no converter
MIXED_CONVERTERS = {"chats": "turns", "lists": "alternating", "triples": "triples", "code": "code_pairs", "pairs": "qa"}


def _json_text(c: str) -> Column:
    """A text as a JSON string."""
    array = F.to_json(F.array(F.col(c)))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def mixed_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """documents as JSON lines of all five shapes, by doc_id, with values of
    the wrong type inside: numbers, nulls and objects among turns, a turn that
    is no object, languages of every type, numbers for texts."""
    odd = F.pmod("doc_id", F.lit(7))
    d = doc_triples(spark, sf).select("doc_id", _json_text("source").alias("s"), _json_text("question").alias("q"), _json_text("response").alias("r"))
    chats = F.concat(F.lit('{"conversations":[{"from":"human","value":'), "q", F.lit('},{"from":"gpt","value":7},{"from":3,"value":'), "q",
                     F.lit('},{"from":"gpt","value":'), "r", F.lit('},{"from":"gpt","value":["x"]},{"value":'), "q", F.lit('},{"from":"system","value":null}'),
                     F.when(odd == 0, F.lit(",5")).otherwise(F.lit("")), F.lit("]}"))
    lists = F.concat(F.lit('{"data":['), "q", F.lit(","), "r", F.lit(',12345678,null,{"a":"a long enough text"},'), "r", F.lit("]}"))
    triples = F.concat(F.lit('{"system_prompt":'), F.when(odd == 1, F.lit("12345678")).otherwise(F.col("s")), F.lit(',"question":'), "q", F.lit(',"response":'), "r", F.lit("}"))
    language = F.element_at(F.array(*map(F.lit, ["", ',"language":null', ',"language":true', ',"language":3', ',"language":"sql"', ',"language":false', ',"language":2.5'])), odd.cast("int") + 1)
    code = F.concat(F.lit('{"func_code_string":'), "r", F.lit(',"func_documentation_string":'), "q", language, F.lit("}"))
    pairs = F.concat(F.lit('{"question":'), "q", F.lit(',"answer":'), F.when(odd == 2, F.lit("123456")).otherwise(F.col("r")), F.lit("}"))
    kind = F.pmod("doc_id", F.lit(6))
    names = [*MIXED_CONVERTERS, "logs"]
    value = F.when(kind == 0, chats).when(kind == 1, lists).when(kind == 2, triples).when(kind == 3, code).otherwise(pairs)
    return d.select("doc_id", F.element_at(F.array(*map(F.lit, names)), kind.cast("int") + 1).alias("source"), value.alias("value"))


def q_clean_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """All five raw shapes from one table of JSON lines in one scan."""
    lines = mixed_json_lines(spark, sf).withColumn("parsed", parse_json("value"))
    shape = C.shape_of(F.col("source"), MIXED_CONVERTERS)
    out = C.convert_mixed(lines, shape, default_system=DEFAULT_SYSTEM)
    return out.select("doc_id", "source", F.when(shape.isNull(), F.lit("skipped")).when(F.col("messages").isNull(), F.lit("conversion_failed")).otherwise(F.lit("converted")).alias("status"),
                      F.when(F.col("messages").isNotNull(), F.size("messages")).alias("n_messages"),
                      messages_fingerprint("messages").alias("fingerprint"))


# --- uncut lengths ------------------------------------------------------------------

def q_length_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Per split of the mixed corpus: exact median and 95th percentile of the
    uncut token lengths, their total, and how many examples the limit cuts."""
    messages = C.drop_failed(C.convert_triples(doc_triples(spark, sf), default_system=DEFAULT_SYSTEM))
    lengths = TK.tokenize_messages(messages, max_length=MAX_LEN).select("doc_id", F.col("full_length").cast("long").alias("n_tokens"))
    rows = write_once(mixed_split(spark, sf).join(lengths, "doc_id").select("split", "n_tokens"), "example-lengths")
    quantiles = exact_quantiles(rows, "n_tokens", {"median": 0.5, "p95": 0.95}, ["split"])
    totals = rows.groupBy("split").agg(F.count(F.lit(1)).alias("examples"), F.sum("n_tokens").alias("total_tokens"), F.max("n_tokens").alias("longest"),
                                       F.count_if(F.col("n_tokens") > MAX_LEN).alias("examples_cut"))
    return totals.join(quantiles, "split").select("split", "examples", "total_tokens", "longest", "examples_cut", F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"))


# --- ingest and integrity ---------------------------------------------------------------

def q_capped_scan(spark: SparkSession, sf: str) -> DataFrame:
    """First rows of every source in stream order, by caps of very different
    size: none for src0, 25, 1,001 and 500,000 for the next, 7 for the rest."""
    cap = (F.when(F.col("source") == "src0", F.lit(None).cast("long")).when(F.col("source") == "src1", F.lit(25)).when(F.col("source") == "src2", F.lit(1001))
           .when(F.col("source") == "src3", F.lit(500_000)).otherwise(F.lit(7)))
    kept = capped_scan(spark, f"{sf.rstrip('/')}/documents.parquet", ["source"], cap, ["doc_id", "source", "text"])
    return kept.select("doc_id", "source", F.md5("text").alias("text_md5"))


def q_dataset_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Digest of every source's documents written as lines of text files: which
    lines, how often, in which order."""
    path = scratch_path(spark, "digest-lines")
    one_line = F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.translate(F.coalesce("text", F.lit("")), "\n\r", "  "))
    rows = read_table(spark, sf, "documents").select("doc_id", "source", one_line.alias("value"))
    rows.repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").text(path)
    splits = split_digests(spark, path).withColumn("source", F.regexp_extract("file", "/source=([^/]+)/", 1))
    return merged(splits, ["source"]).select("source", F.col("n").cast("long").alias("n_lines"), "digest")


# --- counts taken while writing ---------------------------------------------------------

def q_load_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Examples loaded, valid and invalid per source, counted while the
    converted rows are written."""
    sources = sorted(r[0] for r in read_table(spark, sf, "documents").select("source").distinct().collect())
    converted = C.convert_triples(doc_triples(spark, sf), default_system=DEFAULT_SYSTEM).select("doc_id", "source", "messages")
    path = scratch_path(spark, "loaded")
    counts = write_counted(converted, lambda d: d.write.parquet(path), "source", sources,
                           {"loaded": F.lit(True), "valid": F.col("messages").isNotNull(), "invalid": F.col("messages").isNull()})
    return counts_table(spark, counts, "source")


# --- several sinks of one stream ----------------------------------------------------------

def request_lines(spark: SparkSession, sf: str) -> DataFrame:
    """events as request lines: chat requests for even ids, completions for
    odd ones, broken lines and lines of neither shape among them."""
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"messages":['), F.when(F.col("event_type") == "signup", F.lit("")).otherwise(
        F.concat(F.lit('{"role":"user","content":"'), "event_type", F.lit('"}'))), F.lit("]"))).otherwise(
        F.when(F.col("event_type") == "signup", F.lit('{"prompt":5')).otherwise(F.concat(F.lit('{"prompt":"'), "event_type", F.lit('"'))))
    number = lambda c: c.cast("double").cast("string")
    line = F.concat(body, F.lit(',"temperature":'), number(F.col("value") / 100), F.lit(',"max_tokens":'), (F.col("user_id") * 30).cast("string"),
                    F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.concat(F.lit(',"top_p":'), number(k / F.lit(100.0)))),
                    F.lit(',"repetition_penalty":'), number(F.lit(1.0) + k / F.lit(50.0)), F.lit(',"event_id":'), F.col("event_id").cast("string"), F.lit("}"))
    odd = (F.when(F.col("event_id") % 101 == 0, F.concat(F.col("event_id").cast("string"), F.lit(" not json")))
            .when(F.col("event_id") % 103 == 0, F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit("}"))))
    return read_table(spark, sf, "events").select(F.coalesce(odd, line).alias("value"))


def q_request_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Request lines streamed from text files in several batches into the
    accepted and quarantine tables."""
    lines, output = scratch_path(spark, "request-lines"), scratch_path(spark, "request-tables")
    request_lines(spark, sf).repartition(6).write.text(lines)
    run_requests(spark, lines, output, scratch_path(spark, "request-ckpt"), files_per_batch=2)
    both = requests.read_table(spark, output, "accepted").select("value", "shape", F.lit(None).cast("string").alias("reason")).unionByName(
        requests.read_table(spark, output, "quarantine").select("value", "shape", "reason"))
    own = F.regexp_extract("value", r'"event_id":(\d+)|^(\d+) not json', 0)
    return both.select(F.regexp_extract(own, r"\d+", 0).cast("long").alias("event_id"), "shape", F.col("reason").isNull().alias("accepted"), "reason")


def q_stream_first_copies(spark: SparkSession, sf: str) -> DataFrame:
    """documents streamed in three batches that bring later copies before
    earlier ones: the first copy of each key by doc_id, as a batch job keeps it."""
    folder, out = scratch_path(spark, "keyed-stream"), scratch_path(spark, "first-copies")
    keyed = write_once(doc_messages(spark, sf).select("doc_id", "source", content_hash("messages").alias("content_key")), "keyed-documents")
    for batch, rest in enumerate((2, 1, 0)):
        arrived = F.timestamp_seconds(F.lit(1_700_000_000 + 60 * batch))
        keyed.filter(F.col("doc_id") % 3 == rest).withColumn("arrived", arrived).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    run_to_completion(changes(stream, ["source", "content_key"], "doc_id", "arrived", "1 hour", 3_600_000), out, scratch_path(spark, "first-copies-ckpt"))
    return first_copies(spark, out, ["source", "content_key"]).select("source", "content_key", F.col("order").alias("doc_id"))


# --- checks, manifests and reports --------------------------------------------------------

def _checked_sources(spark: SparkSession, sf: str) -> DataFrame:
    lines = doc_json_lines(spark, sf).select(F.col("source").alias("name"), F.col("doc_id").alias("seq"), "value")
    known = read_table(spark, sf, "documents").groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    # src3 is promised one example more than there is, and one dataset is not there at all
    manifest = known.select("name", (F.col("n") + F.when(F.col("name") == "src3", 1).otherwise(0)).alias("num_examples")).unionByName(
        spark.createDataFrame([("not downloaded", 10)], "name string, num_examples long"))
    contracts = known.filter("name <> 'src4'").select("name", F.array(*map(F.lit, ("system_prompt", "question", "response"))).alias("required"))
    return check_table(manifest, lines, contracts)


def q_check_table(spark: SparkSession, sf: str) -> DataFrame:
    """Every check of every dataset, one row each."""
    return _checked_sources(spark, sf).select("name", "check", "passed", "detail")


def q_check_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Checks passed and made per dataset, and its verdict."""
    return verdicts(_checked_sources(spark, sf))


def q_download_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a download manifest over the document sources."""
    n = F.regexp_extract("source", r"(\d+)$", 1).cast("int") % 5
    status = F.when(n == 1, F.lit("skipped")).when(n == 2, F.lit("failed")).otherwise(F.lit("success"))
    manifest = (read_table(spark, sf, "documents").groupBy("source", status.alias("status"))
                .agg(F.count(F.lit(1)).alias("num_examples"), F.sum(F.octet_length("text")).alias("size_bytes")))
    return R.download_summary(manifest)


def q_combined_report(spark: SparkSession, sf: str) -> DataFrame:
    """Results of two runs put together: of a benchmark run twice the later
    result counts; only the benchmarks asked for are shown."""
    later = S.accuracy(read_table(spark, sf, "labels").withColumn("passed", F.col("toxic") == 0), "humaneval", "pass@1", "passed")
    runs = benchmark_results(spark, sf).withColumn("run", F.lit(1)).unionByName(later.withColumn("run", F.lit(2)))
    shown = S.select_benchmarks(R.latest_per_benchmark(runs, "run"), ["humaneval", "mmlu"])
    return shown.select("benchmark", "metric", "score", "correct", "total", title_from_key(F.concat("benchmark", F.lit("_score"))).alias("title"))


def q_report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All lines of the report, in order."""
    subjects = S.subject_accuracy(graded_choices(spark, sf), "subject", "item_id")
    return R.report_rows(benchmark_results(spark, sf), baselines_df(spark), subjects)


def q_test_programs(spark: SparkSession, sf: str) -> DataFrame:
    """The programs a sandbox would run, from every document."""
    t = doc_triples(spark, sf)
    program = A.test_program(F.col("question"), F.col("response"), F.col("lang"), F.col("source"))
    return t.select("doc_id", F.length(program).alias("program_length"), F.md5(program).alias("program_md5"))


def q_truncated_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt ids cut at the right, whether they were, and their attention mask."""
    tok = TK.RegexTokenizer()
    ids = read_table(spark, sf, "documents").select("doc_id", tok.ids(F.coalesce("text", F.lit(""))).alias("prompt_ids"))
    cut = TK.truncate_prompt(ids, limit=300)
    mask = F.array_repeat(F.lit(1), F.size("prompt_ids"))
    return cut.select("doc_id", "was_truncated", F.size("prompt_ids").alias("n_ids"), F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("attended"))


# --- SQL functions ------------------------------------------------------------------------

def q_sql_quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The quality filter as a query in SQL."""
    sql.register(spark, "cm_")
    return spark.sql("""
        WITH n AS (SELECT doc_id, cm_normalize_text(text) AS t FROM {documents})
        SELECT doc_id, length(t) AS norm_length, cm_alnum_count(t) AS alnum_chars,
               cm_content_key(array(named_struct('role', 'user', 'content', t))) AS content_key
        FROM n WHERE cm_is_valid_content(t)""", documents=read_table(spark, sf, "documents"))


def q_sql_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers read from free text in SQL: the chosen letter of each event's
    response, and the number of each order's."""
    sql.register(spark, "cm_")
    _, choices = event_choices(spark, sf)
    gold, numbers = order_numeric(spark, sf)
    return spark.sql("""
        SELECT 'choice' AS kind, item_id, CAST(cm_choice_answer(response) AS DOUBLE) AS answer FROM {choices}
        UNION ALL SELECT 'gold', item_id, cm_numeric_answer(answer) FROM {gold}
        UNION ALL SELECT 'number', item_id, cm_numeric_answer(response) FROM {numbers}""", choices=choices, gold=gold, numbers=numbers)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "shuffled_order": q_shuffled_order,
    "json_lines_scan": q_json_lines_scan,
    "clean_mixed": q_clean_mixed,
    "length_quantiles": q_length_quantiles,
    "capped_scan": q_capped_scan,
    "dataset_digest": q_dataset_digest,
    "load_manifest": q_load_manifest,
    "request_stream": q_request_stream,
    "stream_first_copies": q_stream_first_copies,
    "check_table": q_check_table,
    "check_summary": q_check_summary,
    "download_summary": q_download_summary,
    "combined_report": q_combined_report,
    "report_rows": q_report_rows,
    "test_programs": q_test_programs,
    "truncated_prompts": q_truncated_prompts,
    "sql_quality_filter": q_sql_quality_filter,
    "sql_answers": q_sql_answers,
}
