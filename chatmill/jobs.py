"""End-to-end stage jobs: verify -> clean -> prepare -> tokenize -> score ->
report.  Each job chains the DataFrame operators, writes its sinks with
Spark's writers and returns small result tables (manifests, summaries).

Stage boundaries are written tables, as in the reference; inside a stage a
frame read by more than one sink is checkpointed once into the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.chat import content_hash
from .operators import mix as M
from .operators import report as R
from .operators import score as S
from .operators import shuffle as SH
from .operators import tokens as TK
from .operators.convert import CONVERTERS, DEFAULT_SYSTEM
from .operators.convert import convert_mixed, shape_of
from .operators.dedup import keep_first
from .operators.outcomes import outcome_summary
from .operators.verify import verdicts, verify_files
from .session import materialize, scratch_path, write_once
from .sinks import writers as W
from .sinks.observed import counts_table, write_counted
from .sources import ingest as I
from .sources.jsonl import MESSAGES_ROW, empty_like, messages_from_json, read_lines
from .sources.registry import (MAX_SEQ_LENGTH, RANDOM_SEED, SAMPLING_PROFILES, TRAIN_RATIO, TRAINING_SOURCES,
                               contracts_df, sampling_config_df)

#: places of the shuffled order in one numbered part of the prepared dataset
PART_ROWS = 100_000


def verify_job(spark: SparkSession, manifest_path: str) -> tuple[DataFrame, DataFrame]:
    """Download manifest (``{"datasets": [...]}``) -> check table, verdicts."""
    doc = spark.read.option("multiLine", True).json(manifest_path)
    entries = doc.select(F.explode("datasets").alias("d")).select("d.*")
    manifest = entries.select("name", "path", F.col("num_examples").cast("long"), "checksum")
    checks = verify_files(spark, manifest, contracts_df(spark))
    return checks, verdicts(checks)


def clean_job(spark: SparkSession, raw_root: str, out_dir: str, sources: list[str] | None = None,
              default_system: str = DEFAULT_SYSTEM) -> DataFrame:
    """Raw JSON lines -> cleaned messages per source + cleaning manifest.

    Returns the per-source summary (status, counts, retention)."""
    sources = sources or TRAINING_SOURCES
    names = spark.createDataFrame([(n,) for n in sources], "name string")
    listing = I.file_listing(spark, raw_root, "dataset.jsonl")
    # one row per requested source: a short list on the driver
    resolved = I.resolve_raw_paths(listing, names, raw_root).collect()
    paths, status = {}, {}
    for r in resolved:
        if r["path"] is None:
            status[r["name"]] = "not_found"
        elif r["name"] not in CONVERTERS:
            status[r["name"]] = "skipped"
        else:
            status[r["name"]] = "success"
            paths[r["name"]] = r["path"]
    counts_schema = ("source string, input long, output long, parse_error long, conversion_failed long, "
                     "duplicate long, dropped long")
    if paths:
        # one scan of all sources; each row goes by its own source's shape
        name = F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
        lines = read_lines(spark, list(paths.values())).withColumn("source", name)
        conv = convert_mixed(lines, shape_of(F.col("source")), default_system=default_system)
        keyed = (conv.select("source", "seq", F.col("parsed").isNull().alias("parse_failed"), "messages")
                     .withColumn("content_key", F.when(F.col("messages").isNotNull(), content_hash("messages"))))
        # every line is parsed, converted and keyed once; the counts are taken while these rows and the kept ones are written
        path = scratch_path(spark, "keyed-lines")
        listed = list(paths)
        read = write_counted(keyed, lambda d: d.write.parquet(path), "source", listed, {
            "input": F.lit(True), "parse_error": F.col("parse_failed"), "conversion_failed": ~F.col("parse_failed") & F.col("messages").isNull()})
        keyed = spark.read.schema(keyed.schema).parquet(path)
        kept = keep_first(keyed.filter(F.col("content_key").isNotNull()), ["source", "content_key"], "seq")
        written = write_counted(kept, lambda d: W.write_cleaned(d, f"{out_dir}/cleaned"), "source", listed, {"output": F.lit(True)})
        rows = []
        for name in listed:
            n, output = read[name], written[name]["output"]
            dropped = n["input"] - output
            if n["input"]:
                rows.append((name, n["input"], output, n["parse_error"], n["conversion_failed"], dropped - n["parse_error"] - n["conversion_failed"], dropped))
        counts = spark.createDataFrame(rows, counts_schema)
    else:
        counts = spark.createDataFrame([], counts_schema)
    summary = outcome_summary(counts)
    st = spark.createDataFrame(list(status.items()), "source string, status string")
    summary = summary.join(F.broadcast(st), "source", "full")
    W.write_manifest(W.cleaning_manifest(summary.filter(F.col("input").isNotNull())), f"{out_dir}/cleaning_manifest")
    return summary


def read_cleaned(spark: SparkSession, cleaned_dir: str) -> DataFrame:
    """Cleaned rows (bad lines dropped) with their source from the folder
    layout; a missing folder is an empty dataset.

    ``row_key`` depends on the source and the content only (repeated rows are
    numbered), so a seed draws the same rows however the files are named,
    split and ordered."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(cleaned_dir)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return (empty_like(spark, MESSAGES_ROW).withColumn("source", F.lit(None).cast("string"))
                .withColumn("row_key", F.lit(None).cast("string")))
    schema = T.StructType(MESSAGES_ROW.fields + [T.StructField("source", T.StringType()),
                                                 T.StructField("_bad_line", T.StringType())])
    lines = (spark.read.schema(schema).option("columnNameOfCorruptRecord", "_bad_line").json(cleaned_dir)
             .filter(F.col("_bad_line").isNull()))
    # equal rows are counted map-side and numbered in blocks, so that one row
    # repeated very often is neither one group's task nor one huge array
    counted = lines.groupBy("source", F.to_json("messages").alias("_text")).agg(F.count(F.lit(1)).alias("_n"))
    size = F.lit(10_000).cast("long")
    blocks = counted.withColumn("_first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), size)))
    rows = blocks.withColumn("_no", F.explode(F.sequence("_first", F.least(F.col("_n"), F.col("_first") + size - 1))))
    key = F.concat_ws(":", F.sha2(F.coalesce("_text", F.lit("")), 256), F.col("_no").cast("string"))
    return rows.select(messages_from_json("_text").alias("messages"), "source", F.sha2(key, 256).alias("row_key"))


def prepare_job(spark: SparkSession, cleaned_dir: str, out_dir: str, profile: str = "local",
                seed: int = RANDOM_SEED, ratio: float = TRAIN_RATIO) -> DataFrame:
    """cap -> oversample -> validate -> shuffle -> exact split; writes the
    prepared dataset, its JSON-lines copy and the preparation manifest.
    Returns the train-split source distribution."""
    cfg = sampling_config_df(spark, profile)
    rows = read_cleaned(spark, cleaned_dir).join(F.broadcast(cfg.select("source")), "source", "left_semi")
    # each line is parsed once; the light passes below read only the keys
    rows = write_once(rows, "cleaned-rows")
    # the profile is a literal table: its row count is a proven bound
    sampled, mixed = M.mix_sources(rows, cfg, "row_key", seed, return_sampled=True,
                                   n_sources=len([r for r in SAMPLING_PROFILES if r[0] == profile]))
    stats = M.load_stats(sampled, mixed, cfg)
    placed = SH.prefix_split(SH.shuffled(mixed, ["source", "row_key", "copy"], seed), ratio)
    full = write_once(M.attach_payload(placed, rows, ["source", "row_key"]), "prepared-rows")
    # the files of a split are in shuffled order, a range of places each
    in_order = SH.in_parts(full, PART_ROWS, by=["split"])
    written = write_counted(in_order, lambda d: W.write_prepared(d, f"{out_dir}/dataset"), "split", ["train", "validation"], {"count": F.lit(True)})
    W.write_split_jsonl(in_order, f"{out_dir}/jsonl")
    counts = counts_table(spark, {k: c for k, c in written.items() if c["count"]}, "split")
    W.write_manifest(W.preparation_manifest(counts, stats, seed, ratio), f"{out_dir}/preparation_manifest")
    return M.source_distribution(full.filter(F.col("split") == "train"))


def tokenize_job(spark: SparkSession, prepared_dir: str, out_dir: str, profile: str = "local",
                 tokenizer: TK.RegexTokenizer | None = None, tokenizer_json: str | None = None) -> DataFrame:
    """Prepared dataset -> token ids, masks, labels per split + statistics.
    ``tokenizer_json``: the model's ``tokenizers`` file (its BPE and its
    ``<|im_start|>`` / ``<|im_end|>`` ids); default: the regex tokenizer."""
    max_len = MAX_SEQ_LENGTH[profile]
    ds = spark.read.parquet(f"{prepared_dir}/dataset").withColumn("messages", messages_from_json("messages"))
    if tokenizer_json:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(tokenizer_json)     # driver side: only the two marker ids
        start, end = t.token_to_id("<|im_start|>"), t.token_to_id("<|im_end|>")
        tokenized = TK.tokenize_with(ds, im_start_id=start, im_end_id=end, keep=["split"], max_length=max_len,
                                     encode_batch=TK.hf_tokenizer_encoder(tokenizer_json))
        name = tokenizer_json
    else:
        tokenized = TK.tokenize_messages(ds, tokenizer, max_length=max_len)
        name = "regex"
    tok = materialize(tokenized.select("split", "input_ids", "attention_mask", "labels", "full_length"))
    W.write_tokenized(tok, f"{out_dir}/tokenized")
    stats = TK.token_statistics(tok, max_len, ["split"])
    W.write_manifest(W.tokenization_manifest(stats, max_len, name), f"{out_dir}/tokenization_config")
    return stats


def score_job(spark: SparkSession, numeric_gold: DataFrame | None = None, numeric_pred: DataFrame | None = None,
              choice_gold: DataFrame | None = None, choice_pred: DataFrame | None = None,
              code_results: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Benchmark results (benchmark, metric, score, correct, total) from the
    gold and prediction tables that are given, and MMLU subject accuracies."""
    parts, subjects = [], None
    if code_results is not None:
        parts.append(S.accuracy(code_results, "humaneval", "pass@1", "passed"))
    if numeric_gold is not None:
        parts.append(S.accuracy(S.grade_numeric(numeric_gold, numeric_pred), "gsm8k"))
    if choice_gold is not None:
        graded = S.grade_choice(choice_gold, choice_pred)
        parts.append(S.accuracy(graded, "mmlu"))
        if "subject" in choice_gold.columns:
            subjects = S.subject_accuracy(graded, "subject", "item_id")
    results = parts[0]
    for p in parts[1:]:
        results = results.unionByName(p)
    return results, subjects


def report_job(spark: SparkSession, results: DataFrame, baselines: DataFrame, out_dir: str,
               subjects: DataFrame | None = None, model: str = "model") -> DataFrame:
    """Evaluation report JSON and markdown lines; returns the comparison."""
    W.write_manifest(W.evaluation_report(results, subjects.select("subject", "accuracy") if subjects is not None else None,
                                         model, W.report_timestamp(F.current_timestamp())),
                     f"{out_dir}/evaluation_report")
    cmp = R.with_baselines(results, baselines)
    lines = cmp.select(R.markdown_result_line(F.col("benchmark"), F.col("metric"), F.col("score"),
                                              F.col("baseline"), F.col("delta")).alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(f"{out_dir}/report_lines")
    return cmp
