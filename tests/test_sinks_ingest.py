import json

from pyspark.sql import functions as F

from chatmill.functions.answers import test_program as build_test_program
from chatmill.operators.report import download_summary, latest_per_benchmark
from chatmill.operators.serving import profiles_df, training_plan, usage, validate_requests
from chatmill.operators.tokens import RegexTokenizer
from chatmill.functions.chat import IM_END, IM_START
from chatmill.sinks.writers import (cleaning_manifest, manifest_json, preparation_manifest, report_timestamp,
                                    write_cleaned, write_manifest, write_prepared)
from chatmill.sources.ingest import (capped_ingest, file_listing, first_of_partitions, head, inventory, line_counts,
                                     resolve_raw_paths, skip_present, source_from_file)
from chatmill.sources.jsonl import (MESSAGES_ROW, empty_like, read_jsonl_lenient, read_jsonl_strict,
                                    read_lines)
from chatmill.sources.registry import SAMPLING_PROFILES, registry_in_priority_order

MSG = "messages array<struct<role:string,content:string>>"


def test_cleaned_round_trip_and_scan_modes(spark, tmp_path):
    df = spark.createDataFrame([("gsm8k", [("user", "héllo"), ("assistant", "wörld")])], f"source string, {MSG}")
    out = str(tmp_path / "clean")
    write_cleaned(df, out)
    files = list((tmp_path / "clean" / "source=gsm8k").glob("*.json"))
    text = files[0].read_text(encoding="utf-8")
    assert "héllo" in text                              # non-ASCII kept
    mixed = tmp_path / "mixed.jsonl"
    mixed.write_text(text + "{broken\n", encoding="utf-8")
    assert read_jsonl_lenient(spark, str(mixed)).count() == 1   # bad line dropped
    try:
        read_jsonl_strict(spark, str(mixed)).collect()
        raised = False
    except Exception:  # noqa: BLE001
        raised = True
    assert raised                                         # first bad line aborts


def test_prepared_dataset_split_pruning(spark, tmp_path):
    df = spark.createDataFrame([([("user", "a")], None, "train"), ([("user", "b")], "x", "validation")],
                               f"{MSG}, source string, split string")
    out = str(tmp_path / "prep")
    write_prepared(df, out)
    val = spark.read.parquet(out).filter(F.col("split") == "validation")
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    rows = spark.read.parquet(out).collect()
    assert {r.source for r in rows} == {"unknown", "x"}
    assert all(json.loads(r.messages)[0]["role"] == "user" for r in rows)


def test_manifests(spark, tmp_path):
    summary = spark.createDataFrame([("a", 10, 8), ("b", 5, 5), ("Total", 15, 13)], "source string, input long, output long")
    m = cleaning_manifest(summary).collect()[0]
    assert (m.total_input, m.total_output, len(m.results)) == (15, 13, 2)
    out = str(tmp_path / "manifest")
    write_manifest(cleaning_manifest(summary), out)
    back = spark.read.option("multiLine", True).json(out).collect()[0]
    assert back.stage == "cleaning" and back.total_input == 15
    splits = spark.createDataFrame([("train", 19), ("validation", 2)], "split string, count long")
    stats = spark.createDataFrame([("a", 21, 21, 0, "math")], "source string, loaded long, valid long, invalid long, category string")
    pm = preparation_manifest(splits, stats, 42, 0.95).collect()[0]
    assert (pm.total_examples, pm.train_examples, pm.random_seed) == (21, 19, 42)
    assert json.loads(manifest_json(splits).collect()[0].value) == {"split": "train", "count": 19}


def test_listing_paths_and_skip(spark, tmp_path):
    raw = tmp_path / "raw"
    for cat, name in [("coding", "codesearchnet"), ("evaluation", "codesearchnet"), ("math", "gsm8k")]:
        d = raw / cat / name
        d.mkdir(parents=True)
        (d / "dataset.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    (raw / "x.pyc").write_text("junk")
    listing = file_listing(spark, str(raw))
    inv = inventory(listing).collect()[0]
    assert (inv.n_files, inv.kept_files) == (4, 3)
    names = spark.createDataFrame([("codesearchnet",), ("gsm8k",), ("mmlu",)], "name string")
    res = {r.name: (r.category, r.status) for r in resolve_raw_paths(listing, names, str(raw)).collect()}
    assert res == {"codesearchnet": ("coding", "found"), "gsm8k": ("math", "found"), "mmlu": (None, "not_found")}
    manifest = spark.createDataFrame([("gsm8k", str(raw / "math/gsm8k/dataset.jsonl"), "success", 2, 0),
                                      ("mmlu", str(raw / "evaluation/mmlu/dataset.jsonl"), "failed", 0, 0)],
                                     "name string, path string, status string, num_examples long, size_bytes long")
    sk = {r.name: (r.status, r.num_examples) for r in skip_present(manifest, listing).collect()}
    assert sk == {"gsm8k": ("skipped", 0), "mmlu": ("failed", 0)}
    counts = {r.path.split("/")[-3]: r.lines for r in line_counts(spark, str(raw / "*/*/dataset.jsonl")).collect()}
    assert counts == {"coding": 2, "evaluation": 2, "math": 2}
    ds = download_summary(skip_present(manifest, listing)).collect()[0]
    assert (ds.total_datasets, ds.successful, ds.failed) == (2, 1, 1)


def test_source_from_file_and_lines(spark, tmp_path):
    p = tmp_path / "openhermes_cleaned.jsonl"
    p.write_text('{"a": 1}\n\n')
    df = read_lines(spark, str(p)).withColumn("src", source_from_file("file"))
    rows = df.collect()
    assert len(rows) == 2 and rows[0].src == "openhermes" and rows[1].parsed is None


def test_empty_input_and_head(spark):
    assert empty_like(spark, MESSAGES_ROW).count() == 0
    df = spark.range(50).withColumnRenamed("id", "seq")
    assert head(df, "seq", 20).count() == 20 and head(df, "seq", None).count() == 50
    g = df.withColumn("g", F.when(F.col("seq") < 40, "a").otherwise("b"))
    capped = capped_ingest(g, ["g"], "seq", 3)
    assert sorted(r.seq for r in capped.collect()) == [0, 1, 2, 40, 41, 42]
    plan = first_of_partitions(g, ["g"], "seq", F.lit(3))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan                       # limited before the shuffle
    per_group = capped_ingest(g.withColumn("cap", F.when(F.col("g") == "a", 5)), ["g"], "seq", "cap")
    assert sorted(r.seq for r in per_group.collect()) == list(range(5)) + list(range(40, 50))


def test_registry_and_profiles(spark):
    names = [r.name for r in registry_in_priority_order(spark).collect()]
    assert names[0] == "openhermes" and names[-1] == "gsm8k_eval"
    assert sum(r[3] for r in SAMPLING_PROFILES if r[0] == "local") == 25_000


def test_training_plan_requests_usage(spark):
    counts = spark.createDataFrame([(25_000,)], "train_examples long")
    plan = {r.profile: r for r in training_plan(counts, profiles_df(spark)).collect()}
    assert plan["local"].total_steps == 25_000 // 1 // 16 * 1 and plan["local"].warmup_steps == int(1562 * 0.05)
    assert plan["local"].effective_batch == 16
    req = spark.createDataFrame(
        [([("user", "hi")], None, None, None, None), ([("user", "hi")], 2.5, None, None, None),
         ([], None, None, None, None), ([("user", "hi")], None, 5000, None, None)],
        f"{MSG}, temperature double, max_tokens long, top_p double, repetition_penalty double")
    out = validate_requests(req).collect()
    assert [r.valid for r in out] == [True, False, False, False]
    assert out[0].temperature == 0.7 and out[0].max_tokens == 2048 and out[2].reason == "messages empty"
    u = usage(spark.createDataFrame([(10, 20, 4.0), (1, 2, 0.0)], "p long, c long, e double"), "p", "c", "e").collect()
    assert [(r.total_tokens, r.tokens_per_second) for r in u] == [(30, 5.0), (3, 0.0)]


def test_report_helpers(spark):
    res = spark.createDataFrame([("mmlu", 1, 70.0), ("mmlu", 2, 72.0), ("gsm8k", 1, 50.0)],
                                "benchmark string, run int, score double")
    assert {r.benchmark: r.score for r in latest_per_benchmark(res, "run").collect()} == {"mmlu": 72.0, "gsm8k": 50.0}
    ts = spark.createDataFrame([("2024-01-02 03:04:05",)], "t string").select(report_timestamp(F.to_timestamp("t")))
    assert ts.collect()[0][0] == "2024-01-02T03:04:05.000000Z"
    prog = spark.createDataFrame([("def f():\n", "    return 1", "def check(c): pass", "f")], "p string, c string, t string, e string")
    assert prog.select(build_test_program("p", "c", "t", "e")).collect()[0][0].endswith("check(f)\n")
    tok = RegexTokenizer()
    assert (tok.marker_id(IM_START), tok.marker_id(IM_END)) == (tok.im_start_id, tok.im_end_id)


def test_reports_and_small_sources(spark, tmp_path):
    from chatmill.operators.score import select_benchmarks, with_runtime
    from chatmill.sinks.writers import evaluation_report, tokenization_manifest, write_jsonl
    from chatmill.sources.jsonl import read_json_document
    from chatmill.sources.registry import load_baselines
    res = spark.createDataFrame([("mmlu", "accuracy", 70.0, 1), ("mmlu", "accuracy", 72.5, 2), ("gsm8k", "accuracy", 50.0, 1)],
                                "benchmark string, metric string, score double, run int")
    subj = spark.createDataFrame([("algebra", 50.0), ("law", 80.0)], "subject string, accuracy double")
    rep = evaluation_report(res, subj, "m1", F.lit("2024-01-01T00:00:00Z"))
    out = str(tmp_path / "report")
    write_manifest(rep, out)
    back = read_json_document(spark, out).collect()[0]
    assert back.summary.average_score == 61.25 and back.benchmarks.mmlu.score == 72.5
    assert back.subject_accuracies.law == 80.0
    assert write_jsonl(res, str(tmp_path / "j")) == 3
    (tmp_path / "b.json").write_text('{"humaneval": 79.9, "mmlu": 74.2}')
    assert {r.benchmark: r.baseline for r in load_baselines(spark, str(tmp_path / "b.json")).collect()} == \
        {"humaneval": 79.9, "mmlu": 74.2}
    assert load_baselines(spark, str(tmp_path / "missing.json")).count() == 0
    assert select_benchmarks(res, ["gsm8k"]).count() == 1
    assert with_runtime(res, 12.345).first().runtime_seconds == 12.3
    stats = spark.createDataFrame([("train", 10)], "split string, total_examples long")
    tm = tokenization_manifest(stats, 2048, "regex").first()
    assert tm.max_seq_length == 2048 and tm.statistics[0].split == "train"


def test_holdout_filter_with_registry(spark):
    from chatmill.operators.convert import CONVERTERS
    from chatmill.sources.registry import holdout_filter, registry_df
    df = spark.createDataFrame([("gsm8k", 1), ("mmlu", 2), ("humaneval", 3), ("openorca", 4), ("other", 5)],
                               "source string, id int")
    kept = {r.source for r in holdout_filter(df, registry_df(spark), converters=list(CONVERTERS)).collect()}
    assert kept == {"gsm8k", "openorca"}


def test_small_display_helpers_and_nested_export(spark, tmp_path):
    from chatmill.functions.chat import distinct_roles
    from chatmill.functions.text import bytes_to_gb, bytes_to_mb, short_checksum, title_from_key
    from chatmill.operators.score import detail_rows
    from chatmill.sinks.writers import checksum_display, write_nested
    df = spark.createDataFrame([("avg_labeled_tokens", 12_345_678, "abcdef0123456789abcdef")], "k string, b long, c string")
    r = df.select(title_from_key("k"), bytes_to_mb("b"), bytes_to_gb("b"), short_checksum("c"), checksum_display("c")).first()
    assert tuple(r) == ("Avg Labeled Tokens", 12.3, 0.01, "abcdef012345", "abcdef0123456789...")
    m = spark.createDataFrame([([("user", "a"), ("assistant", "b"), ("user", "c")], "train")], f"{MSG}, split string")
    assert sorted(m.select(distinct_roles("messages")).first()[0]) == ["assistant", "user"]
    write_nested(m, str(tmp_path / "nested"))
    back = spark.read.parquet(str(tmp_path / "nested")).first()
    assert back.split == "train" and back.messages[2].content == "c"
    d = detail_rows(m, {"first": F.col("messages")[0]["content"], "n": F.size("messages")}).first()
    assert (d.first, d.n) == ("a", 3)


def test_spread_only_when_fewer_splits_than_cores(spark):
    from chatmill.sources.tables import spread
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, numPartitions=cores * 2)
    assert spread(many, "id") is many                       # enough splits: unchanged
    few = spark.range(0, 1000, numPartitions=1)
    spread_few = spread(few, ["id"])
    assert spread_few.rdd.getNumPartitions() == cores
    assert sorted(r.id for r in spread_few.collect()) == list(range(1000))
