"""End-to-end: raw JSON lines of all five shapes -> clean -> prepare -> tokenize."""

import json

from pyspark.sql import functions as F

from chatmill import jobs
from chatmill.sources.registry import baselines_df


def _raw(root, category, name, rows):
    d = root / category / name
    d.mkdir(parents=True)
    (d / "dataset.jsonl").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def test_stage_jobs_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    turns = [{"conversations": [{"from": "human", "value": f"question number {i}"},
                                {"from": "gpt", "value": f"answer number {i}"}]} for i in range(30)]
    turns += [turns[0], "{bad"]
    _raw(raw, "instruction", "openhermes", turns)
    _raw(raw, "instruction", "ultrachat", [{"data": [f"user says {i}", f"bot says {i}"], "id": str(i)} for i in range(10)]
         + [{"data": ["valid text", "x", "more text"], "id": "u"}])
    _raw(raw, "instruction", "openorca", [{"system_prompt": "", "question": f"why is {i} so", "response": "because it is"}
                                          for i in range(12)])
    _raw(raw, "coding", "codesearchnet", [{"func_code_string": f"def f{i}():\n    return {i} + {i} + {i} + 1",
                                           "func_documentation_string": f"Return the number {i} tripled.",
                                           "language": "python"} for i in range(8)])
    _raw(raw, "math", "gsm8k", [{"question": f"What is {i} plus {i}?", "answer": f"It is {2 * i}.\n#### {2 * i}"}
                                for i in range(6)])
    out = tmp_path / "out"
    summary = {r.source: r for r in jobs.clean_job(spark, str(raw), str(out)).collect()}
    assert summary["openhermes"].output == 30 and summary["openhermes"].duplicate == 1
    assert summary["openhermes"].parse_error == 1
    assert summary["Total"].input == 32 + 11 + 12 + 8 + 6
    manifest = spark.read.text(str(out / "cleaning_manifest")).first().value
    assert json.loads(manifest)["total_output"] == summary["Total"].output

    dist = {r.source: r["count"] for r in jobs.prepare_job(spark, str(out / "cleaned"), str(out / "prep")).collect()}
    total = summary["Total"].output - 1          # the user,user conversation fails validation
    pm = json.loads(spark.read.text(str(out / "prep" / "preparation_manifest")).first().value)
    uc = [x for x in pm["source_stats"] if x["source"] == "ultrachat"][0]
    assert (uc["loaded"], uc["valid"], uc["invalid"]) == (11, 10, 1)
    assert dist["Total"] == int(total * 0.95)
    prepared = spark.read.parquet(str(out / "prep" / "dataset"))
    assert prepared.count() == total
    assert prepared.filter(F.col("split") == "validation").count() == total - int(total * 0.95)

    stats = {r.split: r for r in jobs.tokenize_job(spark, str(out / "prep"), str(out / "tok")).collect()}
    assert stats["train"].total_examples == int(total * 0.95)
    tok = spark.read.parquet(str(out / "tok" / "tokenized"))
    assert tok.count() == total

    gold = spark.createDataFrame([(1, "#### 4"), (2, "#### 6")], "item_id long, answer string")
    pred = spark.createDataFrame([(1, "so 4"), (2, "it is 7")], "item_id long, response string")
    res, _ = jobs.score_job(spark, numeric_gold=gold, numeric_pred=pred)
    cmp = jobs.report_job(spark, res, baselines_df(spark), str(out / "report")).collect()
    assert cmp[0].score == 50.0 and cmp[0].baseline == 82.6
    assert spark.read.text(str(out / "report" / "report_lines")).count() == 1


def _prepared(spark, path):
    rows = spark.read.parquet(str(path / "dataset")).select("split", "source", "messages").collect()
    return sorted(tuple(r) for r in rows)


def test_prepare_draws_the_same_rows_however_the_files_are_laid_out(spark, tmp_path):
    raw = tmp_path / "raw"
    _raw(raw, "math", "gsm8k", [{"question": f"What is {i} plus {i}?", "answer": f"It is {2 * i}.\n#### {2 * i}"} for i in range(3000)])
    _raw(raw, "instruction", "openorca", [{"system_prompt": "", "question": f"why is {i} so", "response": "because it is"}
                                          for i in range(40)])
    for run in ("a", "b"):
        jobs.clean_job(spark, str(raw), str(tmp_path / run))
        jobs.prepare_job(spark, str(tmp_path / run / "cleaned"), str(tmp_path / run / "prep"))
    first = _prepared(spark, tmp_path / "a" / "prep")
    assert first and first == _prepared(spark, tmp_path / "b" / "prep")
    # other files, other order, a bad line in one of them
    moved = tmp_path / "moved"
    (spark.read.json(str(tmp_path / "a" / "cleaned")).orderBy(F.xxhash64(F.to_json("messages"))).repartition(5)
     .write.partitionBy("source").json(str(moved)))
    (moved / "source=gsm8k" / "part-bad.json").write_text('{"messages": [\n{"messages": 5}\n')
    jobs.prepare_job(spark, str(moved), str(tmp_path / "c"))
    assert _prepared(spark, tmp_path / "c") == first


def test_repeated_cleaned_rows_keep_keys_of_their_own(spark, tmp_path):
    folder = tmp_path / "cleaned" / "source=s"
    folder.mkdir(parents=True)
    line = json.dumps({"messages": [{"role": "user", "content": "hello there"}, {"role": "assistant", "content": "well met"}]})
    (folder / "a.json").write_text((line + "\n") * 10_001 + '{"other": 1}\n')
    rows = jobs.read_cleaned(spark, str(tmp_path / "cleaned"))
    assert rows.count() == rows.select("row_key").distinct().count() == 10_002
    assert rows.filter("messages IS NULL").count() == 1
    assert rows.filter("messages[1].content = 'well met' AND source = 's'").count() == 10_001


def test_report_time_is_utc_in_any_session_zone(spark):
    from chatmill.sinks.writers import report_timestamp
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        shown = spark.range(1).select(report_timestamp(F.timestamp_micros(F.lit(1_767_225_600_000_001).cast("long"))).alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert shown == "2026-01-01T00:00:00.000001Z"


def test_verify_job_and_cli(spark, tmp_path, capsys):
    from chatmill.__main__ import main
    f = tmp_path / "raw" / "math" / "gsm8k"
    f.mkdir(parents=True)
    data = f / "dataset.jsonl"
    data.write_text('{"question": "q1", "answer": "a1"}\n{"question": "q2", "answer": "a2"}\n')
    manifest = tmp_path / "download_manifest.json"
    manifest.write_text(json.dumps({"datasets": [
        {"name": "gsm8k", "path": str(data), "num_examples": 2, "checksum": None},
        {"name": "mmlu", "path": str(tmp_path / "nope.jsonl"), "num_examples": 0, "checksum": None}]}))
    checks, verdict = jobs.verify_job(spark, str(manifest))
    v = {r.name: r.passed for r in verdict.collect()}
    assert v == {"gsm8k": True, "mmlu": False}
    main(["clean", str(tmp_path / "raw"), str(tmp_path / "out")])
    assert "gsm8k" in capsys.readouterr().out
