import json


from chatmill.operators.verify import verdicts, verify_files
from chatmill.sources.registry import contracts_df


def test_verify_files(spark, tmp_path):
    good = tmp_path / "gsm8k.jsonl"
    good.write_text("\n".join(json.dumps({"question": "q", "answer": None}) for _ in range(3)) + "\n")
    bad = tmp_path / "ultrachat.jsonl"
    bad.write_text('{"data": ["a"], "id": "1"}\n{"data": ["b"]}\n{broken\n')
    import hashlib
    digest = hashlib.sha256(good.read_bytes()).hexdigest()
    empty = tmp_path / "openorca.jsonl"
    empty.write_text("")
    manifest = spark.createDataFrame(
        [("gsm8k", str(good), 3, digest), ("ultrachat", str(bad), 5, None), ("mmlu", str(tmp_path / "nope.jsonl"), 0, None),
         ("openorca", str(empty), 0, None)],
        "name string, path string, num_examples long, checksum string")
    checks = verify_files(spark, manifest, contracts_df(spark))
    rows = {(r.name, r.check): r for r in checks.collect()}
    assert rows[("gsm8k", "Checksum match")].passed is True
    assert rows[("gsm8k", "Expected fields")].passed is True         # null value counts as present
    assert rows[("ultrachat", "Checksum match")].passed is None
    assert rows[("ultrachat", "JSONL parseable")].passed is False
    assert "Missing field 'id' on line 2" in rows[("ultrachat", "Expected fields")].detail
    assert rows[("ultrachat", "Line count")].passed is False          # count mismatch fails
    assert [k for k in rows if k[0] == "mmlu"] == [("mmlu", "File exists")]
    assert rows[("openorca", "Non-zero size")].passed is False
    assert rows[("openorca", "JSONL parseable")].detail == "Checked 0 lines"
    assert rows[("openorca", "Line count")].passed is True            # expected 0 passes
    v = {r.name: r.passed for r in verdicts(checks).collect()}
    assert v == {"gsm8k": True, "ultrachat": False, "mmlu": False, "openorca": False}


def test_incremental_clean_dedups_across_batches(spark, tmp_path):
    from chatmill.streaming.incremental import incremental_clean
    src = tmp_path / "in"
    src.mkdir()
    row = lambda q: json.dumps({"question": q, "answer": "a long enough answer"})
    (src / "a.jsonl").write_text(row("first question here") + "\n" + row("second question") + "\n{bad\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    first = incremental_clean(spark, str(src), "qa", "gsm8k", out, ck).count()
    (src / "b.jsonl").write_text(row("first question here") + "\n" + row("third question!") + "\n")
    second = incremental_clean(spark, str(src), "qa", "gsm8k", out, ck).count()
    assert (first, second) == (2, 3)


def test_large_file_hash_path_matches_whole_file_hash(spark, tmp_path):
    import hashlib

    from chatmill.operators.verify import file_stats
    a = tmp_path / "a.jsonl"
    a.write_bytes(b'{"x": 1}\n' * 5000)
    b = tmp_path / "b.jsonl"
    b.write_bytes(b'{"y": 2}\n' * 10)
    whole = {r.path: r.sha256 for r in file_stats(spark, [str(a), str(b)]).collect()}
    chunked = {r.path: r.sha256 for r in file_stats(spark, [str(a), str(b)], whole_file_limit=100).collect()}
    assert whole == chunked
    assert sorted(whole.values()) == sorted([hashlib.sha256(a.read_bytes()).hexdigest(),
                                             hashlib.sha256(b.read_bytes()).hexdigest()])


def test_incremental_clean_with_bounded_dedup_state(spark, tmp_path):
    from chatmill.streaming.incremental import incremental_clean
    src = tmp_path / "in"
    src.mkdir()
    row = lambda q: json.dumps({"question": q, "answer": "a long enough answer"})
    (src / "a.jsonl").write_text(row("first question here") + "\n" + row("first question here") + "\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    n = incremental_clean(spark, str(src), "qa", "gsm8k", out, ck, dedup_window="7 days").count()
    assert n == 1


def test_line_verdicts(spark):
    from chatmill.operators.verify import line_verdicts
    rows = [("a", 1, '{"q": 1, "r": 2}'), ("a", 2, '{"q": 1}'), ("b", 1, "{bad"), ("b", 2, '{"q": 1, "r": 2}'),
            ("c", 1, '{"x": 1}')]
    lines = spark.createDataFrame(rows, "name string, seq long, value string")
    contracts = spark.createDataFrame([("a", ["q", "r"]), ("b", ["q", "r"])], "name string, required array<string>")
    expected = spark.createDataFrame([("a", 2), ("b", 3)], "name string, num_examples long")
    v = {r.name: r for r in line_verdicts(lines, contracts, expected=expected).collect()}
    assert (v["a"].parse_ok, v["a"].fields_ok, v["a"].missing_field, v["a"].fields_line, v["a"].passed) == \
        (True, False, "r", 2, False)
    assert (v["b"].first_bad_line, v["b"].count_ok, v["b"].passed) == (1, False, False)
    assert (v["c"].fields_ok, v["c"].passed) == (None, True)        # no contract, no expected count


def test_every_line_is_checked(spark, tmp_path):
    from chatmill.operators.verify import line_verdicts, required_key_check
    good = '{"question": 1, "answer": 2}'
    rows = [(n, 10 * i, good) for n in "abc" for i in range(1, 151)]
    rows += [("a", 1505, "{bad"), ("a", 1506, "{bad"), ("b", 1005, '{"question": 1}')]
    lines = spark.createDataFrame(rows, "name string, seq long, value string").repartition(7)
    contracts = spark.createDataFrame([(n, ["question", "answer"]) for n in "abc"], "name string, required array<string>")
    v = {r.name: (r.first_bad_line, r.parse_ok, r.fields_line, r.missing_field, r.passed) for r in line_verdicts(lines, contracts).collect()}
    assert v == {"a": (151, False, 151, "question", False), "b": (None, True, 101, "answer", False), "c": (None, True, None, None, True)}
    k = {r.name: (r.lines_checked, r.first_failing_line, r.missing_field, r.passed) for r in required_key_check(lines, contracts).collect()}
    assert k == {"a": (152, 151, "question", False), "b": (151, 101, "answer", False), "c": (150, None, None, True)}
    path = tmp_path / "gsm8k.jsonl"
    path.write_text("\n".join([good] * 150 + ['{"question": 1}', "{bad"]) + "\n")
    manifest = spark.createDataFrame([("gsm8k", str(path), 152, None)], "name string, path string, num_examples long, checksum string")
    checks = {r.check: (r.passed, r.detail) for r in verify_files(spark, manifest, contracts_df(spark)).collect()}
    assert checks["JSONL parseable"] == (False, "JSON parse error on line 152")
    assert checks["Expected fields"] == (False, "Missing field 'answer' on line 151")
