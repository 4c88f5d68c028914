"""JSON lines as Python's json.loads takes them; physical line numbers; shapes from parsed lines."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatmill.operators import convert as C
from chatmill.session import write_once
from chatmill.sources.jsonl import number_lines, parse_json, read_jsonl_lenient, read_jsonl_strict, read_lines

TEXTS = ['{"a":1}', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}]', '{"a":1}}', '[1,2]', '[1] ]', '1] x', '1} x', '1', '"s"', 'null', 'NaN', '-Infinity',
         'Infinity', '-NaN', '+1', '01', '1.', '.5', '-', '{"a":NaN,"b":"NaN \\" NaN"}', '{"NaN":"Infinity","b":[-Infinity, -1]}', '{"a":1,"a":2}', '{"a":{"b":1,"b":{"c":3}}}',
         '', '  ', '\t', '{"a":"\t"}', '{"a":"\\u00e9 \\ud83d\\ude00"}', "{'a':1}", '{"a":1,}', '[1,]', '{"a":tru}', 'true', ' {"a":1} \r', '﻿{"a":1}', '{"a":1}\xa0',
         '{"a" 1}', '{"a":"x', 'nan', 'INF', '[NaN,]', '{"a":1}\x0c', '"\\x"', '{"a":"\\u12"}', '[' * 300 + ']' * 300, 'NaN NaN', '{"a": NaNx}', '"a" "b"', '1 2', '1,2',
         '/* c */ 1', '// c', '{"a":"\x7f"}', '[],[]', '],[', '],[1', '1],[2', '1},{2', 'null,null', '{"v":1},"v":{"x":2}', '1,"v":2', '{"a":[1,2,{"b":null}]}', "NaNs", "-"]


def loads(text):
    try:
        return True, json.loads(text.strip())
    except json.JSONDecodeError:
        return False, None


def compare(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string").withColumn("p", parse_json("v"))
    for r in df.select("i", F.col("p").isNotNull().alias("ok"), F.to_json("p").alias("j")).collect():
        ok, value = loads(texts[r.i])
        assert r.ok == ok, texts[r.i]
        if ok and "NaN" not in texts[r.i] and "Infinity" not in texts[r.i]:
            assert json.loads(r.j) == value, texts[r.i]


def test_json_as_loads_takes_it(spark):
    compare(spark, TEXTS)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(['{', '}', '[', ']', ',', ':', '"', '"a"', '"NaN"', '1', '-1', 'NaN', '-Infinity', 'Infinity', 'null', ' ', '\\', '"k":']), max_size=9).map("".join), min_size=200, max_size=200))
def test_json_of_random_pieces(spark, texts):
    compare(spark, texts)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("lines")
    lines = {}
    for name, n in (("a", 5000), ("b", 0), ("c", 1), ("d", 777)):
        own = [json.dumps({"messages": [{"role": "user", "content": f"{name} {i} " + "x" * (i % 200)}], "n": i}) if i % 7 else ["", "not json", '{"messages": 5}', "[1]", '{"a":1} x'][i // 7 % 5] for i in range(n)]
        (folder / f"{name}.jsonl").write_text("".join(x + "\n" for x in own))
        lines[name] = own
    return folder, lines


def test_physical_line_numbers(spark, files):
    """Small splits, so that a file is cut in many places and splits of several files share a task."""
    folder, lines = files
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        scanned = write_once(read_lines(spark, str(folder)).select("seq", "value", F.col("parsed").isNotNull().alias("ok")), "scanned")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert scanned.select("seq.file", "seq.block").distinct().count() > 10
    for r in number_lines(scanned).select("seq.file", "line", "value", "ok").collect():
        name = r.file.rsplit("/", 1)[1].removesuffix(".jsonl")
        assert lines[name][r.line - 1] == r.value and loads(r.value)[0] == r.ok
    whole = number_lines(scanned.withColumn("folder", F.lit("x")), by="folder").agg(F.min("line"), F.max("line"), F.countDistinct("line")).first()
    assert tuple(whole) == (1, 5778, 5778)


def test_lenient_scan_does_not_depend_on_the_columns_read(spark, files):
    folder, lines = files
    good = sum(loads(x)[0] for own in lines.values() for x in own)
    df = read_jsonl_lenient(spark, str(folder))
    assert df.count() == good == df.select(F.lit(1)).count() == df.select("messages").count() == len(df.collect())
    assert df.filter("messages IS NULL").count() == sum(1 for own in lines.values() for x in own if x in ('{"messages": 5}', "[1]"))


def test_strict_scan_fails_at_a_bad_line(spark, files, tmp_path):
    with pytest.raises(Exception, match="not a JSON line"):
        read_jsonl_strict(spark, str(files[0])).collect()
    (tmp_path / "good.jsonl").write_text('{"messages":[{"role":"user","content":"x"}]}\n{"messages":null}\n')
    assert [r.messages for r in read_jsonl_strict(spark, str(tmp_path / "good.jsonl")).collect()] == [[("user", "x")], None]


Q, A = "a question that is long enough", "an answer that is long enough, with code"
SHAPED = [  # source, line, roles or None
    ("chats", {"conversations": [{"from": "human", "value": Q}, {"from": "gpt", "value": A}]}, "system,user,assistant"),
    ("chats", {"conversations": [{"from": "human", "value": Q}, {"from": "gpt", "value": 1234567}]}, None),
    ("chats", {"conversations": [{"from": "human", "value": Q}, {"from": "gpt", "value": A}, "text"]}, None),
    ("chats", {"conversations": [{"from": "human", "value": Q}, {"from": 1, "value": A}, {"from": "gpt", "value": A}, {}]}, "system,user,assistant"),
    ("chats", {"conversations": "no array"}, None), ("chats", [1], None), ("chats", None, None),
    ("lists", {"data": [Q, A]}, "system,user,assistant"), ("lists", {"data": [Q, 1234567]}, None),
    ("lists", {"data": [1234567, A, None, A]}, "system,assistant,assistant"), ("lists", {"data": [Q]}, None), ("lists", {"data": None}, None),
    ("triples", {"system_prompt": 7654321, "question": Q, "response": A}, "system,user,assistant"), ("triples", {"question": Q, "response": {"x": A}}, None),
    ("pairs", {"question": Q, "answer": A}, "system,user,assistant"), ("pairs", {"question": Q}, None), ("logs", {"question": Q, "answer": A}, None),
]


def test_shapes_in_one_scan(spark):
    converters = {"chats": "turns", "lists": "alternating", "triples": "triples", "code": "code_pairs", "pairs": "qa"}
    rows = [(i, s, json.dumps(x)) for i, (s, x, _) in enumerate(SHAPED)]
    df = spark.createDataFrame(rows, "i int, source string, value string").withColumn("parsed", parse_json("value"))
    out = C.convert_mixed(df, C.shape_of(F.col("source"), converters))
    assert set(out.columns) == {"i", "source", "value", "parsed", "messages"}
    for r in out.collect():
        got = ",".join(m.role for m in r.messages) if r.messages is not None else None
        assert got == SHAPED[r.i][2], SHAPED[r.i]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


@pytest.mark.parametrize("language,printed", [('"language":null', "None"), ('"language":true', "True"), ('"language":false', "False"), ('"language":3', "3"), ('"language":"go"', "go"), ('"other":1', "python")])
def test_language_as_python_prints_it(spark, language, printed):
    line = '{"func_code_string":"' + "c" * 40 + '","func_documentation_string":"' + "d" * 20 + '",' + language + "}"
    out = C.convert_parsed(spark.createDataFrame([(line,)], "v string").withColumn("parsed", parse_json("v")), "code_pairs").collect()[0].messages
    assert out[1].content.startswith(f"Write a {printed} function") and out[2].content.startswith(f"```{printed}\n")
