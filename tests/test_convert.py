from pyspark.sql import functions as F

from chatmill.functions.chat import content_key
from chatmill.operators.convert import (DEFAULT_SYSTEM, convert_alternating, convert_code_pairs,
                                        convert_parsed, convert_qa, convert_triples, convert_turns)
from chatmill.operators.mix import is_valid_example

TURNS = "conversations array<struct<from:string,value:string>>"


def msgs(row):
    return [(m["role"], m["content"]) for m in row["messages"]] if row["messages"] is not None else None


def test_turns_unknown_role_and_missing_assistant(spark):
    df = spark.createDataFrame([([("tool", "some tool output"), ("human", "hello there")],)], TURNS)
    assert convert_turns(df).collect()[0]["messages"] is None


def test_turns_invalid_system_gets_default(spark):
    df = spark.createDataFrame([([("system", "x"), ("human", "hello there"), ("gpt", "general kenobi")],)], TURNS)
    row = convert_turns(df, default_system="SYS prompt").collect()[0]
    assert msgs(row) == [("system", "SYS prompt"), ("user", "hello there"), ("assistant", "general kenobi")]


def test_turns_valid_system_kept_and_invalid_turn_dropped(spark):
    df = spark.createDataFrame([([("system", "be brief please"), ("human", "hi"), ("human", "hello there"),
                                  ("gpt", "general kenobi")],)], TURNS)
    row = convert_turns(df).collect()[0]
    assert msgs(row) == [("system", "be brief please"), ("user", "hello there"), ("assistant", "general kenobi")]


def test_alternating_same_role_neighbours_fail_validation(spark):
    df = spark.createDataFrame([(["valid text", "x", "more text"],)], "data array<string>")
    out = convert_alternating(df).withColumn("ok", is_valid_example("messages")).collect()[0]
    assert [r for r, _ in msgs(out)] == ["system", "user", "user"]
    assert out["ok"] is False


def test_alternating_needs_two_raw_turns(spark):
    df = spark.createDataFrame([(["only one turn"],), (None,), ([],)], "data array<string>")
    assert [r["messages"] for r in convert_alternating(df).collect()] == [None, None, None]


def test_triples_system_choice(spark):
    df = spark.createDataFrame([("", "what is two plus two", "it is four"), ("be terse", "question here", "answer here")],
                               "system_prompt string, question string, response string")
    rows = convert_triples(df).collect()
    assert msgs(rows[0])[0] == ("system", DEFAULT_SYSTEM)
    assert msgs(rows[1])[0] == ("system", "be terse")


def test_code_pairs_thresholds(spark):
    code29, code30 = "c" * 29, "c" * 30
    doc14, doc15 = "d" * 14, "d" * 15
    df = spark.createDataFrame([(code29, doc15, "go"), (code30, doc14, "go"), (code30, doc15, "go")],
                               "func_code_string string, func_documentation_string string, language string")
    out = [r["messages"] for r in convert_code_pairs(df).collect()]
    assert out[0] is None and out[1] is None
    assert out[2][1]["content"] == "Write a go function that does the following:\n\n" + doc15
    assert out[2][2]["content"] == "```go\n" + code30 + "\n```"


def test_code_pairs_missing_language_is_python(spark):
    df = spark.createDataFrame([("c" * 40, "d" * 20)], "func_code_string string, func_documentation_string string")
    out = convert_code_pairs(df, language=None).collect()[0]["messages"]
    assert out[2]["content"].startswith("```python\n")


def test_qa(spark):
    df = spark.createDataFrame([("How much is 2+2?", "#### 4"), ("ok?", "fine answer")], "question string, answer string")
    out = [r["messages"] for r in convert_qa(df).collect()]
    assert out[0] is not None and out[1] is None


def test_parsed_json_shapes(spark):
    lines = ['{"question": "what is two plus two", "answer": "it is four"}',
             '{"question": 5, "answer": "it is four"}', '[1, 2]', '{bad', '']
    df = spark.createDataFrame([(x,) for x in lines], "value string").withColumn("parsed", F.try_parse_json("value"))
    out = convert_parsed(df, "qa").select("value", F.col("parsed").isNull().alias("bad"), "messages").collect()
    assert out[0]["messages"] is not None
    assert out[1]["messages"] is None          # number is not a string
    assert out[2]["messages"] is None          # not an object
    assert out[3]["bad"] and out[4]["bad"]     # two parse errors


def test_content_key_ignores_system_and_uses_prefix(spark):
    a = [("system", "one"), ("user", "u" * 250), ("assistant", "a" * 10)]
    b = [("system", "two"), ("user", "u" * 200 + "DIFFERENT"), ("assistant", "a" * 10)]
    df = spark.createDataFrame([(a,), (b,)], "messages array<struct<role:string,content:string>>")
    cut = [r[0] for r in df.select(content_key("messages", prefix_chars=200)).collect()]
    assert cut[0] == cut[1] == "user:200:" + "u" * 200 + "|assistant:10:" + "a" * 10
    whole = [r[0] for r in df.select(content_key("messages")).collect()]
    assert whole[0] == "user:250:" + "u" * 250 + "|assistant:10:" + "a" * 10 != whole[1]


def test_content_key_tells_turns_from_text_that_looks_like_turns(spark):
    a = [("user", "x"), ("user", "y|user:1:z")]
    b = [("user", "x"), ("user", "y"), ("user", "z")]
    c = [("user", "x|user:1:y"), ("user", "z")]
    df = spark.createDataFrame([(a,), (b,), (c,)], "messages array<struct<role:string,content:string>>")
    assert len({r[0] for r in df.select(content_key("messages")).collect()}) == 3
