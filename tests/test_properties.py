"""Hand-worked tables and properties that hold for any text."""

import random

import pytest
from pyspark.sql import functions as F

from chatmill.functions.answers import extract_choice, extract_code, extract_numeric_answer
from chatmill.functions.text import is_valid_content, normalize_text
from chatmill.operators.convert import convert_alternating, convert_turns

ALPHABET = list("ab xyz09#-,.:()") + ["\t", "\n", "\r", "\x00", "\x07", "\x0b", "\x1c", "\x7f", "\xa0", "\u3000", "\u00e9", "e\u0301", "\u212b", "\u00df"]


def _texts(n, seed, max_len=40):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, max_len))) for _ in range(n)]


def _apply(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_normalized_text_properties(spark):
    once = _apply(spark, _texts(2000, 1), normalize_text)
    assert _apply(spark, once, normalize_text) == once
    for t in once:
        assert not any(ord(c) < 32 and c not in "\n\r" or c in "\t\x7f" for c in t)
        assert "  " not in t and "\n\n\n" not in t and t == t.strip()


def test_validity_does_not_depend_on_order(spark):
    texts = _texts(1000, 3, 14)
    assert _apply(spark, texts, is_valid_content) == _apply(spark, [t[::-1] for t in texts], is_valid_content)


@pytest.mark.parametrize("text,number", [
    ("so #### 42", 42.0), ("#### 1,234.5 done", 1234.5), ("first 3 then 7.", 7.0), ("-8 apples", -8.0), ("none", None), ("", None), (None, None),
    ("#### - and 5", 5.0), ("10 and #### 9", 9.0)])
def test_numbers(spark, text, number):
    assert _apply(spark, [text], extract_numeric_answer) == [number]


@pytest.mark.parametrize("text,choice", [
    ("B", 1), (" c.", 2), ("(D)", 3), ("The answer is A", 0), ("xyz", None), ("", None), (None, None), ("\tb) because", 1), ("I say (C) or D", 2)])
def test_choices(spark, text, choice):
    assert _apply(spark, [text], extract_choice) == [choice]


@pytest.mark.parametrize("text,code", [
    ("```python\nx = 1\n```", "x = 1"), ("Sure.\n```\ny\n``` end", "y"), ("Sure.\ndef f():\n    return 1", "def f():\n    return 1"),
    ("text", "text"), ("Sure.\n# note\nx  ", "# note\nx")])
def test_code(spark, text, code):
    assert _apply(spark, [text], extract_code) == [code]


def test_code_without_fence_is_a_tail(spark):
    rnd = random.Random(6)
    pieces = ["def f():", "    return 1", "x = 2", "Sure.", "# note", "\n", "\n", "import os", "else:"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    for text, code in zip(texts, _apply(spark, texts, extract_code)):
        assert text.endswith(code)


def test_converted_turns(spark):
    rows = [
        ([("human", "hello world"), ("gpt", "valid turn here")], ["system", "user", "assistant"]),
        ([("system", "be kind to all"), ("human", "hello world"), ("gpt", "valid turn here")], ["system", "user", "assistant"]),
        ([("human", "hello world"), ("tool", "valid turn here")], None),
        ([("human", "ok"), ("gpt", "valid turn here")], None),
        ([("human", "hello world"), (None, "hello world"), ("gpt", "valid turn here"), ("gpt", None)], ["system", "user", "assistant"]),
        ([], None)]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(rows)], "i int, conversations array<struct<from:string,value:string>>")
    got = {r.i: None if r.messages is None else [m.role for m in r.messages] for r in convert_turns(df, default_system="SYS").collect()}
    assert [got[i] for i in range(len(rows))] == [roles for _, roles in rows]


def test_alternating_roles(spark):
    rows = [(["hello world", "valid turn here"], ["system", "user", "assistant"]), (["hello world"], None), (None, None), ([], None),
            (["hello world", "ok", "valid turn here"], ["system", "user", "user"]),
            (["hello world", "valid turn here", "a third turn"], ["system", "user", "assistant", "user"])]
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(rows)], "i int, data array<string>")
    got = {r.i: None if r.messages is None else [m.role for m in r.messages] for r in convert_alternating(df, default_system="SYS").collect()}
    assert [got[i] for i in range(len(rows))] == [roles for _, roles in rows]
