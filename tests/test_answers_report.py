import math

import pytest
from pyspark.sql import functions as F

from chatmill.functions.answers import (choice_label, choices_text, extract_choice, extract_code,
                                        extract_numeric_answer, pass_at_k)
from chatmill.operators.report import (markdown_delta, report_summary, terminal_delta, top_bottom_subjects,
                                       with_baselines)
from chatmill.sources.registry import baselines_df


def _col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_numeric_extraction(spark):
    vals = ["#### 1,234", "#### -5.", "total 3.14.", "it is 5, ok", "well, yes", "", "#### 1.2.3 then 7", None]
    assert _col(spark, vals, extract_numeric_answer) == [1234.0, -5.0, 3.14, 5.0, None, None, 7.0, None]


def test_choice_extraction(spark):
    vals = ["C", "Answer: C", "Based on", "The (D)", "zzz", "  b  ", "", None]
    assert _col(spark, vals, extract_choice) == [2, 0, 1, 3, None, 1, None, None]
    assert _col(spark, [0, 3, None], choice_label, "int") == ["A", "D", "?"]


def test_five_choices_fifth_ignored(spark):
    out = _col(spark, [["w", "x", "y", "z", "extra"]], choices_text, "array<string>")
    assert out == ["A. w\nB. x\nC. y\nD. z"]


@pytest.mark.parametrize("resp,expected", [
    ("Here:\n```python\n    x = 1\n    return x\n```", "x = 1\n    return x"),
    ("Sure.\n\nx = 1", "\nx = 1"),
    ("hello", "hello"),
    ("intro\ndef f():  \n    pass", "def f():\n    pass"),
])
def test_extract_code(spark, resp, expected):
    assert _col(spark, [resp], extract_code) == [expected]


def _pass_at_k(n, c, k):
    if n - c < k:
        return 1.0
    return 1.0 - math.prod(1.0 - k / i for i in range(n - c + 1, n + 1))


def test_pass_at_k_formula(spark):
    cases = [(20, 3, 10), (20, 15, 10), (5, 0, 1), (10, 1, 1), (200, 50, 10)]
    df = spark.createDataFrame(cases, "n int, c int, k int")
    for (n, c, k), r in zip(cases, df.collect()):
        got = df.filter((F.col("n") == n) & (F.col("c") == c)).select(pass_at_k(F.col("n"), F.col("c"), k)).collect()[0][0]
        assert abs(got - (_pass_at_k(n, c, k) if c > 0 else 0.0)) < 1e-12


def test_baseline_missing_zero_and_equal(spark):
    res = spark.createDataFrame([("humaneval", 80.0), ("gsm8k", 82.6), ("custom", 50.0)], "benchmark string, score double")
    base = baselines_df(spark, [("humaneval", 0.0), ("gsm8k", 82.6)])
    rows = {r.benchmark: r for r in with_baselines(res, base).select(
        "benchmark", "baseline", terminal_delta(F.col("delta")).alias("t"), markdown_delta(F.col("delta")).alias("m")).collect()}
    assert rows["humaneval"].baseline is None and rows["humaneval"].t == "—"
    assert rows["custom"].t == "—"
    assert rows["gsm8k"].t == "0.0" and rows["gsm8k"].m == "+0.0%"


def test_summary_averages_all_baselines(spark):
    res = spark.createDataFrame([("mmlu", 70.0)], "benchmark string, score double")
    s = report_summary(res, baselines_df(spark)).collect()[0]
    assert s.num_benchmarks == 1 and abs(s.baseline_average - (79.9 + 82.6 + 74.2) / 3) < 1e-9


@pytest.mark.parametrize("n,top,bottom,overlap", [(10, 10, 0, 0), (12, 10, 10, 8)])
def test_top_bottom(spark, n, top, bottom, overlap):
    subj = spark.createDataFrame([(f"s{i}", float(i), i) for i in range(n)], "subject string, accuracy double, first_seen int")
    out = top_bottom_subjects(subj).collect()
    t = {r.subject for r in out if r.list == "top"}
    b = {r.subject for r in out if r.list == "bottom"}
    assert (len(t), len(b), len(t & b)) == (top, bottom, overlap)


def test_numbers_in_digits_of_any_script(spark):
    """As Python's patterns and float() read them."""
    import re

    texts = ["#### ١٢٣", "#### 1٢,٣٤٥.٥ x", "４２.５ and 𝟗𝟖.𝟕", "#### -९९", "Ⅷ ½ ²", "#### ٣٫٥ then 7", "#### 1.2.3", "no number", "٠", "1٬000", "#### ,", "-٥٥.", "፩ is no decimal digit", "৯৮৭"]

    def number(s):
        try:
            return float(s.replace(",", ""))
        except ValueError:
            return None

    def read(t):
        marked = re.search(r"####\s*([-\d,.]+)", t)
        if marked and (n := number(marked.group(1))) is not None:
            return n
        runs = re.findall(r"[-\d,]+\.?\d*", t)
        return number(runs[-1]) if runs else None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.x for r in df.select("t", extract_numeric_answer("t").alias("x")).collect()} == {t: read(t) for t in texts}
