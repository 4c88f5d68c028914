import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatmill.operators.dedup import flag_duplicates, keep_first
from chatmill.operators.outcomes import (classify_lines, outcome_counts, outcome_counts_single_pass,
                                         outcome_summary)
from chatmill.sources.jsonl import read_lines


def test_keep_first_equals_window_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["s1", "s2"]), rnd.choice(["k1", "k2", "k3", None])) for i in range(300)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "seq long, source string, key string").repartition(5)
    got = {r.seq for r in keep_first(df, ["source", "key"], "seq").collect()}
    w = Window.partitionBy("source", "key").orderBy("seq")
    ref = {r.seq for r in df.withColumn("rn", F.row_number().over(w))
           .filter((F.col("rn") == 1) | F.col("key").isNull()).collect()}
    assert got == ref


def test_hot_key_is_combined_map_side(spark):
    # one key holds most rows: the plan aggregates partially before the shuffle
    df = spark.range(0, 5000).select(F.col("id").alias("seq"), F.lit("s").alias("source"),
                                     F.when(F.col("id") % 10 == 0, F.col("id").cast("string"))
                                      .otherwise(F.lit("hot")).alias("key"))
    out = flag_duplicates(df, ["source", "key"], "seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert out.filter(~F.col("is_duplicate")).count() == 501


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_clean_outcomes_from_files(spark, tmp_path):
    q = lambda a, b: '{"question": "%s", "answer": "%s"}' % (a, b)
    lines = [q("what is two plus two", "it is four"), "{bad", "",
             q("what is two plus two", "it is four"),              # duplicate
             q("hi", "it is four"),                                # conversion fails
             q("another question", "another answer")]
    _write(tmp_path / "gsm8k.jsonl", lines)
    df = read_lines(spark, str(tmp_path / "gsm8k.jsonl"), source="gsm8k")
    classified = classify_lines(df, "qa")
    outcomes = [r.outcome for r in classified.orderBy("seq").collect()]
    assert outcomes == ["kept", "parse_error", "parse_error", "duplicate", "conversion_failed", "kept"]
    counts = outcome_counts(classified).collect()[0]
    assert (counts.input, counts.output, counts.parse_error, counts.conversion_failed, counts.duplicate) == (6, 2, 2, 1, 1)
    assert counts.input == counts.output + counts.dropped
    keyed = classified.drop("outcome")
    single = outcome_counts_single_pass(keyed).collect()[0]
    assert single.asDict() == counts.asDict()
    summary = {r.source: r for r in outcome_summary(outcome_counts(classified)).collect()}
    assert summary["Total"].input == 6 and abs(summary["Total"].retention_pct - 100 * 2 / 6) < 1e-9


def test_same_row_in_two_sources_both_kept(spark):
    df = spark.createDataFrame([(1, "a", "k"), (2, "b", "k"), (3, "a", "k")], "seq long, source string, key string")
    assert sorted(r.seq for r in keep_first(df, ["source", "key"], "seq").collect()) == [1, 2]
