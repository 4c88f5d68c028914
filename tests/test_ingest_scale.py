"""Caps that stop early, caps of hot groups, and digests that add up over splits."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chatmill.functions import sql
from chatmill.functions.answers import extract_choice, extract_numeric_answer
from chatmill.functions.chat import content_hash
from chatmill.functions.text import is_valid_content, normalize_text
from chatmill.sources.digest import PRIME, file_digests, merged, split_digests
from chatmill.sources.ingest import capped_ingest, capped_scan

ROWS = 30_000


def _source(i):
    return ["hot", "hot", "a", None, "b", "hot"][i % 6] if i < 29_000 else "late"


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    """Six files in stream order; a hot source, a NULL source, one that begins late."""
    folder = str(tmp_path_factory.mktemp("stream") / "data")
    df = spark.createDataFrame([(i, _source(i), "x" * (i % 50)) for i in range(ROWS)], "i long, source string, payload string")
    df.repartitionByRange(6, "i").sortWithinPartitions("i").write.parquet(folder)
    return folder


@pytest.mark.parametrize("caps", [{"hot": 25}, {"hot": 1001, "a": 0}, {"hot": 500_000, None: 3}, {"hot": None, "late": 2}, {"hot": 4000, "a": 4000, "b": 1, None: None, "late": 999}])
def test_capped_scan(spark, dataset, caps):
    cap = F.lit(7).cast("long")
    for name, n in caps.items():
        cap = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(n).cast("long")).otherwise(cap)
    got = {r.i for r in capped_scan(spark, dataset, ["source"], cap, ["i", "source"], unit_rows=500).collect()}
    expected, seen = set(), {}
    for i in range(ROWS):
        s = _source(i)
        seen[s] = seen.get(s, 0) + 1
        if (limit := caps.get(s, 7)) is None or seen[s] <= limit:
            expected.add(i)
    assert got == expected


def _files_opened(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return [s.metrics().apply("numFiles").value() for s in scans if "parquet" in s.toString() and s.metrics().contains("numFiles") and "payload" in s.toString()]


def test_capped_scan_opens_only_the_files_it_needs(spark, dataset):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        first = capped_scan(spark, dataset, [], F.lit(900), ["i", "payload"], unit_rows=500)
        assert set(_files_opened(first)) == {1}
        assert sorted(r.i for r in first.collect()) == list(range(900))
        whole = capped_scan(spark, dataset, [], F.lit(None), ["i", "payload"])
        assert max(_files_opened(whole)) == 6 and whole.count() == ROWS
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert capped_scan(spark, dataset, ["source"], F.lit(0)).count() == 0


@pytest.mark.parametrize("cap", [1, 25, 1001, 500_000, None])
def test_capped_ingest_of_any_cap(spark, cap):
    rows = [(i, _source(i)) for i in range(ROWS)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "i long, source string").repartition(9).withColumn("own_cap", F.lit(cap).cast("long"))
    got = sorted(r.i for r in capped_ingest(df, ["source"], "i", "own_cap").collect())
    w = Window.partitionBy("source").orderBy("i")
    ref = df.withColumn("rn", F.row_number().over(w)).filter(F.lit(cap).isNull() | (F.col("rn") <= F.lit(cap)))
    assert got == sorted(r.i for r in ref.collect())


LINES = [f"line {i % 97} é" for i in range(4000)] + ["", "", "last"]


def _digest(spark, folder, lines, split="128m"):
    folder.mkdir()
    (folder / "x.txt").write_text("".join(x + "\n" for x in lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        return file_digests(spark, str(folder)).collect()[0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_digest_is_that_of_the_lines(spark, tmp_path):
    import hashlib
    d = [int(hashlib.md5(("line:" + x).encode()).hexdigest()[:15], 16) for x in LINES]
    r = _digest(spark, tmp_path / "a", LINES)
    assert (r.n, int(r.plain), int(r.weighted)) == (len(d), sum(d) % PRIME, sum(i * x for i, x in enumerate(d, 1)) % PRIME)


def test_digest_does_not_depend_on_splits_and_sees_every_change(spark, tmp_path):
    whole = _digest(spark, tmp_path / "a", LINES).digest
    assert _digest(spark, tmp_path / "b", LINES, "3k").digest == whole
    changed = {"byte": [*LINES[:7], LINES[7][:-1] + "e", *LINES[8:]], "missing": LINES[:-1], "repeated": [*LINES, LINES[0]], "moved": [*LINES[1:], LINES[0]],
               "swapped": [LINES[1], LINES[0], *LINES[2:]]}
    found = {k: _digest(spark, tmp_path / k, x, "3k") for k, x in changed.items()}
    assert len({whole, *(r.digest for r in found.values())}) == 6
    plain = _digest(spark, tmp_path / "c", LINES).plain
    assert {k for k, r in found.items() if r.plain == plain} == {"moved", "swapped"}  # the same lines in another order


def test_digests_of_files_add_up(spark, tmp_path):
    (tmp_path / "all").mkdir()
    for k in range(3):
        (tmp_path / "all" / f"{k}.txt").write_text("".join(x + "\n" for x in LINES[k::3]))
    one = _digest(spark, tmp_path / "one", [x for k in range(3) for x in LINES[k::3]])
    both = merged(split_digests(spark, str(tmp_path / "all")).withColumn("all", F.lit(1)), ["all"]).collect()[0]
    assert both.digest == one.digest


TEXTS = [None, "", "  ", "abc", "abcde", " é́  x\t\ty\n\n\n\nz\x00\x07 ", "A", " answer: (c) ", "Based", "#### 1,234.5 x", "no, 12 and -3.", "####", "-", ",", "12,", "…………", "a" * 32_769, "ﬁ Ⅷ 中文 text",
         "it's \\ a 'quoted' \"text\"", "\xa0b\x85", "7.", "#### ١٬٢٣", "#### ١٢٣٫", "sum ４２.５ and 𝟗𝟖.𝟕", "#### -९९"]


def test_sql_functions_say_what_the_columns_say(spark):
    names = sql.register(spark, "t_")
    assert "t_normalize_text" in names
    df = spark.createDataFrame([(t,) for t in TEXTS], "s string")
    df.createOrReplaceTempView("sql_texts")
    out = spark.sql("""SELECT s, t_normalize_text(s) AS n, t_is_valid_content(s) AS v, t_numeric_answer(s) AS x, t_choice_answer(s) AS c,
                       t_content_key(array(named_struct('role', 'user', 'content', s), named_struct('role', 'system', 'content', 'x'))) AS k FROM sql_texts""")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "t_normalize_text" not in plan
    messages = F.array(F.struct(F.lit("user").alias("role"), F.col("s").alias("content")), F.struct(F.lit("system").alias("role"), F.lit("x").alias("content")))
    ours = df.select("s", normalize_text("s").alias("n"), is_valid_content("s").alias("v"), extract_numeric_answer("s").alias("x"), extract_choice("s").alias("c"), content_hash(messages).alias("k"))
    assert sorted(map(repr, out.collect())) == sorted(map(repr, ours.collect()))
