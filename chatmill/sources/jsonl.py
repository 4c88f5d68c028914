"""JSON-lines scans.

``read_lines`` is the cleaning scan: every physical line is an input row
(blank lines included) with a stable order key assigned at the scan, before
any shuffle, so "first occurrence" is well defined and survives task retries.
``parse_json`` is the one place that decides whether a line is JSON, as
Python's ``json.loads`` does, and the lenient and the strict scan rest on it,
so a line's verdict does not depend on the columns that are read.
``number_lines`` turns the order key into physical line numbers by an index of
line counts per file split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chat import MESSAGES_TYPE
from ..functions.text import unicode_strip

MESSAGES_ROW = T.StructType([T.StructField("messages", MESSAGES_TYPE)])

# --- fixed values: what json.loads takes beyond standard JSON ------------------
#: words for numbers that have no JSON form (outside strings)
SPECIAL_NUMBERS = ("NaN", "Infinity", "-Infinity")
# ---------------------------------------------------------------------------

# what stands before a special number: other text and whole strings; possessive, so it is matched without backtracking
_BEFORE_SPECIAL = r'\G((?:[^"NI-]++|-(?!Infinity|NaN)|"(?:[^"\\]++|\\.)*+")*+)'
_SPECIAL = "(?:" + "|".join(SPECIAL_NUMBERS) + ")"
#: stands for a special number in the parsed value: no text, and no part of a number next to it
_STAND_IN = "null"


def allow_repeated_keys(spark: SparkSession) -> None:
    """A repeated key is valid JSON and the last one counts; Spark's parser
    does the same once this setting of the session is on."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def parse_json(value) -> Column:
    """The value of a line's JSON text as VARIANT; NULL where ``json.loads``
    raises.  White space around the line goes first.

    Spark's parser stops after the first value, so a text is also parsed
    inside brackets and inside an object: text after the value closes or
    continues one of the two, and then there is an error or a second element.
    NaN and Infinity outside strings are values (read as null).  Turns
    :func:`allow_repeated_keys` on in the active session."""
    allow_repeated_keys(SparkSession.active())
    raw = unicode_strip(value)
    special = F.contains(raw, F.lit("NaN")) | F.contains(raw, F.lit("Infinity"))
    text = F.when(special, F.regexp_replace(raw, _BEFORE_SPECIAL + _SPECIAL, "$1" + _STAND_IN)).otherwise(raw)
    # only text with a bracket of its own can close the array early
    whole = ~F.contains(text, F.lit("]")) | F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    only = F.transform(F.array(in_array), lambda v: F.when(  # parsed once, looked at twice
        F.try_variant_get(v, "$[1]", "variant").isNull(), F.try_variant_get(v, "$[0]", "variant")))[0]
    return F.when((F.length(raw) > 0) & whole, only)


def read_lines(spark: SparkSession, paths, source: str | None = None) -> DataFrame:
    """One row per physical line: ``source, file, seq, value, parsed``.

    ``seq`` = (file path, split start, monotonically increasing id): splits of
    a file are read in offset order, ids grow within a split, so ``seq``
    orders lines as they appear in the file.  ``parsed`` is NULL for a line
    that is not JSON (blank lines included).
    """
    df = spark.read.text(paths)
    df = df.select(
        F.lit(source).alias("source") if source is not None else F.lit(None).cast("string").alias("source"),
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("seq"),
        F.col("value"),
    )
    return df.withColumn("parsed", parse_json("value"))


def line_index(lines: DataFrame, by: str | None = None, seq: str = "seq") -> DataFrame:
    """One row per file split of ``lines``: its number of lines, its first
    row id, and ``before``, the lines of the splits before it (of the file, or
    of all files of one value of ``by``, in path order).  ``lines`` must be
    written first (:func:`~..session.write_once`): row ids are given anew by
    every scan, and another scan may cut the files elsewhere."""
    splits = lines.groupBy(*([by] if by else []), F.col(f"{seq}.file").alias("_cm_file"), F.col(f"{seq}.block").alias("_cm_block")).agg(
        F.count(F.lit(1)).alias("_cm_lines"), F.min(f"{seq}.row").alias("_cm_first"))
    earlier = Window.partitionBy(*([by] if by else ["_cm_file"])).orderBy("_cm_file", "_cm_block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("_cm_before", F.coalesce(F.sum("_cm_lines").over(earlier), F.lit(0)))


def number_lines(lines: DataFrame, by: str | None = None, out: str = "line", seq: str = "seq") -> DataFrame:
    """Adds ``out``: the 1-based physical line number in the file, or in the
    files of one value of ``by`` (a column without NULLs) one after the other."""
    index = line_index(lines, by, seq).drop(*([by] if by else []))
    here = (F.col(f"{seq}.file") == F.col("_cm_file")) & (F.col(f"{seq}.block") == F.col("_cm_block"))
    numbered = lines.join(index, here).withColumn(out, F.col("_cm_before") + F.col(f"{seq}.row") - F.col("_cm_first") + 1)
    return numbered.drop("_cm_file", "_cm_block", "_cm_lines", "_cm_first", "_cm_before")


def _fields(parsed: Column, schema: T.StructType) -> list[Column]:
    return [F.try_variant_get(parsed, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema]


def read_jsonl_lenient(spark: SparkSession, paths, schema: T.StructType = MESSAGES_ROW) -> DataFrame:
    """Lines that are not JSON are dropped silently; of the others the fields
    of ``schema``, NULL where a line has none of that name and type.  Which
    lines stay does not depend on the columns selected afterwards."""
    lines = read_lines(spark, paths)
    return lines.filter(F.col("parsed").isNotNull()).select(*_fields(F.col("parsed"), schema))


def read_jsonl_strict(spark: SparkSession, paths, schema: T.StructType = MESSAGES_ROW) -> DataFrame:
    """The first bad line fails the job; only ``messages`` is read."""
    lines = read_lines(spark, paths)
    bad = F.raise_error(F.concat(F.lit("not a JSON line in "), F.col("file"), F.lit(": "), F.substring("value", 1, 200)))
    checked = lines.withColumn("parsed", F.when(F.col("parsed").isNull(), bad.cast("variant")).otherwise(F.col("parsed")))
    messages = [f for f in schema if f.name == "messages"]
    return checked.select(*_fields(F.col("parsed"), T.StructType(messages)))


def messages_from_json(c: str = "messages"):
    """JSON-string column -> nested messages."""
    return F.from_json(F.col(c), MESSAGES_TYPE)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A missing input is an empty dataset with the expected schema."""
    return spark.createDataFrame([], schema)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A whole JSON document per file (evaluation report, manifest)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
