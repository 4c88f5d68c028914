"""Validation of a stream of requests into several tables.

Request lines (chat or completion shape) land as text files.  Each micro-batch
is validated once and goes to three tables: ``accepted``, ``quarantine`` (with
the reason and the line as it came) and ``metrics`` (one row per batch, shape
and verdict).  Every batch writes folders of its own, numbered by the batch and
replaced if they are there, so a batch that is run again after a failure
leaves no row twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.serving import REQUEST_DEFAULTS, REQUEST_RANGES, range_check
from ..sources.jsonl import parse_json

CHAT, COMPLETION = "chat", "completion"
#: fields that only chat requests have
CHAT_ONLY = ("repetition_penalty",)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _number(v: Column, name: str) -> tuple[Column, Column]:
    """(value, whether the field is there but no number); booleans are no numbers."""
    field = F.try_variant_get(v, f"$.{name}", "variant")
    kind = _kind(field)
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(number, F.try_variant_get(v, f"$.{name}", "double")), field.isNotNull() & ~number


def validated(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines with ``shape`` (chat, completion, NULL: neither), the request's
    fields with defaults filled in, and ``reason``: NULL for a valid request,
    else the first rule it breaks."""
    df = lines.withColumn("_cm_v", parse_json(value))
    v = F.col("_cm_v")
    is_object = F.coalesce(_kind(v).startswith("OBJECT"), F.lit(False))
    turns, prompt = F.try_variant_get(v, "$.messages", "variant"), F.try_variant_get(v, "$.prompt", "variant")
    shape = F.when(is_object & turns.isNotNull(), F.lit(CHAT)).when(is_object & prompt.isNotNull(), F.lit(COMPLETION))
    each = F.try_variant_get(v, "$.messages", "array<variant>")
    text = lambda t, f: F.when(_kind(F.try_variant_get(t, f"$.{f}", "variant")) == "STRING", F.try_variant_get(t, f"$.{f}", "string"))
    df = df.withColumn("shape", shape).withColumn("messages", F.transform(each, lambda t: F.struct(text(t, "role").alias("role"), text(t, "content").alias("content"))))
    df = df.withColumn("prompt", F.when(_kind(prompt) == "STRING", F.try_variant_get(v, "$.prompt", "string")))
    checks = [F.when(v.isNull(), F.lit("not JSON")), F.when(F.col("shape").isNull(), F.lit("neither messages nor prompt")),
              F.when((F.col("shape") == CHAT) & F.col("messages").isNull(), F.lit("messages is no list")),
              F.when((F.col("shape") == CHAT) & (F.size("messages") == 0), F.lit("messages empty")),
              F.when((F.col("shape") == CHAT) & F.exists("messages", lambda m: m["role"].isNull() | m["content"].isNull()), F.lit("a message lacks role or content")),
              F.when((F.col("shape") == COMPLETION) & F.col("prompt").isNull(), F.lit("prompt is no text"))]
    for name, default in REQUEST_DEFAULTS.items():
        if name not in REQUEST_RANGES:
            continue
        number, wrong = _number(v, name)
        own = (F.col("shape") == CHAT) if name in CHAT_ONLY else F.lit(True)
        df = df.withColumn(name, F.when(own, F.coalesce(number, F.lit(float(default)))))
        checks.append(F.when(own & wrong, F.lit(f"{name} is no number")))
        if isinstance(default, int):
            checks.append(F.when(own & (number != F.floor(number)), F.lit(f"{name} is no whole number")))
    checks += [range_check(F.col(name), name) for name in REQUEST_RANGES]
    return df.withColumn("reason", F.coalesce(*checks)).drop("_cm_v")


def batch_writer(output: str, columns: list[str]):
    """The function for ``foreachBatch``: three tables under ``output``, a folder per batch in each."""
    def write(batch: DataFrame, number: int) -> None:
        checked = batch.persist()
        try:
            folder = lambda table: f"{output}/{table}/batch={number}"
            fields = ["shape", "messages", "prompt", *[n for n in REQUEST_DEFAULTS if n in REQUEST_RANGES]]
            checked.filter("reason IS NULL").select(*columns, *fields).write.mode("overwrite").parquet(folder("accepted"))
            checked.filter("reason IS NOT NULL").select(*columns, "shape", "reason").write.mode("overwrite").parquet(folder("quarantine"))
            (checked.groupBy("shape", F.coalesce("reason", F.lit("accepted")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))
             .write.mode("overwrite").parquet(folder("metrics")))
        finally:
            checked.unpersist()

    return write


def run_requests(spark: SparkSession, input_dir: str, output: str, checkpoint: str, files_per_batch: int = 1000, writer=None) -> None:
    """Process every file in ``input_dir`` that was not processed yet."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(input_dir).select("value")
    query = (validated(lines).writeStream.foreachBatch(writer or batch_writer(output, ["value"]))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def read_table(spark: SparkSession, output: str, table: str) -> DataFrame:
    """One of the tables, with the batch of each row."""
    return spark.read.parquet(f"{output}/{table}")
