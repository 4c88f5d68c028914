"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import chatmill
from chatmill.session import scratch_path

_shipped: set[str] = set()

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage, survives lost executors and keeps column pruning."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def number_rows(docs: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows, for one pass only: another one may cut the same table
    into other splits and so give other numbers."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def with_row_id(docs: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows and write them, so that all later passes see the same
    numbers.  Needed because ``doc_id`` may be NULL or repeated."""
    return staged(number_rows(docs, name), "numbered")


def rows_of(docs: DataFrame, row: str | None) -> DataFrame:
    """``_row, doc_id, text``: with the written numbers of column ``row``, or new ones."""
    if row is None:
        return with_row_id(docs.select("doc_id", "text"))
    return docs.select(F.col(row).alias("_row"), "doc_id", "text")


def fold_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else.  ``lower`` does just that to a text without
    multi-byte characters, and faster than ``translate``."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes, NULL as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b"").cast("binary"))


def fold_of(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; -1 for a NULL key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(-1)).cast("int")



def ship(spark: SparkSession) -> None:
    """Send this package along to the Python workers (as ``--py-files``
    does), wherever the session's own path points."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(chatmill.__file__)))
        folder = tempfile.mkdtemp()  # the driver's; Spark serves the file to executors
        context.addPyFile(shutil.make_archive(os.path.join(folder, "chatmill"), "zip", root, "chatmill"))
        _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
