"""Ingest-side operators: capped ingest, skip-if-present, raw path
resolution, line counts and file inventories.  Listings come from Spark's
``binaryFile`` source with the content column pruned from the read schema,
so only paths and lengths are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import write_once

# --- fixed values: search order of raw categories, inventory ignore list -----
RAW_CATEGORY_ORDER = ["instruction", "coding", "math", "evaluation"]
IGNORE_PATTERNS_RE = r"(\.pyc$|/__pycache__/|\.log$|/\.DS_Store$)"
# ---------------------------------------------------------------------------


#: rows that one entry of the row-count index stands for
UNIT_ROWS = 1 << 16
#: files named one by one to the scan; beyond that the index join drops the others' rows
NAMED_FILES = 10_000


def first_of_partitions(df: DataFrame, groups: list[str], order: str, limit: Column) -> DataFrame:
    """The rows that are among the first ``limit`` of their group within
    their input partition.  Under a literal limit Spark keeps no more than that
    while it reads."""
    near = df.withColumn("_cm_part", F.spark_partition_id())
    local = F.row_number().over(Window.partitionBy("_cm_part", *groups).orderBy(order))
    return near.withColumn("_cm_rn", local).filter(F.col("_cm_rn") <= limit).drop("_cm_rn", "_cm_part")


def capped_ingest(df: DataFrame, groups: list[str], order: str, cap) -> DataFrame:
    """First ``cap`` rows per group in stream order (not a random sample).

    ``cap`` is an int, or a column name holding a per-group cap (NULL = all
    rows).  NULL is a group like any other; ``order`` may be any orderable
    column.  Rows are ranked within each input partition first and those past
    the cap dropped there.  The survivors are dealt by ranges of (group,
    order) and ranked inside their range; counts of the ranges before give the
    rest, so no task holds a hot group, whatever the cap.  Groups without a cap
    are not ranked at all.
    """
    limit = F.lit(cap) if isinstance(cap, int) else F.col(cap)
    keys = F.struct(F.lit(0).alias("_cm_one"), *groups)
    out = df.withColumn("_cm_cap", limit.cast("long"))
    near = first_of_partitions(out.filter(F.col("_cm_cap").isNotNull()), groups, order, limit)
    ranged = (near.repartitionByRange(*groups, order).sortWithinPartitions(*groups, order)
              .withColumn("_cm_row", F.monotonically_increasing_id()).withColumn("_cm_group", keys))
    ranged = write_once(ranged.withColumn("_cm_range", F.shiftright("_cm_row", 33)), "capped-rows")  # ranges are sampled: one evaluation
    counts = ranged.groupBy("_cm_group", "_cm_range").agg(F.count(F.lit(1)).alias("_cm_n"), F.min("_cm_row").alias("_cm_first"))
    earlier = Window.partitionBy("_cm_group").orderBy("_cm_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = counts.withColumn("_cm_before", F.coalesce(F.sum("_cm_n").over(earlier), F.lit(0)))
    ranked = ranged.join(counts, ["_cm_group", "_cm_range"]).filter(F.col("_cm_before") + F.col("_cm_row") - F.col("_cm_first") < F.col("_cm_cap"))
    return ranked.select(*df.columns).unionByName(out.filter(F.col("_cm_cap").isNull()).select(*df.columns))


def capped_scan(spark: SparkSession, path: str, groups: list[str], cap: Column, columns: list[str] | None = None, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """First rows of each group of a Parquet dataset in stream order (files by
    path, rows as they stand in the file), as many as ``cap`` says (a column of
    the group's values; NULL = all rows), stopping early.

    A row-count index is made first: rows of each group per ``unit_rows`` rows
    of a file, read from the group columns alone (from the footers alone if
    there are none).  Prefix sums over it tell which units lie whole within a
    cap and which one holds its end.  Only files with such units are opened for
    the other columns, and only the units that hold an end are ranked, each by
    itself.  Rows read are bounded by the caps plus what else the last unit's
    file holds."""
    def rows():
        return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_cm_file"), F.col("_metadata.row_index").alias("_cm_row"))

    unit = F.call_function("div", F.col("_cm_row"), F.lit(unit_rows)).alias("_cm_unit")
    keys = F.struct(F.lit(0).alias("_cm_one"), *groups)
    index = (rows().select(keys.alias("_cm_group"), cap.cast("long").alias("_cm_cap"), "_cm_file", unit)
             .groupBy("_cm_group", "_cm_cap", "_cm_file", "_cm_unit").agg(F.count(F.lit(1)).alias("_cm_n")))
    upto = F.sum("_cm_n").over(Window.partitionBy("_cm_group").orderBy("_cm_file", "_cm_unit"))  # one row per unit
    index = index.withColumn("_cm_before", upto - F.col("_cm_n"))
    index = index.filter(F.col("_cm_cap").isNull() | (F.col("_cm_before") < F.col("_cm_cap")))
    index = write_once(index.withColumn("_cm_whole", F.col("_cm_cap").isNull() | (F.col("_cm_before") + F.col("_cm_n") <= F.col("_cm_cap"))), "row-index")
    files = [r[0] for r in index.select("_cm_file").distinct().limit(NAMED_FILES + 1).collect()]
    wanted = rows().select(*(columns or spark.read.parquet(path).columns), keys.alias("_cm_group"), "_cm_file", "_cm_row", unit)
    if len(files) <= NAMED_FILES:  # a filter on the path prunes files before they are opened
        wanted = wanted.filter(F.col("_cm_file").isin(files)) if files else wanted.limit(0)
    joined = wanted.join(index, ["_cm_group", "_cm_file", "_cm_unit"])
    own = [c for c in wanted.columns if not c.startswith("_cm_")]
    place = F.row_number().over(Window.partitionBy("_cm_group", "_cm_file", "_cm_unit").orderBy("_cm_row"))
    ends = joined.filter(~F.col("_cm_whole")).withColumn("_cm_rn", place).filter(F.col("_cm_before") + F.col("_cm_rn") <= F.col("_cm_cap"))
    return joined.filter("_cm_whole").select(*own).unionByName(ends.select(*own))


def head(df: DataFrame, order: str, max_samples: int | None) -> DataFrame:
    """Benchmark scan with an optional head limit ``min(max_samples, n)``."""
    return df if not max_samples else df.orderBy(order).limit(int(max_samples))


def file_listing(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """path, length, modificationTime of every file under ``root``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length", "modificationTime")


def inventory(listing: DataFrame) -> DataFrame:
    """File count and total bytes (before the ignore filter, as the
    reference reports them) and the count of files that would be uploaded."""
    ignored = F.col("path").rlike(IGNORE_PATTERNS_RE)
    return listing.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
                       F.count_if(~ignored).alias("kept_files"))


def resolve_raw_paths(listing: DataFrame, names: DataFrame, raw_root: str) -> DataFrame:
    """For each dataset name, the first existing
    ``<raw_root>/<category>/<name>/dataset.jsonl`` in category order; status
    ``not_found`` when none exists."""
    cats = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(i).alias("rank"))
                     for i, c in enumerate(RAW_CATEGORY_ORDER)])
    root = raw_root.rstrip("/")
    candidates = names.select("name", F.inline(cats)).withColumn(
        "path", F.concat(F.lit(root + "/"), F.col("category"), F.lit("/"), F.col("name"), F.lit("/dataset.jsonl")))
    found = listing.select(F.regexp_replace("path", "^file:", "").alias("path"))
    hits = candidates.join(found, "path", "left_semi")
    w = Window.partitionBy("name").orderBy("rank")
    first = hits.withColumn("_cm_rn", F.row_number().over(w)).filter("_cm_rn = 1").drop("_cm_rn", "rank")
    return (names.select("name").join(first, "name", "left")
                 .withColumn("status", F.when(F.col("path").isNull(), F.lit("not_found")).otherwise(F.lit("found"))))


def skip_present(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Skip-if-present: a dataset whose target is non-empty is not rewritten;
    it is reported with checksum and size but ``num_examples = 0``."""
    present = listing.filter(F.col("length") > 0).select(
        F.regexp_replace("path", "^file:", "").alias("path"), F.col("length").alias("present_bytes"))
    j = manifest.join(present, "path", "left")
    return (j.withColumn("status", F.when(F.col("present_bytes").isNotNull(), F.lit("skipped"))
                                   .otherwise(F.col("status")))
             .withColumn("num_examples", F.when(F.col("present_bytes").isNotNull(), F.lit(0))
                                         .otherwise(F.col("num_examples")))
             .withColumn("size_bytes", F.coalesce("present_bytes", "size_bytes"))
             .drop("present_bytes"))


def line_counts(spark: SparkSession, paths) -> DataFrame:
    """Physical lines per file (the train-input precheck and the line-count
    verification)."""
    return (spark.read.text(paths).groupBy(F.col("_metadata.file_path").alias("path"))
                 .agg(F.count(F.lit(1)).alias("lines")))


def source_from_file(path_col: str = "file", suffix: str = "_cleaned.jsonl") -> F.Column:
    """``.../openhermes_cleaned.jsonl`` -> ``openhermes``."""
    return F.regexp_replace(F.regexp_extract(F.col(path_col), r"([^/]+)$", 1), suffix.replace(".", r"\.") + "$", "")
