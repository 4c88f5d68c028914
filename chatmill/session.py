"""Session helpers.

Cluster jobs take the session they are given.  ``local_session`` exists for
tests and the bench: it pins UTC, keeps the UI off and turns AQE on.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "chatmill") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # rows here are CPU-heavy text: keep post-shuffle stages parallel even
        # when their bytes are few (the default merges < 1 MB into one task)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                os.environ.get("CHATMILL_MIN_PARTITION_SIZE", "64k"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove checkpoint files once their DataFrame is garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("CHATMILL_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is given and used as is; a cluster without one
    is an error, since executors could not share a machine-local folder.
    Only a local session (tests) gets a folder of its own.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if sc_dir:
        return sc_dir
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local_dir = tempfile.mkdtemp(prefix="chatmill-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(local_dir)
    return local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (for streaming
    checkpoints and intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it
    back (reliable checkpoint; survives executor loss).  Used between stages
    whose input would otherwise be recomputed by several passes."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_once(df, name: str):
    """Like :func:`materialize`, but as a Parquet table: later passes read
    only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
