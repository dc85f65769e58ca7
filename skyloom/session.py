"""Session construction and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "skyloom", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SKYLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, taken from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a new temporary folder; a cluster session
    without it is an error, because a folder of one machine would not survive that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        # a folder set by setCheckpointDir() before, or the one made for this local session
        folder = spark.sparkContext.getCheckpointDir() or getattr(spark, "_skyloom_folder", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="skyloom-")
        spark._skyloom_folder = folder
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and keeps the partitions as they were written."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows written to a table of the shared folder and read back: for state carried through loops.

    A checkpoint keeps the constraints that the optimizer derived from the old plan, and in a loop
    they multiply; a table read back carries nothing but its rows.
    """
    path = scratch_path(df.sparkSession, "state")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
