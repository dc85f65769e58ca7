"""Starting streams to completion and keeping their results as tables of the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyloom.session import scratch_path
from skyloom.sources.versions import Spec, TableSet

EVENTS = "event_id bigint, ts timestamp, star_id bigint, filter string, flux double, props string"


def file_stream(spark: SparkSession, path: str, schema: str = EVENTS, files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder in the order of their arrival; the checkpoint remembers which ones are done."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def run_append(stream: DataFrame, path: str, checkpoint: str | None = None) -> str:
    """Everything available now into a parquet table, exactly once per checkpoint."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return path


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> None:
    """Everything available now through ``foreachBatch``."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(handle)
        .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, "stream-state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()


TABLE = "updates"
MERGE_EVERY = 8


def update_table(spark: SparkSession, path: str, schema: str, keys: list[str], order: list[str] | None = None) -> TableSet:
    """A table of updates: the last batch per key counts, and within a batch the last row by ``order``."""
    return TableSet(spark, path, {TABLE: Spec(schema, tuple(keys), tuple(order or ()))})


def batch_writer(table: TableSet, every: int = MERGE_EVERY, stream: str = "stream") -> Callable[[DataFrame, int], None]:
    """Handler of micro-batches: each becomes a folder of its own, and full levels of folders are merged inside the stream.

    A repeated batch is known by its number and changes nothing; a merge that was cut off is made up
    for with the next batch. Readers meet a number of folders in the order of the logarithm of the batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.refresh().commit(f"{stream} {batch_id}", {TABLE: batch}, stream=(stream, batch_id))
        before = table.state["version"]
        table.tidied(TABLE, every)
        if table.state["version"] != before:
            table.expire()

    return write


def latest(table: TableSet) -> DataFrame:
    """Current state of a table of updates."""
    return table.refresh().read(TABLE)
