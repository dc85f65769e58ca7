"""Row numbers, neighbours and runs over a whole ordered table, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from skyloom.operators.skew import join_groups
from skyloom.session import stored

# monotonically_increasing_id keeps the row number within the partition in the low 33 bits.
_ROW_BITS = (1 << 33) - 1


def with_row_index(df: DataFrame, order: list, index: str = "idx") -> DataFrame:
    """Consecutive 0-based numbers in the given order.

    The table is range-partitioned, sorted and written once, as columns, together with the number of
    each row's partition and its place there, so the numbers cannot change afterwards and later steps
    read only the columns they need. The start of each partition is a running sum over one row per
    partition.
    """
    numbered = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(_ROW_BITS).alias("_row")
    )
    placed = stored(numbered)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # one row per partition of the table: bounded by the partition count, not by the data
    return placed.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + F.col("_row")).alias(index))


def with_group_index(df: DataFrame, keys: list[str], order: list, index: str = "idx") -> DataFrame:
    """0-based numbers that restart for every key."""
    numbered = with_row_index(df, [*keys, *order], "_global")
    first = numbered.groupBy(*keys).agg(F.min("_global").alias("_first"))
    return join_groups(numbered, first, keys).select(*df.columns, (F.col("_global") - F.col("_first")).alias(index))


CHUNK_ROWS = 50_000


def with_following(indexed: DataFrame, columns: list[str], ahead: int, index: str = "idx", chunk: int = CHUNK_ROWS) -> DataFrame:
    """Columns of the next ``ahead`` rows as ``name1``, ``name2``, … (null past the end).

    Windows run over chunks of row numbers, not over keys, so their size is fixed; the first rows
    of a chunk are also copied to the end of the one before.
    """
    own = F.floor(F.col(index) / chunk)
    halo = (F.col(index) % chunk < ahead) & (own > 0)
    placed = indexed.select("*", F.explode(F.when(halo, F.array(own, own - 1)).otherwise(F.array(own))).alias("_chunk"))
    order = Window.partitionBy("_chunk").orderBy(index)
    led = [F.lead(c, n).over(order).alias(f"{c}{n}") for n in range(1, ahead + 1) for c in columns]
    return placed.select("*", *led).where(F.col("_chunk") == own).drop("_chunk")


def contiguous_runs(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Runs of consecutive integers of ``value`` per key: first, last and length."""
    distinct = df.select(*keys, value).distinct()
    numbered = with_row_index(distinct, [*keys, value])
    return (
        numbered.groupBy(*keys, (F.col(value) - F.col("idx")).alias("_run"))
        .agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("length"))
        .drop("_run")
    )
