"""Streaming transformations: DataFrame in, DataFrame out, on unbounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyloom.functions.common import num


def with_error(stream: DataFrame) -> DataFrame:
    """Flux error of a count rate, for weights."""
    return stream.withColumn("flux_err", F.sqrt("flux") / 10.0 + 0.01)


def dedupe(stream: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """First arrival of every key; ``delay`` must be longer than the longest replay."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def tumbling_bins(stream: DataFrame, keys: list[str], width: str, delay: str) -> DataFrame:
    """Weighted sums per window and key; partial sums are taken before the shuffle."""
    w = 1.0 / (F.col("flux_err") * F.col("flux_err"))
    return stream.withWatermark("ts", delay).groupBy(F.window("ts", width), *keys).agg(
        F.count("*").alias("n"), (F.sum(w * F.col("flux")) / F.sum(w)).alias("mean_flux"), F.sqrt(1.0 / F.sum(w)).alias("mean_err")
    )


def sliding_lookback(stream: DataFrame, keys: list[str], length: str, step: str, delay: str) -> DataFrame:
    """Counts in overlapping windows, made from counts per step.

    The rows are counted once per step; only those counts are copied into the windows, not the rows.
    """
    steps = stream.withWatermark("ts", delay).groupBy(F.window("ts", step), *keys).agg(F.count("*").alias("n"), F.sum("flux").alias("total"))
    return steps.groupBy(F.window(F.window_time("window"), length, step), *keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def session_visits(stream: DataFrame, keys: list[str], gap: str, delay: str) -> DataFrame:
    """Sequences of measurements without a gap longer than ``gap``, with the filters used."""
    return stream.withWatermark("ts", delay).groupBy(F.session_window("ts", gap), *keys).agg(
        F.count("*").alias("n"), F.sort_array(F.collect_set("filter")).alias("filters")
    )


def running_sums(stream: DataFrame, keys: list[str], around: float = 0.0) -> DataFrame:
    """Weighted mean, error and scatter of everything seen so far.

    The state is a handful of sums per key, kept by the built-in streaming aggregate: rows are
    summed on the map side first, so a key with a large share of the rows costs one row per task.
    """
    w = 1.0 / (F.col("flux_err") * F.col("flux_err"))
    d = F.col("flux") - num(around)
    s0, s1, s2 = F.sum(w), F.sum(w * d), F.sum(w * d * d)
    return stream.groupBy(*keys).agg(
        F.count("*").alias("n"), (s1 / s0 + around).alias("wmean"), F.sqrt(1.0 / s0).alias("werror"),
        F.sqrt(F.greatest(s2 / s0 - (s1 / s0) * (s1 / s0), num(0.0))).alias("wrms"),
    )


def enrich(stream: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """Stream rows with the columns of a static table, read again for every batch."""
    return stream.join(static, key)


def interval_pairs(first: DataFrame, second: DataFrame, key: str, minutes: int, delay: str) -> DataFrame:
    """Pairs of rows of two streams with the same key and times at most ``minutes`` apart.

    The time slot is part of the join key: the right rows are copied into the neighbouring slots,
    so the state of one busy key is spread over its slots.
    """
    seconds = minutes * 60

    def slot(ts: str):
        return F.floor(F.unix_seconds(ts) / seconds)

    left = first.select(*[F.col(c).alias(c + "1") for c in first.columns]).withWatermark("ts1", delay).withColumn("slot1", slot("ts1"))
    right = second.select(*[F.col(c).alias(c + "2") for c in second.columns]).withWatermark("ts2", delay)
    right = right.withColumn("slot2", F.explode(F.array(slot("ts2") - 1, slot("ts2"), slot("ts2") + 1)))
    near = F.expr(f"ts2 >= ts1 - INTERVAL {minutes} MINUTES AND ts2 <= ts1 + INTERVAL {minutes} MINUTES")
    return left.join(right, (F.col(key + "1") == F.col(key + "2")) & (F.col("slot1") == F.col("slot2")) & near).drop("slot1", "slot2")


def split_late(path: str, delay: str):
    """``foreachBatch`` function that routes rows older than the highest time of earlier batches minus a delay.

    On-time rows go to ``path/on_time``, late ones to ``path/late``; the highest time of each batch
    is one small row in ``path/high``, read without the batch itself so a retry decides the same.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        high = None
        if batch_id > 0:
            marks = spark.read.schema("high timestamp, batch_id bigint").option("basePath", f"{path}/high").parquet(f"{path}/high")
            high = marks.where(F.col("batch_id") < batch_id).agg(F.unix_micros(F.max("high")).alias("h")).first()["h"]
        limit = F.timestamp_micros(F.lit(high)) - F.expr(f"INTERVAL {delay}") if high is not None else None
        late = F.coalesce(F.col("ts") < limit, F.lit(False)) if limit is not None else F.lit(False)
        batch.where(~late).write.mode("overwrite").parquet(f"{path}/on_time/batch_id={batch_id}")
        batch.where(late).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        batch.agg(F.max("ts").alias("high")).write.mode("overwrite").parquet(f"{path}/high/batch_id={batch_id}")

    return handle
