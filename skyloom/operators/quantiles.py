"""Exact quantiles per group, also for groups too large for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyloom.operators.skew import hot_groups, hot_limit, join_groups
from skyloom.session import cut_lineage

BINS = 4096
FINAL_ROWS = 100_000  # rows of a bin that are sorted rather than divided again
BROADCAST_BOXES = 100_000


def _value(column: str) -> Column:
    """The value as double; NaN is missing, as null is, on every path."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def aggregate_with_quantiles(
    df: DataFrame,
    keys: list[str],
    aggregates: list[Column],
    quantiles: dict[str, tuple[str, list[float]]],
) -> DataFrame:
    """Group by ``keys`` with ordinary aggregates plus exact linear-interpolated quantiles.

    ``quantiles`` maps an output column (an array) to (value column, probabilities). While no
    group is hot this is one hash aggregate. Hot groups are counted first; their quantiles come
    from :func:`hot_quantiles`, which narrows a histogram instead of collecting the group.
    """
    spark = df.sparkSession
    limit = hot_limit(spark)
    plain = [
        F.percentile(_value(c), F.array(*[F.lit(float(p)) for p in probs])).alias(name)
        for name, (c, probs) in quantiles.items()
    ]
    if not keys:
        keyed = df.withColumn("_all", F.lit(1))
        out = aggregate_with_quantiles(keyed, ["_all"], aggregates, quantiles)
        return out.drop("_all")
    hot = hot_groups(df, keys, limit)
    if hot.isEmpty():
        return df.groupBy(*keys).agg(*aggregates, *plain)
    hot = cut_lineage(hot)
    # at most rows/limit keys; a shuffle by these keys would sort a hot group in one task
    few = F.broadcast(hot)
    cold = join_groups(df, few, keys, "left_anti").groupBy(*keys).agg(*aggregates, *plain)
    rows = join_groups(df, few, keys, "left_semi")
    parts = [rows.groupBy(*keys).agg(*aggregates)] if aggregates else [hot]
    parts += [hot_quantiles(rows, keys, c, probs, name) for name, (c, probs) in quantiles.items()]
    warm = reduce(lambda a, b: join_groups(a, b, keys, "left"), parts)
    return cold.unionByName(warm)


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], name: str = "q") -> DataFrame:
    return aggregate_with_quantiles(df, keys, [], {name: (value, probs)})


def hot_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], name: str) -> DataFrame:
    """Exact quantiles by repeated histograms.

    Each level counts rows per (key, bin), finds the bin of every wanted rank by a running sum
    over at most ``BINS`` rows and keeps only rows of those bins, until every wanted bin holds at
    most ``FINAL_ROWS`` rows or a single value. What is left is counted per distinct value.
    """
    rows = df.select(*keys, _value(value).alias("_v")).where(F.col("_v").isNotNull())
    span = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = span.select(
        *keys, "_n", "_lo", "_hi", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_pos", "_p")
    )
    place = F.col("_p") * (F.col("_n") - 1)
    ends = F.array(F.floor(place), F.ceil(place))
    targets = wanted.select(*keys, "_lo", "_hi", "_pos", place.alias("_at"), F.explode(ends).alias("_rank")).select(
        *keys, "_lo", "_hi", "_pos", "_at", F.col("_rank").alias("_target"), F.col("_rank")
    )
    targets = cut_lineage(targets)
    # a box for each hot group and probability: sent to the tasks unless there are very many hot groups
    send = F.broadcast if targets.count() <= BROADCAST_BOXES else lambda x: x
    while True:
        box = [*keys, "_lo", "_hi"]
        boxes = targets.select(*box).distinct()
        width = (F.col("_hi") - F.col("_lo")) / BINS
        bin_no = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(BINS - 1))).otherwise(0)
        inside = (
            join_groups(rows, send(boxes), keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).withColumn("_bin", bin_no)
        )
        counts = inside.groupBy(*box, "_bin").agg(
            F.count("*").alias("_c"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi")
        )
        before = Window.partitionBy(*box).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_below", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        targets = cut_lineage(
            join_groups(targets, counts, box)
            .where((F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_c")))
            .select(
                *keys, F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"), "_pos", "_at", "_target",
                (F.col("_rank") - F.col("_below")).alias("_rank"), "_c",
            )
        )
        wide = targets.where((F.col("_c") > FINAL_ROWS) & (F.col("_lo") < F.col("_hi")))
        targets = targets.drop("_c")
        if wide.isEmpty():
            break
    box = [*keys, "_lo", "_hi"]
    boxes = targets.select(*box).distinct()
    distinct_values = (
        join_groups(rows, send(boxes), keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        .groupBy(*box, "_v").agg(F.count("*").alias("_c"))
    )
    upto = Window.partitionBy(*box).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = distinct_values.withColumn("_upto", F.sum("_c").over(upto))
    hits = (
        join_groups(targets, ranked, box)
        .where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_c")))
        .groupBy(*keys, "_pos", "_at")
        .agg(F.min_by("_v", "_target").alias("_a"), F.max_by("_v", "_target").alias("_b"))
    )
    part = F.col("_at") - F.floor("_at")
    point = hits.select(*keys, "_pos", ((1 - part) * F.col("_a") + part * F.col("_b")).alias("_q"))
    # at most one row per wanted probability
    listed = point.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_pos", "_q"))).alias("_l"))
    return listed.select(*keys, F.transform("_l", lambda e: e["_q"]).alias(name))
