"""Grouping tools that hold when one key owns a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.session import cut_lineage

# Rows one task may hold for one key before the key is treated as hot.
HOT_GROUP_ROWS = 4_000_000
HOT_CONF = "skyloom.hotGroupRows"
# Rows of a table with one row for each group that may be sent to the tasks.
BROADCAST_GROUPS = 100_000


def hot_limit(spark: SparkSession, default: int = HOT_GROUP_ROWS) -> int:
    return int(spark.conf.get(HOT_CONF, str(default)))


def hot_groups(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows. At most rows/limit keys, so the table is small by construction."""
    return df.groupBy(*keys).count().where(F.col("count") > limit).drop("count")


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null, so that the group without a key is kept like any other."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def attach_groups(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """:func:`join_groups` with a table of one row for each group, worked out once.

    It is counted and, unless there are very many groups, sent to the tasks: a shuffle by a few keys would
    sort all rows of a group in one task. AQE does not broadcast a side whose few rows leave most
    partitions empty, so this is written out.
    """
    groups = cut_lineage(groups)
    few = groups.count() <= BROADCAST_GROUPS
    return join_groups(rows, F.broadcast(groups) if few else groups, keys, how)


def by_shuffle(df: DataFrame) -> DataFrame:
    """Side of an equi-join that is shuffled and merged, never sent whole to the driver and the tasks.

    Catalyst takes the size of a side from compressed files and does not count the copies that ``explode``
    makes, so it may broadcast many times what it believes to be below its threshold.
    """
    return df.hint("merge")


def pick_first(df: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """Row with the smallest ``order`` per key.

    An aggregate instead of a window: every map task reduces its part of a group to one row
    before the shuffle, so the size of a group does not matter.
    """
    values = columns if columns is not None else [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*values), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in values])


def pick_last(df: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """Row with the largest ``order`` per key; see :func:`pick_first`."""
    values = columns if columns is not None else [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*values), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in values])
