"""Bracket join: every row with the neighbouring rows of an ordered table, and interpolation between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyloom.functions.common import ratio
from skyloom.operators.ordering import with_following, with_row_index
from skyloom.session import stored


def bracket_join(rows: DataFrame, table: DataFrame, x: str, knot: str, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows with ``lower`` and ``upper``: structs of ``knot`` and ``values`` of the table rows around ``x``.

    ``lower`` is the last knot at or below x among the knots of the same ``keys``, ``upper`` the one
    that follows it; either is null where there is none, and both are null for a null or NaN x. Of
    several table rows with one knot the last by values counts. Null keys belong together.

    The table is of any size. Both sides are ordered together by ranges of x, so the rows
    of a frequent x lie in several partitions; in each the last knot is carried forward, and the last
    knot of earlier partitions, one row for each partition, is carried over.
    """
    keys = keys or []
    names = [knot, *values]
    clean = table.where(F.col(knot).isNotNull() & ~F.isnan(F.col(knot).cast("double")))
    single = clean.groupBy(*keys, knot).agg(F.max(F.struct(*values)).alias("_v")).select(*keys, knot, "_v.*")
    led = with_following(with_row_index(single, [*keys, knot]), [*keys, *names], 1)
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(k + "1"))
    here = F.struct(*names)
    after = F.when(same & F.col(knot + "1").isNotNull(), F.struct(*[F.col(c + "1").alias(c) for c in names]))
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.lit(0).alias("k"))
    knots = led.select(group.alias("_g"), F.col(knot).cast("double").alias("_x"), F.lit(0).alias("_kind"), F.struct(here.alias("lower"), after.alias("upper")).alias("_at"))
    place = F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double"))
    asked = rows.select(group.alias("_g"), place.alias("_x"), F.lit(1).alias("_kind"), F.struct(*rows.columns).alias("_row"))
    both = knots.unionByName(asked, allowMissingColumns=True).withColumn("_spread", F.xxhash64("_row"))
    # a knot comes before the rows at its place
    order = ["_g", "_x", "_kind", "_spread"]
    placed = stored(both.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    known = F.struct("_g", "_at")
    ends = placed.where("_kind = 0").groupBy("_part").agg(F.max_by(known, F.struct("_g", "_x")).alias("_last"))
    parts = placed.select("_part").distinct().join(ends, "_part", "left")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_part", F.last("_last", ignorenulls=True).over(before).alias("_earlier"))
    upto = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = placed.withColumn("_own", F.last(F.when(F.col("_kind") == 0, known), ignorenulls=True).over(upto)).where("_kind = 1")
    # one row for each partition
    found = filled.join(F.broadcast(carried), "_part").withColumn("_use", F.coalesce("_own", "_earlier"))
    at = F.when(F.col("_x").isNotNull() & (F.col("_use._g") == F.col("_g")), F.col("_use._at"))
    return found.select("_row.*", at["lower"].alias("lower"), at["upper"].alias("upper"))


def between(value: str, x, knot: str) -> Column:
    """Linear interpolation of a column of the table at x; the knot's own value on a knot, null outside the table."""
    x = F.col(x) if isinstance(x, str) else x
    low, high = F.col(f"lower.{knot}"), F.col(f"upper.{knot}")
    share = ratio(x - low, high - low)
    return F.when(x == low, F.col(f"lower.{value}")).when(F.col("upper").isNotNull(), F.col(f"lower.{value}") + share * (F.col(f"upper.{value}") - F.col(f"lower.{value}")))
