"""Proximity joins on the sky and in the image plane.

Spark has no range-join strategy, so both sides get a cell key and the join is a plain
equi-join on cells: the smaller side is copied into the neighbouring cells, and the exact
distance is the residual predicate.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions import sky
from skyloom.operators.skew import by_shuffle, join_groups, pick_first
from skyloom.session import cut_lineage

# Copies of the smaller side one cell may hold before the cell is split.
HOT_CELL_ROWS = 20_000
CELL_CONF = "skyloom.hotCellRows"


@dataclass(frozen=True)
class Metric:
    """Two coordinates, a distance and the cells that belong to a radius.

    ``keys`` name columns of both sides, such as the image of a pixel position, that partners have
    in common. They are part of every cell, so images neither meet in a join nor add up to a hot
    cell; rows whose key is null belong together like those of any other key.
    """

    a: str
    b: str
    spherical: bool
    keys: tuple[str, ...] = ()

    @property
    def cell(self) -> list[str]:
        return ["_zone", "_cell", *(["_group"] if self.keys else [])]

    def _grouped(self, df: DataFrame) -> DataFrame:
        # equal structs may hold nulls, equal columns may not
        return df.withColumn("_group", F.struct(*self.keys)) if self.keys else df

    def own_keys(self, side: str) -> list[Column]:
        """The keys of one side of a pair, under names that clash with nothing."""
        return [F.col(f"{side}.{k}").alias(f"_key{i}") for i, k in enumerate(self.keys)]

    @property
    def key_names(self) -> list[str]:
        return [f"_key{i}" for i in range(len(self.keys))]

    def distance(self, left: str, right: str) -> Column:
        la, lb, ra, rb = F.col(f"{left}.{self.a}"), F.col(f"{left}.{self.b}"), F.col(f"{right}.{self.a}"), F.col(f"{right}.{self.b}")
        if self.spherical:
            return sky.separation_deg(la, lb, ra, rb)
        return F.sqrt((la - ra) * (la - ra) + (lb - rb) * (lb - rb))

    def home(self, df: DataFrame, radius: float) -> DataFrame:
        if self.spherical:
            zone = sky.zone_of(F.col(self.b), radius)
            cell = sky.ra_cell(F.col(self.a), sky.ra_cells_in_zone(zone, radius))
        else:
            zone, cell = F.floor(F.col(self.b) / radius), F.floor(F.col(self.a) / radius)
        return self._grouped(df).select("*", zone.alias("_zone"), cell.alias("_cell"))

    def spread(self, df: DataFrame, radius: float) -> DataFrame:
        """One copy per cell that a point within ``radius`` could be in."""
        steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
        if self.spherical:
            own = sky.zone_of(F.col(self.b), radius)
        else:
            own = F.floor(F.col(self.b) / radius)
        zoned = self._grouped(df).select("*", F.explode(F.transform(steps, lambda s: own + s)).alias("_zone"))
        if self.spherical:
            cells = sky.ra_cells_in_zone(F.col("_zone"), radius)
            cell = sky.ra_cell(F.col(self.a), cells)
            near = F.array_distinct(F.transform(steps, lambda s: F.pmod(cell + s, cells)))
        else:
            near = F.transform(steps, lambda s: F.floor(F.col(self.a) / radius) + s)
        return zoned.select("*", F.explode(near).alias("_cell"))


SKY = Metric("ra", "dec", True)
PIXEL = Metric("x", "y", False)


def pixels_of(*keys: str) -> Metric:
    """Pixel positions that belong to the image (or any other keys) of their row."""
    return Metric("x", "y", False, keys)


def _cell_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CELL_CONF, str(HOT_CELL_ROWS)))


def _may_be_crowded(df: DataFrame, metric: Metric, radius: float, limit: int) -> bool:
    """Cheap test for hot cells: counts in cells 64 times as wide.

    The copies in one cell come from a block that touches at most four wide cells, so if no wide
    cell holds a quarter of the limit no cell can be hot. Wide cells are few, so the count
    combines before the shuffle, which a count per narrow cell would not.
    """
    wide = metric.home(df.select(metric.a, metric.b, *metric.keys), 64 * radius).groupBy(*metric.cell).agg(F.count("*").alias("_n"))
    return not wide.where(F.col("_n") > limit / 4).isEmpty()


def _within(pairs: DataFrame, metric: Metric, radius: float, strict: bool) -> DataFrame:
    near = F.abs(F.col(f"l.{metric.b}") - F.col(f"r.{metric.b}")) <= radius
    sep = pairs.where(near).withColumn("sep", metric.distance("l", "r"))
    return sep.where((F.col("sep") < radius) if strict else (F.col("sep") <= radius))


def pairs_within(
    left: DataFrame, right: DataFrame, radius: float, metric: Metric = SKY, strict: bool = False
) -> DataFrame:
    """All pairs within ``radius`` as structs ``l`` and ``r`` plus ``sep``.

    Put the smaller side on the right; the sides meet by a shuffle of cells, whatever their files
    weigh, because the copies are many times the rows. Cells that hold very many copies get the left rows salted
    and the right copies repeated per salt, so that one cell is shared out over many tasks.
    """
    l = metric.home(left, radius)
    r = metric.spread(right, radius)
    limit, cell = _cell_limit(left), metric.cell
    ls = l.select(F.struct(*left.columns).alias("l"), *cell)
    rs = r.select(F.struct(*right.columns).alias("r"), *cell)
    load = l.groupBy(*cell).agg(F.count("*").alias("_load")).where(F.col("_load") > limit)
    if not _may_be_crowded(left, metric, radius, limit) or load.isEmpty():
        return _within(ls.join(by_shuffle(rs), cell).select("l", "r"), metric, radius, strict)
    salts = cut_lineage(load.select(*cell, F.ceil(F.col("_load") / limit).cast("int").alias("_salts")))
    ls = ls.join(salts, cell, "left").withColumn(
        "_salt", F.pmod(F.xxhash64("l"), F.coalesce("_salts", F.lit(1))).cast("int")
    )
    rs = rs.join(salts, cell, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    joined = ls.drop("_salts").join(by_shuffle(rs.drop("_salts")), [*cell, "_salt"]).select("l", "r")
    return _within(joined, metric, radius, strict)


def _closest(pairs: DataFrame, left_id: str, right_id: str, metric: Metric) -> DataFrame:
    flat = pairs.select(*metric.own_keys("l"), F.col(f"l.{left_id}").alias("_lid"), F.col(f"r.{right_id}").alias("_rid"), "l", "r", "sep")
    best = pick_first(flat, [*metric.key_names, "_lid"], [F.col("sep"), F.col("_rid")], ["l", "r", "sep"])
    return best.select("l", "r", "sep")


def nearest_within(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    left_id: str,
    right_id: str,
    metric: Metric = SKY,
    strict: bool = True,
    copy: str = "right",
) -> DataFrame:
    """The nearest right row of every left row (ties: smallest id), as ``l``, ``r``, ``sep``.

    ``copy`` names the side that is copied into the neighbouring cells: the smaller one.

    Left rows in crowded cells go through finer cells first: a match found at a small radius is
    the nearest one, so only rows without one need the next larger radius. Right rows at one and
    the same position are reduced to the smallest id there, which is the one a tie selects.
    """
    limit, cell = _cell_limit(left), metric.cell
    crowded = (
        metric.spread(right, radius).groupBy(*cell).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
        .drop("_n")
    )
    if not _may_be_crowded(right, metric, radius, limit) or crowded.isEmpty():
        if copy == "left":
            pairs = pairs_within(right, left, radius, metric, strict).select(F.col("r").alias("l"), F.col("l").alias("r"), "sep")
        else:
            pairs = pairs_within(left, right, radius, metric, strict)
        return _closest(pairs, left_id, right_id, metric)
    crowded = cut_lineage(crowded)
    homed = metric.home(left, radius)
    calm = homed.join(crowded, cell, "left_anti").drop(*cell)
    found = [_closest(pairs_within(calm, right, radius, metric, strict), left_id, right_id, metric)]
    todo = cut_lineage(homed.join(crowded, cell, "left_semi").drop(*cell))
    single = cut_lineage(
        pick_first(right, [*metric.keys, metric.a, metric.b], [F.col(right_id)]).select(*right.columns)
    )
    for shrink in (256, 16, 1):
        last = shrink == 1
        pairs = pairs_within(todo, single, radius / shrink, metric, strict if last else False)
        hit = cut_lineage(_closest(pairs, left_id, right_id, metric))
        found.append(hit)
        if not last:
            done = hit.select(*[F.col(f"l.{c}").alias(c) for c in [*metric.keys, left_id]])
            todo = cut_lineage(join_groups(todo, done, [*metric.keys, left_id], "left_anti").select(*left.columns))
    return reduce(DataFrame.unionByName, found)


def match_one_to_one(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    left_id: str,
    right_id: str,
    metric: Metric = SKY,
    strict: bool = True,
    copy: str = "right",
) -> DataFrame:
    """Nearest match, and of several left rows that chose the same right row the closest keeps it."""
    nearest = nearest_within(left, right, radius, left_id, right_id, metric, strict, copy)
    flat = nearest.select(*metric.own_keys("r"), F.col(f"r.{right_id}").alias("_rid"), F.col(f"l.{left_id}").alias("_lid"), "l", "r", "sep")
    return pick_first(flat, [*metric.key_names, "_rid"], [F.col("sep"), F.col("_lid")], ["l", "r", "sep"]).select("l", "r", "sep")


def cone(df: DataFrame, ra0: float, dec0: float, radius: float, strict: bool = False, zone_height: float | None = None) -> DataFrame:
    """Rows within ``radius`` degrees of one position with their separation.

    The declination band and the RA range of the circle, cut at 0 = 360 and open at the poles, are
    plain comparisons that reach the scan, as does the zone of a catalogue stored in zones; the
    distance is computed only for rows inside them.
    """
    out = sky.cone_cover(ra0, dec0, radius).of(df, zone_height).withColumn("sep", sky.separation_deg(F.col("ra"), F.col("dec"), ra0, dec0))
    return out.where((F.col("sep") < radius) if strict else (F.col("sep") <= radius))


def box(df: DataFrame, ra_min: float, ra_max: float, dec_min: float, dec_max: float, zone_height: float | None = None) -> DataFrame:
    """Rows in a box of the sky, which may lie across RA 0 (``ra_min`` above ``ra_max``)."""
    return sky.box_cover(ra_min, ra_max, dec_min, dec_max).of(df, zone_height)
