"""Field catalogue: match datasets one after the other, quadrants, stamps, remapping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyloom.functions.common import as_column, num, ratio
from skyloom.operators.match import SKY, match_one_to_one, nearest_within, pairs_within, pixels_of
from skyloom.operators.ordering import with_group_index, with_row_index
from skyloom.operators.quantiles import grouped_quantiles
from skyloom.operators.skew import by_shuffle, join_groups, pick_first
from skyloom.operators.stats import attach_row
from skyloom.session import scratch_path, stored
from skyloom.sources.versions import Spec, TableSet


FIELD_ZONE = 0.5
FIELD_TABLES = {
    "stars": Spec("field_id bigint, ra double, dec double, zone int", parts=("zone",), number="field_id"),
    "members": Spec("field_id bigint, dataset string, dataset_star_id bigint, separation double"),
}


@dataclass
class FieldIndex:
    """``stars``: field_id, ra, dec. ``members``: field_id, dataset, dataset_star_id, separation.

    The index only grows: each dataset adds one folder of new field stars, in declination zones,
    and one of members, and both appear with one manifest. What a dataset costs depends on the dataset
    and on the field stars in the zones it touches, not on what earlier datasets wrote; adding a
    dataset again changes nothing.
    """

    tables: TableSet

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FieldIndex:
        return cls(TableSet(spark, path, FIELD_TABLES))

    @classmethod
    def start(cls, primary: DataFrame, code: str, path: str | None = None) -> FieldIndex:
        """The primary dataset's own star ids become the field ids."""
        index = cls.open(primary.sparkSession, path or scratch_path(primary.sparkSession, "field-index"))
        stars = primary.select(F.col("star_id").alias("field_id"), "ra", "dec", cls._zone())
        members = primary.select(
            F.col("star_id").alias("field_id"), F.lit(code).alias("dataset"), F.col("star_id").alias("dataset_star_id"), num(0.0).alias("separation")
        )
        index.tables.commit(code, {"stars": stars, "members": members})
        return index

    @staticmethod
    def _zone(shift: float = 0.0) -> Column:
        return F.floor((F.col("dec") + (90.0 + shift)) / FIELD_ZONE).cast("int").alias("zone")

    @property
    def stars(self) -> DataFrame:
        return self.tables.read("stars").drop("zone")

    @property
    def members(self) -> DataFrame:
        return self.tables.read("members")

    def add_dataset(self, stars: DataFrame, code: str, radius: float) -> FieldIndex:
        """Matched stars join their field star; the others become new field stars.

        New ids go on after the highest id in dataset order, so the order of datasets is part of
        the result.
        """
        if self.tables.done(code):
            return self
        # a zone number for each half degree of the sky at most
        near = stars.select(F.explode(F.sequence(self._zone(-radius), self._zone(radius))).alias("zone")).distinct()
        zones = [r["zone"] for r in near.where("zone is not null").collect()]
        field = self.tables.read("stars").where(F.col("zone").isin(zones)).select("field_id", "ra", "dec")
        pairs = match_one_to_one(stars.select("star_id", "ra", "dec"), field, radius, "star_id", "field_id", copy="left")
        matched = stored(
            pairs.select(F.col("r.field_id").alias("field_id"), F.col("l.star_id").alias("dataset_star_id"), F.col("sep").alias("separation"))
        )
        orphans = stars.join(by_shuffle(matched.select(F.col("dataset_star_id").alias("star_id"))), "star_id", "left_anti")
        numbered = self.tables.numbered("stars", orphans.select("star_id", "ra", "dec"), ["star_id"])
        new = matched.select("field_id", "dataset_star_id", "separation").unionByName(
            numbered.select("field_id", F.col("star_id").alias("dataset_star_id"), F.lit(-1.0).alias("separation"))
        ).withColumn("dataset", F.lit(code))
        self.tables.commit(code, {"stars": numbered.select("field_id", "ra", "dec", self._zone()), "members": new})
        return self


def attach_catalogue(field: DataFrame, catalogue: DataFrame, columns: list[str], radius: float, field_id: str, source_id: str) -> DataFrame:
    """Every field star with the columns of its catalogue partner, null where there is none."""
    pairs = match_one_to_one(catalogue, field, radius, source_id, field_id)
    found = pairs.select(
        F.col(f"r.{field_id}").alias(field_id), F.col(f"l.{source_id}").alias(source_id), *[F.col(f"l.{c}").alias(c) for c in columns], "sep"
    )
    return field.join(by_shuffle(found), field_id, "left")


def match_by_identifier(dataset: DataFrame, primary: DataFrame, identifier: str, missing: str = "None") -> DataFrame:
    """Pairs with the same catalogue id where it is known and occurs once in the dataset."""
    once = (
        dataset.where(F.col(identifier) != missing).groupBy(identifier)
        .agg(F.count("*").alias("_n"), F.min(F.struct("star_id", "ra", "dec")).alias("l"))
        .where("_n = 1")
    )
    other = primary.where(F.col(identifier) != missing).select(identifier, F.struct("star_id", "ra", "dec").alias("r"))
    return once.join(other, identifier).select(identifier, "l", "r").withColumn("sep", SKY.distance("l", "r"))


def two_pass_match(left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str) -> DataFrame:
    """One-to-one match, then a second round among those left over on both sides."""
    first = stored(
        match_one_to_one(left, right, radius, left_id, right_id)
        .select(F.col(f"l.{left_id}").alias(left_id), F.col(f"r.{right_id}").alias("_rid"), "sep", F.lit(1).alias("round"))
    )
    rest_left = stored(left.join(by_shuffle(first.select(left_id)), left_id, "left_anti").select(*left.columns))
    rest_right = stored(
        right.join(by_shuffle(first.select(F.col("_rid").alias(right_id))), right_id, "left_anti").select(*right.columns)
    )
    second = match_one_to_one(rest_left, rest_right, radius, left_id, right_id).select(
        F.col(f"l.{left_id}").alias(left_id), F.col(f"r.{right_id}").alias("_rid"), "sep", F.lit(2).alias("round")
    )
    return first.unionByName(second).select(F.col(left_id).alias("left_id"), F.col("_rid").alias("right_id"), "sep", "round")


def brightest_within(
    detections: DataFrame, reference: DataFrame, radius: float, det_id: str, ref_id: str, flux: str = "flux", keys: tuple[str, ...] = (),
) -> DataFrame:
    """Brightest reference star near each detection of the same image (``keys``); a reference star goes to its first detection."""
    metric = pixels_of(*keys)
    pairs = pairs_within(detections, reference, radius, metric, strict=True).select(
        *[F.col(f"l.{k}").alias(k) for k in keys], F.col(f"l.{det_id}").alias("det_id"), F.col(f"r.{ref_id}").alias("ref_id"), F.col(f"r.{flux}").alias("ref_flux"), "sep"
    )
    choice = pick_first(pairs, [*keys, "det_id"], [-F.col("ref_flux"), F.col("ref_id")])
    return pick_first(choice, [*keys, "ref_id"], [F.col("det_id")])


def nearest_to(stars: DataFrame, positions: DataFrame, keys: list[str], star_id: str) -> DataFrame:
    """Star nearest to the wanted place (x0, y0) of every image: one aggregate, ties to the smallest id.

    ``positions`` holds one row per image; an image without stars does not appear.
    """
    dx, dy = F.col("x") - F.col("x0"), F.col("y") - F.col("y0")
    placed = join_groups(stars, positions.select(*keys, "x0", "y0"), keys).withColumn("sep", F.sqrt(dx * dx + dy * dy))
    return pick_first(placed.where(F.col("sep").isNotNull() & ~F.isnan("sep")), keys, [F.col("sep"), F.col(star_id)], [star_id, "x", "y", "sep"])


def assign_quadrants(field: DataFrame) -> DataFrame:
    """Quadrant 1–4 by the middle of the RA and Dec ranges and a running id within it.

    A star exactly on a middle line belongs to the later quadrant, as the last assignment wins in
    the definition; ids are counted without gaps.
    """
    span = field.agg(F.min("ra").alias("a0"), F.max("ra").alias("a1"), F.min("dec").alias("d0"), F.max("dec").alias("d1"))
    mid_ra = F.col("a0") + (F.col("a1") - F.col("a0")) / 2
    mid_dec = F.col("d0") + (F.col("d1") - F.col("d0")) / 2
    west, east = F.col("ra") <= mid_ra, F.col("ra") >= mid_ra
    low, high = F.col("dec") <= mid_dec, F.col("dec") >= mid_dec
    quadrant = F.when(west & high, 4).when(east & high, 3).when(east & low, 2).otherwise(1)
    placed = attach_row(field, span).withColumn("quadrant", quadrant).select(*field.columns, "quadrant")
    out = with_group_index(placed, ["quadrant"], ["field_id"])
    return out.select(*field.columns, "quadrant", (F.col("idx") + 1).alias("quadrant_id"))


def stamp_array(width, height, size_x: int, size_y: int, overlap: int) -> Column:
    """Sub-images of an image as an array of structs: number and pixel bounds.

    Centres lie on a regular grid; the overlap is cut at the edges and the last row and column
    reach the far edge. An image with a side below twice the stamp size is one stamp.
    """
    width, height = as_column(width).cast("int"), as_column(height).cast("int")
    hx, hy = size_x // 2, size_y // 2

    def centres(full: Column, half: int, size: int) -> Column:
        return F.sequence(F.lit(half), F.greatest(full - 1, F.lit(half)), F.lit(size))

    cx, cy = centres(width, hx, size_x), centres(height, hy, size_y)
    nx, ny = F.size(cx), F.size(cy)

    def stamp(i: Column, j: Column) -> Column:
        x, y = F.element_at(cx, j + 1), F.element_at(cy, i + 1)
        return F.struct(
            (i * nx + j).alias("stamp_id"),
            F.greatest(x - hx - overlap, F.lit(0)).alias("x_min"),
            F.when(j == nx - 1, width).otherwise(F.least(x + hx + overlap, width)).alias("x_max"),
            F.greatest(y - hy - overlap, F.lit(0)).alias("y_min"),
            F.when(i == ny - 1, height).otherwise(F.least(y + hy + overlap, height)).alias("y_max"),
        )

    rows = F.sequence(F.lit(0), ny - 1)
    cols = F.sequence(F.lit(0), nx - 1)
    grid = F.flatten(F.transform(rows, lambda i: F.transform(cols, lambda j: stamp(i, j))))
    whole = F.array(F.struct(
        F.lit(0).alias("stamp_id"), F.lit(0).alias("x_min"), width.alias("x_max"), F.lit(0).alias("y_min"), height.alias("y_max")
    ))
    return F.when((height < 2 * size_y) | (width < 2 * size_x), whole).otherwise(grid)


def assign_stamps(stars: DataFrame, stamps: DataFrame, cell: int = 256, keys: tuple[str, ...] = ()) -> DataFrame:
    """Every star with its stamp (half-open bounds); in an overlap the last stamp wins, off all stamps it is null.

    The stamps of an image (``keys``) are listed once for each coarse cell they touch, a few in
    each, so the stars meet them in one equi-join that keeps every row: equal detections stay
    apart, and stars beyond the stamps or without a position stay too.
    """
    span = lambda low, high: F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))
    cells = stamps.select("*", F.explode(span("x_min", "x_max")).alias("_cx")).select("*", F.explode(span("y_min", "y_max")).alias("_cy"))
    bounds = F.struct("stamp_id", "x_min", "x_max", "y_min", "y_max")
    listed = cells.groupBy(F.struct(*keys, "_cx", "_cy").alias("_place")).agg(F.collect_list(bounds).alias("_stamps"))
    place = F.struct(*keys, F.floor(F.col("x") / cell).alias("_cx"), F.floor(F.col("y") / cell).alias("_cy"))
    x, y = F.col("x"), F.col("y")
    inside = F.filter("_stamps", lambda s: (x >= s["x_min"]) & (x < s["x_max"]) & (y >= s["y_min"]) & (y < s["y_max"]))
    last = F.array_max(F.transform(inside, lambda s: s["stamp_id"]))
    return stars.withColumn("_place", place).join(listed, "_place", "left").select(*stars.columns, last.alias("stamp_id"))


def crowding_filter(
    stars: DataFrame, star_id: str, radius: float, flux_ratio: float, edge_percent: float = 10.0, max_stars: int | None = None, flux: str = "flux",
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Stars without a close companion in their image (``keys``) and away from its edge; with ``max_stars`` that many, faintest first.

    A star falls out if its flux is at least ``flux_ratio`` times that of a neighbour: the ratio is
    star over neighbour as defined, although the text describes the opposite. A neighbour without
    flux has no ratio and disturbs nobody. The edge is a percentile of the positions in the image.
    """
    pairs = pairs_within(stars, stars, radius, pixels_of(*keys), strict=True)
    crowded = pairs.where(
        (F.col(f"l.{star_id}") != F.col(f"r.{star_id}")) & (ratio(F.col(f"l.{flux}"), F.col(f"r.{flux}")) >= flux_ratio)
    ).select(*[F.col(f"l.{k}").alias(k) for k in keys], F.col(f"l.{star_id}").alias(star_id)).distinct()
    p = edge_percent / 100.0
    groups = list(keys) or ["_all"]
    keyed = stars if keys else stars.withColumn("_all", F.lit(1))
    bounds = join_groups(grouped_quantiles(keyed, groups, "x", [p, 1 - p], "_qx"), grouped_quantiles(keyed, groups, "y", [p, 1 - p], "_qy"), groups)
    inner = (
        (F.col("x") > F.col("_qx")[0]) & (F.col("x") < F.col("_qx")[1]) & (F.col("y") > F.col("_qy")[0]) & (F.col("y") < F.col("_qy")[1])
    )
    calm = join_groups(keyed, crowded, [*keys, star_id], "left_anti")
    kept = join_groups(calm, bounds, groups).where(inner).select(*stars.columns)
    if max_stars is None:
        return kept
    order = [F.col(flux).asc(), F.col(star_id)]
    if not keys:
        return kept.orderBy(*order).limit(max_stars)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return kept.withColumn("_rank", rank).where(F.col("_rank") <= max_stars).drop("_rank")


def isolation_filter(detections: DataFrame, image: str, det_id: str, radius: float, before: int, after: int, size: float, edge: float) -> DataFrame:
    """Isolated bright detections per image.

    The ``before`` brightest of each image are looked at; one with a fainter-ranked detection within
    ``radius`` in both axes falls out; the ``after`` brightest that are away from the edge remain.
    """
    rank = Window.partitionBy(image).orderBy(F.col("flux").desc(), F.col(det_id))
    bright = stored(detections.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= before))
    # at most ``before`` rows per image on both sides of this join
    later = bright.select(image, F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("rank").alias("_rank"))
    disturbed = bright.join(later, image).where(
        (F.col("_rank") > F.col("rank")) & (F.abs(F.col("_x") - F.col("x")) < radius) & (F.abs(F.col("_y") - F.col("y")) < radius)
    ).select(image, det_id).distinct()
    inside = F.col("x").between(edge, size - edge) & F.col("y").between(edge, size - edge)
    left = bright.join(disturbed, [image, det_id], "left_anti").where(inside)
    return left.drop("rank").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= after)


def remap_to_field(phot: DataFrame, star_map: DataFrame, image_map: DataFrame) -> DataFrame:
    """Dataset photometry under field star and field image ids; unknown stars and images fall out.

    The map of stars is as large as the catalogue and joins by shuffle when it must; the map of
    images is small and Catalyst may broadcast it by its size.
    """
    return (
        phot.join(star_map.select("dataset", F.col("dataset_star_id").alias("star_id"), "field_id", "quadrant", "quadrant_id"), ["dataset", "star_id"])
        .join(image_map.select("dataset", "image_id", "field_image_id"), ["dataset", "image_id"])
    )


def translate_ids(rows: DataFrame, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Ids of the other catalogue, −1 where there is none; a mapping with repeated source ids is an error row count."""
    unique = pick_first(mapping.select(source, target), [source], [F.col(target)])
    return rows.join(by_shuffle(unique), source, "left").withColumn(target, F.coalesce(F.col(target), F.lit(-1)))


def repeated_ids(mapping: DataFrame, source: str) -> DataFrame:
    return mapping.groupBy(source).agg(F.count("*").alias("n")).where("n > 1")


def combine_bands(spine: DataFrame, others: dict[str, DataFrame], radius: float) -> DataFrame:
    """Spine catalogue with the nearest star of each other band attached.

    With duplicates the nearest wins; the published loop ends up with the widest pair.
    """
    out = spine
    for band, cat in others.items():
        near = nearest_within(spine, cat, radius, "star_id", "star_id", SKY, strict=False)
        out = out.join(
            near.select(F.col("l.star_id").alias("star_id"), F.col("r.star_id").alias(f"{band}_id"), F.col("r.mag").alias(f"{band}_mag"), F.col("sep").alias(f"{band}_sep")),
            "star_id", "left",
        )
    return out
