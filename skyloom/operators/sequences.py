"""Image trios, rank slices, samples, central region and isochrone matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyloom.functions.common import num
from skyloom.operators.match import Metric, nearest_within, pairs_within
from skyloom.operators.ordering import with_following, with_row_index
from skyloom.operators.quantiles import aggregate_with_quantiles
from skyloom.operators.skew import join_groups
from skyloom.operators.stats import attach_row
from skyloom.session import stored


def image_trios(images: DataFrame, max_fwhm: float, max_sky: float) -> DataFrame:
    """Three images in a row by name: same date, numbers n, n+1, n+2, three filters, all good.

    Names are ``telescope-camera-date-number-…``; the two following rows are found by row number;
    a name without date and number belongs to no trio.
    """
    parts = F.split("name", "-")
    good = (F.col("fwhm_x") <= max_fwhm) & (F.col("fwhm_y") <= max_fwhm) & (F.col("sky") <= max_sky)
    clean = ~F.isnan("fwhm_x") & ~F.isnan("fwhm_y") & ~F.isnan("sky")
    base = images.select(
        "name", "filter", F.get(parts, F.lit(2)).try_cast("bigint").alias("date"), F.get(parts, F.lit(3)).try_cast("bigint").alias("number"), F.coalesce(good & clean, F.lit(False)).alias("good")
    )
    cols = ["name", "filter", "date", "number", "good"]
    rows = with_following(with_row_index(base, ["name"]), cols, 2)
    trio = (
        (F.col("date") == F.col("date1")) & (F.col("date") == F.col("date2"))
        & (F.col("number1") == F.col("number") + 1) & (F.col("number2") == F.col("number") + 2)
        & (F.col("filter") != F.col("filter1")) & (F.col("filter") != F.col("filter2")) & (F.col("filter1") != F.col("filter2"))
        & F.col("good") & F.col("good1") & F.col("good2")
    )

    def named(letter: str) -> Column:
        return F.when(F.col("filter").contains(letter), F.col("name")).when(F.col("filter1").contains(letter), F.col("name1")).otherwise(F.col("name2"))

    return rows.where(trio).select(*[named(f).alias(f"{f}_image") for f in "gri"])


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group with their rank from 1; the limit also holds before the shuffle, so no group is gathered whole."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("long"))


def rank_slice(df: DataFrame, order: list, low: float, high: float) -> DataFrame:
    """Rows whose rank is in [low·n, high·n); the rank is a distributed row number."""
    indexed = with_row_index(df, order)
    sized = attach_row(indexed, indexed.agg(F.count("*").alias("_n")))
    return sized.where((F.col("idx") >= F.floor(F.col("_n") * num(low))) & (F.col("idx") < F.floor(F.col("_n") * num(high)))).drop("_n")


def hash_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """``size`` rows in the order of a seeded hash of the key: random, and the same in every run."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col(key).cast("string"))), key).limit(size)


def central_region(stars: DataFrame, half_widths: list[float], fewest: int, most: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Stars of the smallest central box with a wanted number of stars, per image (``keys``); all boxes are counted in one pass.

    Where no box holds ``fewest`` to ``most`` stars it is the one that misses this range by the
    fewest stars, the smaller box of equal ones.
    """
    groups = list(keys) or ["_all"]
    keyed = stars if keys else stars.withColumn("_all", F.lit(1))
    centre = keyed.groupBy(*groups).agg(F.avg("x").alias("_cx"), F.avg("y").alias("_cy"))
    placed = join_groups(keyed, centre, groups).withColumn("_reach", F.greatest(F.abs(F.col("x") - F.col("_cx")), F.abs(F.col("y") - F.col("_cy"))))
    counts = placed.groupBy(*groups).agg(F.array(*[F.count_if(F.col("_reach") <= h) for h in half_widths]).alias("_c"))
    missed = F.transform("_c", lambda n, k: F.struct(F.greatest(F.lit(fewest) - n, n - F.lit(most), F.lit(0)).alias("miss"), (k + 1).alias("box")))
    chosen = counts.select(*groups, F.array_min(missed)["box"].alias("box"))
    widths = F.array(*[F.lit(float(h)) for h in half_widths])
    out = join_groups(placed, chosen, groups).where(F.col("_reach") <= F.try_element_at(widths, F.col("box")))
    return out.select(*stars.columns, "box")


def nearest_isochrone(targets: DataFrame, rows: DataFrame, target_id: str, tolerance: float, min_age: float | None = None, min_teff_err: float = 50.0) -> DataFrame:
    """Median and half inter-quartile range of mass, temperature and log g of the nearest isochrone rows.

    Rows within ``tolerance`` of the smallest colour distance count. Equal target colours are
    looked up once. The smallest distance is searched by cells of growing size, so no target
    meets the whole table; targets without both colours come back with null results; then one radius join at that distance plus the tolerance finds the rows.
    """
    plane = Metric("gr", "ri", False)
    if min_age is not None:
        rows = rows.where(F.col("age") > min_age)
    numbered = stored(rows.withColumn("row_id", F.xxhash64(*rows.columns)).withColumn("teff", F.pow(num(10.0), "log_teff")))
    known = targets.where(~F.isnan("gr") & ~F.isnan("ri"))
    colours = stored(known.select("gr", "ri").where("gr is not null and ri is not null").distinct().withColumn("colour_id", F.struct("gr", "ri")))
    # rows of one colour are equally far from any target: one of them stands for all in the search for the smallest distance
    places = stored(numbered.groupBy("gr", "ri").agg(F.min("row_id").alias("row_id")))
    todo, found, radius = colours, None, 4 * tolerance
    while not todo.isEmpty():
        best = nearest_within(todo, places, radius, "colour_id", "row_id", plane, strict=False).select(
            F.col("l.colour_id").alias("colour_id"), F.col("sep").alias("closest")
        )
        near = stored(best)
        reach = stored(
            pairs_within(todo.join(near, "colour_id", "left_semi"), numbered, radius + tolerance, plane)
            .select(F.col("l.colour_id").alias("colour_id"), "r.mass", "r.teff", "r.logg", "sep")
            .join(near, "colour_id").where(F.col("sep") <= F.col("closest") + tolerance)
        )
        found = reach if found is None else found.unionByName(reach)
        todo = stored(todo.join(near, "colour_id", "left_anti").select(*colours.columns))
        radius *= 4
        if radius > 1e3:
            raise ValueError("targets without any isochrone row")
    probs = [0.25, 0.5, 0.75]
    out = aggregate_with_quantiles(
        found, ["colour_id"], [F.count("*").alias("n")], {"_m": ("mass", probs), "_t": ("teff", probs), "_g": ("logg", probs)}
    ).join(colours, "colour_id")

    def half(c: str) -> Column:
        return (F.col(c)[2] - F.col(c)[0]) / 2

    stats = out.select(
        "gr", "ri", "n", F.col("_m")[1].alias("mass"), half("_m").alias("mass_err"), F.col("_t")[1].alias("teff"),
        F.greatest(half("_t"), num(min_teff_err)).alias("teff_err"), F.col("_g")[1].alias("logg"), half("_g").alias("logg_err"),
    )
    return targets.join(stats, ["gr", "ri"], "left")
