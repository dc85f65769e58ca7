"""Small fixed tables, coordinate models, noise model and SQL-visible functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyloom.functions.common import as_column, num, polynomial
from skyloom.functions.stellar import GIANT_COLOURS, GIANT_VI

GIANT_TABLE = [{"vi": vi, "vk": vk} for vi, vk in zip(GIANT_VI, GIANT_COLOURS["V-K"])]


def nearest_table_row(x, table: list[dict[str, float]]) -> dict[str, Column]:
    """Row of a fixed table whose first column is nearest to ``x`` (first row on ties), as expressions."""
    x = as_column(x)
    key, *_ = table[0]
    rows = [
        F.struct(F.abs(x - num(r[key])).alias("gap"), F.lit(n).alias("n"), *[num(v).alias(c) for c, v in r.items()])
        for n, r in enumerate(table)
    ]
    best = F.array_min(F.array(*rows))
    return {c: best[c] for c in table[0]}


def rescaling_table(spark: SparkSession, factors: dict[str, tuple[float, float]]) -> DataFrame:
    """Error factors per telescope: one row per telescope, so always small."""
    schema = T.StructType(
        [T.StructField("telescope", T.StringType()), T.StructField("a0", T.DoubleType()), T.StructField("a1", T.DoubleType())]
    )
    return spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in factors.items()], schema)


def affine(x, y, matrix: list[list[float]]) -> tuple[Column, Column]:
    x, y = as_column(x), as_column(y)
    return tuple(num(a) * x + num(b) * y + num(c) for a, b, c in matrix)


def cubic_without_cross_terms(x, y, px: list[float], py: list[float]) -> tuple[Column, Column]:
    """Seven parameters per axis: constant, three powers of x, three powers of y."""

    def one(p: list[float]) -> Column:
        return polynomial(x, p[:4]) + polynomial(y, [0.0, *p[4:]])

    return one(px), one(py)


def noise_model(
    frames: DataFrame, mag_start: float, mag_step: float, n_mags: int, *, zero_point: float, gain: float,
    read_noise: float, aperture_diameter: float, telescope_diameter_m: float, height_m: float,
) -> DataFrame:
    """Expected scatter for a grid of magnitudes from columns ``sky airmass exposure`` of all frames.

    Every term is a factor of the magnitude times a sum over frames, so the frames are read once
    and only the summary row is spread over the grid.
    """
    scale_height = 8000.0
    pixels = math.pi * (aperture_diameter / 2.0) ** 2
    scint = (
        num(0.09 * (telescope_diameter_m * 100.0) ** -0.67 * math.exp(-height_m / scale_height))
        * F.pow("airmass", num(1.5)) * F.pow(2.0 * F.col("exposure"), num(-0.5))
    )
    total = frames.agg(
        F.count("*").alias("n"), F.sum(1.0 / F.col("sky")).alias("inv_sky"), F.avg(1.0 / (scint * scint)).alias("inv_scint")
    )
    grid = total.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_mags - 1))).alias("k"))
    mag = num(mag_start) + F.col("k") * num(mag_step)
    grid = grid.withColumn("mag", mag).withColumn("flux", F.pow(num(10.0), (F.col("mag") - zero_point) / -2.5) * gain)
    per_mag = num(2.5 * math.log10(math.e)) / F.col("flux")
    return grid.select(
        "mag",
        (num(math.sqrt(read_noise**2 * pixels)) * per_mag / F.sqrt("n")).alias("read_noise"),
        (num(math.sqrt(gain * pixels)) * per_mag / F.sqrt("inv_sky")).alias("sky_noise"),
        (F.sqrt("flux") * per_mag / F.sqrt("n")).alias("star_noise"),
        (1.0 / F.sqrt("inv_scint")).alias("scint_noise"),
    ).withColumn(
        "total_noise",
        F.sqrt(sum((F.col(c) * F.col(c) for c in ("sky_noise", "star_noise", "scint_noise")), F.col("read_noise") * F.col("read_noise"))),
    )


def register_sql_functions(spark: SparkSession) -> None:
    """Functions for SQL text; they are SQL bodies, so the optimizer sees through them."""
    bodies = {
        "mag_to_flux(m DOUBLE)": "pow(10e0, (m - 25e0) / -2.5e0)",
        "flux_to_mag(f DOUBLE)": "CASE WHEN f > 0 THEN 25e0 - 2.5e0 * log10(f) ELSE 0e0 END",
        "sky_separation(ra1 DOUBLE, dec1 DOUBLE, ra2 DOUBLE, dec2 DOUBLE)": (
            "degrees(2 * asin(least(1e0, sqrt(pow(sin(radians(dec2 - dec1) / 2), 2) + "
            "cos(radians(dec1)) * cos(radians(dec2)) * pow(sin(radians(ra2 - ra1) / 2), 2)))))"
        ),
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS DOUBLE RETURN {body}")
