"""Star selection, light curves and source properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions import phot as p
from skyloom.functions.common import num, quadrature
from skyloom.operators.match import cone, pairs_within
from skyloom.operators.skew import pick_first


def select_stars(
    stars: DataFrame, error_limits: dict[str, float], where: tuple[float, float, float] | None = None,
    parallax: tuple[float, float] | None = None, motion: tuple[float, float] | None = None,
) -> DataFrame:
    """AND of the cuts: errors per band and colour, cone, parallax and proper-motion ranges.

    A measured star has positive magnitudes; the last two cuts need a catalogue id.
    """
    keep: Column = F.lit(True)
    for name, limit in error_limits.items():
        for band in name:
            keep = keep & (F.col(band) > 0)
        err = F.col(name + "_err") if len(name) == 1 else quadrature(*[b + "_err" for b in name])
        keep = keep & (err <= limit)
    known = F.col("gaia_source_id") != "None"
    if parallax is not None:
        keep = keep & known & F.col("parallax").between(*parallax)
    if motion is not None:
        keep = keep & known & F.col("pm").between(*motion)
    out = stars.where(keep)
    return cone(out, *where, strict=True).drop("sep") if where is not None else out


def mark_selected(stars: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """1 for stars in the selection, else 0."""
    flag = selected.select(key).distinct().withColumn("selected", F.lit(1))
    return stars.join(flag, key, "left").withColumn("selected", F.coalesce("selected", F.lit(0)))


def usable(max_error: float, min_scale: float) -> Column:
    return (F.col("mag") > 0) & (F.col("mag_err") <= max_error) & (F.col("pscale") >= min_scale)


def extract_lightcurve(
    phot: DataFrame, stars: DataFrame, ra: float, dec: float, radius: float, neighbours: bool = False,
    max_error: float = 10.0, min_scale: float = 0.8,
) -> DataFrame:
    """Time series of the nearest star (or all stars) around a position, valid points only.

    The id of a single star is a scalar subquery, so that it reaches the scan of the photometry and
    the statistics of sorted files leave most of them unread.
    """
    near = cone(stars, ra, dec, radius).select("star_id", "sep")
    if not neighbours:
        best = near.agg(F.min_by(F.struct("star_id", "sep"), F.struct("sep", "star_id")).alias("b"))
        near = best.where("b is not null").select("b.star_id", "b.sep")
        phot = phot.where(F.col("star_id") == best.select("b.star_id").scalar())
    return phot.where(usable(max_error, min_scale)).join(near, "star_id")


def extract_many(phot: DataFrame, stars: DataFrame, targets: DataFrame, radius: float, target_id: str, max_error: float = 10.0, min_scale: float = 0.8) -> DataFrame:
    """The same for a list of targets in one pass over the photometry; the short list is copied to the cells, not the catalogue."""
    hits = pairs_within(stars, targets, radius).select(F.col(f"r.{target_id}").alias(target_id), F.col("l.star_id").alias("star_id"), "sep")
    nearest = pick_first(hits, [target_id], [F.col("sep"), F.col("star_id")])
    return phot.where(usable(max_error, min_scale)).join(nearest, "star_id")


def align_on_trios(trios: DataFrame, phot: DataFrame, keys: list[str]) -> DataFrame:
    """Measurements on the list of trio images with fluxes; null where an image is missing."""
    flux, err = p.mag_to_flux("mag", "mag_err", p.MODEL_ZP)
    out = trios.join(phot.select(*keys, "hjd", "mag", "mag_err"), keys, "left")
    return out.withColumn("flux", flux).withColumn("flux_err", err)


def source_lightcurve(lc: DataFrame, models: DataFrame, key: str) -> DataFrame:
    """Model source magnitude plus the change of the target from its baseline, errors in quadrature."""
    d = lc.join(models.select(key, "source_mag", "source_err", "base_mag", "base_err"), key)
    good = F.col("mag_err") > 0
    return d.select(
        *lc.columns, F.when(good, F.col("source_mag") + F.col("mag") - F.col("base_mag")).otherwise(num(99.99999)).alias("source_lc"),
        F.when(good, quadrature("mag_err", "base_err", "source_err")).otherwise(num(-9.9999)).alias("source_lc_err"),
    )
