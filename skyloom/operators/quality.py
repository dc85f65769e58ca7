"""Image and datapoint quality control."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyloom.functions import sky
from skyloom.functions.common import num, quadrature, ratio
from skyloom.functions.phot import max_expected_error
from skyloom.operators import stats
from skyloom.operators.quantiles import aggregate_with_quantiles
from skyloom.operators.skew import join_groups
from skyloom.session import stored

# fixed values: quality flag codes of a datapoint
INVALID, BAD_IMAGE, LOW_SCALE, BAD_WARP, BAD_DIFFERENCE = 1, 2, 4, 8, 16


@dataclass(frozen=True)
class Limits:
    """Thresholds of the quality rules."""

    max_sigma: float = 2.0
    max_sky: float = 12000.0
    max_sky_reference: float = 5000.0
    pointing_deg: float = 5.0 / 60.0
    residual: float = 0.15
    scale_per_exposure: float = 0.7
    warp: float = 100.0
    difference_std: float = 1500.0


def null_invalid(df: DataFrame, columns: list[str], mag: str = "mag", err: str = "mag_err", qc: str | None = None) -> DataFrame:
    """Null instead of the sentinel where a measurement is not valid, so aggregates skip it."""
    ok = (F.col(mag) > 0) & (F.col(err) > 0)
    if qc:
        ok = ok & (F.col(qc) == 0)
    return df.select(*[F.when(ok, F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def pointing_ok(cat_ra, cat_dec, ra, dec, limit_deg: float) -> Column:
    """Requested against actual pointing in sexagesimal text; ``N/A`` means no fixed target and passes."""
    moving = F.col(cat_ra).contains("N/A") | F.col(cat_dec).contains("N/A")
    sep = sky.separation_deg(
        sky.sexagesimal_to_deg(cat_ra, True), sky.sexagesimal_to_deg(cat_dec), sky.sexagesimal_to_deg(ra, True), sky.sexagesimal_to_deg(dec)
    )
    return moving | F.coalesce(sep <= limit_deg, F.lit(False))


def assess_images(df: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Flags use_phot, use_ref, use_image and the joined list of reasons.

    Input columns: nstars sigma_x sigma_y sky pointing_ok. All reasons are listed; the published
    code keeps only the last one.
    """
    none = F.col("nstars") == 0
    wide = (F.col("sigma_x") > limits.max_sigma) | (F.col("sigma_y") > limits.max_sigma)
    negative = (F.col("sigma_x") < 0) | (F.col("sigma_y") < 0)
    bright, bright_ref = F.col("sky") > limits.max_sky, F.col("sky") > limits.max_sky_reference
    lost = ~F.col("pointing_ok")

    def flag(*bad: Column) -> Column:
        any_bad = bad[0]
        for b in bad[1:]:
            any_bad = any_bad | b
        return F.when(any_bad, 0).otherwise(1)

    reasons = [
        (none, "frame without stars"), (wide, "FWHM above its limit"), (negative, "FWHM below zero"),
        (bright, "Sky too bright for photometry"), (bright_ref, "Sky too bright for a reference"),
        (lost, "pointing off the target"),
    ]
    text = F.array_join(F.array_compact(F.array(*[F.when(c, r) for c, r in reasons])), ", ")
    return df.select(
        "*", flag(none, wide, negative, bright, lost).alias("use_phot"), flag(none, wide, negative, bright_ref, lost).alias("use_ref"),
        flag(none, negative, lost).alias("use_image"), F.when(text == "", "OK").otherwise(text).alias("report"),
    )


def shift_status(dx: str, dy: str, limit: float = 100.0) -> Column:
    """−1 where a shift is missing or at least the limit in either axis, else 0."""
    bad = F.col(dx).isNull() | F.col(dy).isNull() | (F.abs(F.col(dx)) >= limit) | (F.abs(F.col(dy)) >= limit)
    return F.when(bad, -1).otherwise(0)


def mask_statistics(pixels: DataFrame, keys: list[str], mask: str, max_percent: float = 2.0) -> DataFrame:
    bad = F.avg(F.when(F.col(mask) != 0, 100.0).otherwise(0.0))
    return pixels.groupBy(*keys).agg(bad.alias("percent_bad")).withColumn("passes", F.col("percent_bad") < max_percent)


def unknown_flags(df: DataFrame, column: str, allowed: list[int]) -> DataFrame:
    """Rows whose flag holds a value it may not have."""
    return df.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


def moon_class(fraction, distance) -> Column:
    fraction, distance = F.col(fraction), F.col(distance)
    return F.when(fraction < 0.4, "dark").when((fraction > 0.4) & (fraction < 0.7) & (distance > 60.0), "gray").otherwise("bright")


def reference_rank(images: DataFrame, group: list[str], image: str, n_best: int, pixel_scale: float, gain: float, read_noise: float) -> DataFrame:
    """Best reference candidates per dataset by the expected signal-to-noise of a star of magnitude 19.

    Input columns: nstars fwhm sky use_ref moon_fraction moon_distance exposure. Candidates have
    more than 34 stars, FWHM below 3 arcsec and no bright moon; a dataset without one falls back
    to stars per sky. The signal is rate × gain × exposure: the published code applies the
    magnitude scale twice.
    """
    # fixed values: electrons per second of a star of magnitude 0, target magnitude, aperture factor
    zero_rate, target, aperture = 1.47371235e9, 19.0, 0.67
    signal = num(zero_rate * 10.0 ** (-0.4 * target) * gain) * F.col("exposure")
    n_pixels = num(3.141592653589793 * pixel_scale) * (num(aperture) * F.col("fwhm")) * (num(aperture) * F.col("fwhm"))
    snr = ratio(signal, F.sqrt(signal + n_pixels * (F.col("sky") * gain + read_noise**2)))
    good = (
        (F.col("use_ref") == 1) & (F.col("nstars") > 34) & (F.col("fwhm") * pixel_scale < 3.0) & (moon_class("moon_fraction", "moon_distance") != "bright")
    )
    scored = images.select(
        *group, image, F.when(good, 0).otherwise(1).alias("tier"), F.when(good, snr).otherwise(ratio(F.col("nstars"), F.col("sky"))).alias("score")
    )
    # the group limit is pushed below the shuffle, so each task sends at most n_best rows per dataset
    order = Window.partitionBy(*group).orderBy("tier", F.col("score").desc(), image)
    top = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_best)
    first = Window.partitionBy(*group)
    return top.withColumn("_t", F.min("tier").over(first)).where((F.col("tier") == F.col("_t")) & ((F.col("tier") == 0) | (F.col("rank") == 1))).drop("_t")


def sort_with_defaults(images: DataFrame, metrics: DataFrame, image: str, columns: list[str], count: str) -> DataFrame:
    """Metrics for every image, −1 (and 0 stars) where an image has none."""
    fill = {c: -1.0 for c in columns} | {count: 0}
    return images.select(image).join(metrics.select(image, *columns, count), image, "left").na.fill(fill)


def scale_per_exposure(scale, exposure, reference_exposure) -> Column:
    """pscale × reference exposure / exposure; null where the scale is 0 (not measured) or the exposure is 0."""
    return F.when(F.col(scale) != 0, ratio(F.col(scale) * reference_exposure, F.col(exposure)))


def warp_outlier(array: str, limit: float) -> Column:
    return F.exists(F.col(array), lambda c: c > limit)


def bad_images_by_residual(phot: DataFrame, star: list[str], image: list[str], limit: float) -> DataFrame:
    """Images whose weighted mean residual is beyond the limit."""
    out = stats.image_residuals(stats.residuals(phot, star), image, None)
    return out.where(F.abs("mean_residual") > limit).select(*image)


def qc_bitmask(
    phot: DataFrame, images: DataFrame, bad_stamps: DataFrame, star_stamps: DataFrame, *, star: list[str], residual_image: list[str],
    reference_exposure: float, limits: Limits = Limits(),
) -> DataFrame:
    """Quality flag of every datapoint as the OR of the rule codes.

    ``images``: image_id exposure warp (array). ``bad_stamps``: image_id stamp_id of difference
    images beyond the scatter limit. ``star_stamps``: star_id stamp_id. Rules that hold for an
    image or an image and stamp are reduced to short lists of bad keys before they meet the
    datapoints, so the datapoints are joined with small tables only.
    """
    late = bad_images_by_residual(phot, star, residual_image, limits.residual).withColumn("_late", F.lit(BAD_IMAGE))
    image_side = images.select("image_id", "exposure", F.when(warp_outlier("warp", limits.warp), BAD_WARP).otherwise(0).alias("_warp"))
    stamp_side = bad_stamps.select("image_id", "stamp_id").distinct().withColumn("_diff", F.lit(BAD_DIFFERENCE))
    full = (
        phot.join(late, residual_image, "left")
        .join(image_side, "image_id", "left")
        .join(star_stamps.select("star_id", "stamp_id"), "star_id", "left")
        .join(stamp_side, ["image_id", "stamp_id"], "left")
    )
    invalid = F.when((F.col("mag") > 0) & (F.col("mag_err") > 0), 0).otherwise(INVALID)
    low = F.when(F.coalesce(scale_per_exposure("pscale", "exposure", reference_exposure), num(0.0)) < limits.scale_per_exposure, LOW_SCALE).otherwise(0)
    flag = invalid.bitwiseOR(low)
    for part in ("_late", "_warp", "_diff"):
        flag = flag.bitwiseOR(F.coalesce(part, F.lit(0)))
    return full.select(*phot.columns, flag.cast("int").alias("qc_flag"))


def correct_by_image(phot: DataFrame, image_stats: DataFrame, image: list[str]) -> DataFrame:
    """Magnitude minus the image's mean residual, its scatter added to the error."""
    joined = phot.join(image_stats.select(*image, "mean_residual", "rms"), image, "left")
    return joined.select(
        *phot.columns, (F.col("mag") - F.coalesce("mean_residual", num(0.0))).alias("corr_mag"),
        quadrature("mag_err", F.coalesce("rms", num(0.0))).alias("corr_mag_err"),
    )


def flag_large_errors(phot: DataFrame, star_stats: DataFrame, star: list[str]) -> DataFrame:
    """1 where the error is beyond the one expected at the star's mean magnitude."""
    joined = phot.join(star_stats.select(*star, "wmean"), star, "left")
    return joined.select(*phot.columns, F.when(F.col("mag_err") > max_expected_error("wmean"), 1).otherwise(0).alias("error_flag"))


def combine_masks(masks: list[Column]) -> Column:
    """Bits: the last mask gets bit 0, the one before it bit 1, and so on."""
    out = F.lit(0)
    for n, m in enumerate(reversed(masks)):
        out = out.bitwiseOR(F.when(m, 1 << n).otherwise(0))
    return out


def split_masks(code: str, count: int) -> list[Column]:
    return [F.getbit(F.col(code), F.lit(count - 1 - n)).cast("int") for n in range(count)]


def bad_pixels(pixels: DataFrame, keys: list[str], value: str, nsigma: float, rounds: int) -> DataFrame:
    """Pixels outside the clipped mean ± nsigma deviations of their image."""
    limits = stats.sigma_clip(pixels, keys, value, nsigma, rounds).drop("n")
    far = F.abs(F.col(value) - F.col("mean")) > nsigma * F.col("std")
    return join_groups(pixels, limits, keys).select(*pixels.columns, F.when(far, 1).otherwise(0).alias("bad"))


def level_quadrants(pixels: DataFrame, keys: list[str], value: str, middle_x: float, middle_y: float, margin: float = 0.0, nsigma: float = 3.0, rounds: int = 3) -> DataFrame:
    """Pixels with the gains of the four readout quadrants levelled, and the ``gain`` that each was multiplied by.

    Levels are clipped means of positive pixels. The right quadrant of each row of quadrants is put
    to the level of the left one, within ``margin`` rows of neither the bottom nor the top edge; then
    the upper half is put to the level of the lower one. A quadrant or half without a level keeps its gain.
    """
    right, upper = F.col("x") >= middle_x, F.col("y") >= middle_y
    rows = pixels.withColumn("_right", right.cast("int")).withColumn("_upper", upper.cast("int"))
    edge = rows.groupBy(*keys).agg(F.min("y").alias("_y0"), F.max("y").alias("_y1"))
    inner = join_groups(rows, edge, keys).where((F.col("y") >= F.col("_y0") + margin) & (F.col("y") <= F.col("_y1") - margin) & (F.col(value) > 0)) if margin else rows.where(F.col(value) > 0)
    level = stats.sigma_clip(inner.select(*keys, "_right", "_upper", value), [*keys, "_right", "_upper"], value, nsigma, rounds)
    pick = lambda side: F.max(F.when(F.col("_right") == side, F.col("mean")))
    gains = stored(level.groupBy(*keys, "_upper").agg(F.coalesce(ratio(pick(0), pick(1)), num(1.0)).alias("_gain")))
    first = join_groups(rows, gains, [*keys, "_upper"], "left")
    first = first.withColumn("gain", F.when(F.col("_right") == 1, F.coalesce("_gain", num(1.0))).otherwise(num(1.0)))
    put = first.select(*keys, "_upper", (F.col(value) * F.col("gain")).alias("_put")).where("_put > 0")
    half = stats.sigma_clip(put, [*keys, "_upper"], "_put", nsigma, rounds)
    side = lambda up: F.max(F.when(F.col("_upper") == up, F.col("mean")))
    lift = half.groupBy(*keys).agg(F.coalesce(ratio(side(0), side(1)), num(1.0)).alias("_lift"))
    full = join_groups(first, lift, keys, "left")
    gain = F.col("gain") * F.when(F.col("_upper") == 1, F.coalesce("_lift", num(1.0))).otherwise(num(1.0))
    return full.withColumn("gain", gain).select(*[(F.col(c) * F.col("gain")).alias(c) if c == value else F.col(c) for c in pixels.columns], "gain")


def overscan_rows(pixels: DataFrame, image: str, row: str, bad: str) -> DataFrame:
    """Rows of an image whose median mask value is 1."""
    out = aggregate_with_quantiles(pixels, [image, row], [], {"_q": (bad, [0.5])})
    return out.where(F.col("_q")[0] == 1).select(image, row)
