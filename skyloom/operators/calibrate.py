"""Photometric calibration, normalization between datasets, offsets and line fits."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyloom.functions import phot as p, weights as w
from skyloom.functions.common import num, quadrature, ratio
from skyloom.operators import stats
from skyloom.operators.quantiles import aggregate_with_quantiles, grouped_quantiles
from skyloom.operators.skew import join_groups
from skyloom.session import stored

# fixed values: calibration limits per filter: brightest and faintest magnitude, largest catalogue error
LIMITS_GAIA = {
    "gp": (15.0, 21.0, 0.2), "rp": (15.0, 21.0, 0.07), "ip": (15.0, 21.0, 0.11),
    "V": (15.0, 21.0, 0.2), "R": (15.0, 21.0, 0.07), "I": (15.0, 21.0, 0.11),
}
LIMITS_SURVEY = LIMITS_GAIA | {"gp": (15.0, 21.0, 0.03), "rp": (15.0, 21.0, 0.03), "ip": (15.0, 21.0, 0.03)}


def calibration_limits(filter_code: str, use_gaia: bool, **given: float) -> dict[str, float]:
    """Limits of a filter with the given ones put over the defaults."""
    low, high, err = (LIMITS_GAIA if use_gaia else LIMITS_SURVEY)[filter_code]
    defaults = {"det_mags_min": low, "det_mags_max": high, "cat_merr_max": err}
    return defaults | {k: v for k, v in given.items() if v is not None and k in defaults}


def select_calibration_stars(stars: DataFrame, bands: list[str], identifier: str, faint: float = 22.0, max_err: float | None = None) -> DataFrame:
    """Stars with small errors in all bands, brighter than the limit, with clean photometry and a catalogue id.

    The error limit of a band is twice the median of its positive errors. Input has ``band``,
    ``band_err``, ``mag``, ``mag_err``.
    """
    keep = (F.col("mag") > 10.0) & (F.col("mag_err") > 0) & (F.col(identifier) != "None")
    d = stars
    if max_err is None:
        limits = aggregate_with_quantiles(
            stars.select(*[F.when(F.col(b + "_err") > 0, F.col(b + "_err")).alias(b) for b in bands]), [], [], {f"_l{b}": (b, [0.5]) for b in bands}
        )
        d = stats.attach_row(stars, limits)
    for b in bands:
        limit = 2.0 * F.col(f"_l{b}")[0] if max_err is None else num(max_err)
        keep = keep & (F.col(b + "_err") <= limit) & (F.col(b + "_err") > 0) & (F.col(b) < faint)
    return d.where(keep).select(*stars.columns)


def ridge_line(matches: DataFrame, x: str, y: str, low: float, high: float, bins: int = 24, floor: float = 0.05) -> DataFrame:
    """Points of the magnitude transformation: for every well filled cell of the 2-D histogram its column's modal y.

    Cells above ``floor`` of the peak count; a column with several such cells weighs several times.
    """
    cells = stats.histogram_2d(matches, x, y, bins)
    peak = cells.agg(F.max("n").alias("_peak"))
    full = stats.attach_row(cells, peak).where(F.col("n") > floor * F.col("_peak"))
    modal = full.groupBy("xbin").agg(
        F.min_by("ycentre", F.struct(-F.col("n"), F.col("ybin"))).alias("y"), F.max("xcentre").alias("x"), F.count("*").alias("weight")
    )
    return modal.where((F.col("x") >= low) & (F.col("x") < high)).select("x", "y", "weight")


def fit_line(points: DataFrame, keys: list[str], x: str, y: str, weight: str | None = None) -> DataFrame:
    """Total-least-squares line a·x + b per group in closed form, with the covariance of the fit.

    Unit errors on both axes. Covariance: residual variance times the inverse information matrix,
    with residuals measured across the line.
    """
    d = points.select(*keys, F.col(x).alias("_x"), F.col(y).alias("_y"), (F.col(weight) if weight else F.lit(1)).cast("double").alias("_w"))
    if not keys:
        d, keys = d.withColumn("_all", F.lit(1)), ["_all"]
    total = F.sum("_w")

    def mean(c: Column) -> Column:
        return ratio(F.sum(c * F.col("_w")), total)

    centre = d.groupBy(*keys).agg(total.alias("_n"), mean(F.col("_x")).alias("_mx"), mean(F.col("_y")).alias("_my"))
    dx, dy = F.col("_x") - F.col("_mx"), F.col("_y") - F.col("_my")
    second = d.join(centre, keys).groupBy(*keys).agg(
        F.max("_n").alias("_n"), F.max("_mx").alias("_mx"), F.max("_my").alias("_my"), mean(dx * dx).alias("_sxx"), mean(dy * dy).alias("_syy"), mean(dx * dy).alias("_sxy")
    )
    gap = F.col("_syy") - F.col("_sxx")
    slope = F.when(F.abs("_sxy") > num(1e-300), ratio(gap + F.sqrt(gap * gap + 4 * F.col("_sxy") * F.col("_sxy")), 2 * F.col("_sxy")))
    line = second.withColumn("a", slope).withColumn("b", F.col("_my") - F.col("a") * F.col("_mx"))
    # all moments of the residuals follow from the second moments
    variance = (F.col("_syy") - 2 * F.col("a") * F.col("_sxy") + F.col("a") * F.col("a") * F.col("_sxx")) * F.col("_n") / F.greatest(F.col("_n") - 2, num(1.0))
    spread = ratio(F.greatest(variance, num(0.0)), F.col("_n") * F.col("_sxx"))
    out = line.withColumn("c00", spread).withColumn("c01", -F.col("_mx") * spread).withColumn(
        "c11", ratio(F.greatest(variance, num(0.0)), F.col("_n")) + F.col("_mx") * F.col("_mx") * spread
    ).withColumn("scatter", F.sqrt(F.greatest(variance, num(0.0))))
    keep = [k for k in keys if k != "_all"]
    return out.select(*keep, F.col("_n").cast("bigint").alias("n_points"), "a", "b", "c00", "c01", "c11", "scatter")


def apply_calibration(phot: DataFrame, coefficients: DataFrame, keys: list[str], prefix: str = "cal") -> DataFrame:
    """Calibrated magnitude, error and flux of every row from the coefficients of its dataset."""
    d = phot.join(coefficients.select(*keys, "a", "b", "c00", "c01", "c11"), keys)
    mag, err = p.calibrate("mag", "mag_err", "a", "b", "c00", "c01", "c11")
    d = d.withColumn(f"{prefix}_mag", mag).withColumn(f"{prefix}_mag_err", err)
    flux, flux_err = p.mag_to_flux(f"{prefix}_mag", f"{prefix}_mag_err")
    return d.select(*phot.columns, f"{prefix}_mag", f"{prefix}_mag_err", flux.alias(f"{prefix}_flux"), flux_err.alias(f"{prefix}_flux_err"))


def constant_stars(phot: DataFrame, star: str = "star_id", fraction: float = 0.25) -> DataFrame:
    """Stars whose weighted RMS is in the lowest quarter of the RMS range."""
    rms = stats.valid_rows(phot).groupBy(star).agg(w.weighted_rms("mag", "mag_err").alias("rms"))
    span = rms.agg(F.min("rms").alias("_lo"), F.max("rms").alias("_hi"))
    return stats.attach_row(rms, span).where(F.col("rms") <= F.col("_lo") + (F.col("_hi") - F.col("_lo")) * fraction).select(star, "rms")


def dataset_means(phot: DataFrame) -> DataFrame:
    """Weighted mean, error, scatter and number per star and dataset."""
    return stats.valid_rows(phot).groupBy("star_id", "dataset", "filter", "site").agg(
        w.weighted_mean("mag", "mag_err").alias("mag"), w.weighted_error("mag_err").alias("mag_err"), w.weighted_rms("mag", "mag_err").alias("rms"), F.count("*").alias("n")
    )


def constant_among(means: DataFrame, site: str, band: str, fraction: float = 0.25) -> DataFrame:
    """As :func:`constant_stars` for one dataset, from the stored means of all of them."""
    rms = means.where((F.col("site") == site) & (F.col("filter") == band)).select("star_id", "rms")
    span = rms.agg(F.min("rms").alias("_lo"), F.max("rms").alias("_hi"))
    return stats.attach_row(rms, span).where(F.col("rms") <= F.col("_lo") + (F.col("_hi") - F.col("_lo")) * fraction).select("star_id", "rms")


def normalization_fits(means: DataFrame, constant: DataFrame, reference_site: str, max_err: float = 0.05, max_diff: float = 0.5) -> DataFrame:
    """Line of every dataset against the reference dataset of its filter, over constant stars, all at once."""
    steady = means.join(constant.select("star_id"), "star_id", "left_semi")
    ref = steady.where(F.col("site") == reference_site).select("star_id", "filter", F.col("mag").alias("ref_mag"), F.col("mag_err").alias("ref_err"))
    both = join_groups(steady.where(F.col("site") != reference_site), ref, ["star_id", "filter"])
    good = (F.col("mag_err") <= max_err) & (F.col("ref_err") <= max_err) & (F.abs(F.col("mag") - F.col("ref_mag")) <= max_diff)
    # the fit takes its moments in two steps: it reads the few steady stars, not the photometry
    return fit_line(stored(both.where(good).select("dataset", "mag", "ref_mag")), ["dataset"], "mag", "ref_mag")


def normalize(phot: DataFrame, fits: DataFrame, reference_site: str) -> DataFrame:
    """Normalized magnitudes; the reference dataset is copied and invalid rows become 0."""
    d = phot.join(fits.select("dataset", "a", "b", "c00", "c01", "c11"), "dataset", "left")
    mag, err = p.calibrate("mag", "mag_err", "a", "b", "c00", "c01", "c11")
    own = F.col("site") == reference_site
    ok = (F.col("mag") > 0) & (F.col("mag_err") > 0)
    return d.select(
        *phot.columns, F.when(ok, F.when(own, F.col("mag")).otherwise(mag)).otherwise(num(0.0)).alias("norm_mag"),
        F.when(ok, F.when(own, F.col("mag_err")).otherwise(err)).otherwise(num(0.0)).alias("norm_mag_err"),
    )


def time_bins(phot: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted mean per group in half-open one-day bins from the first whole day of the survey.

    The published index is shifted by one bin and drops the last half day; the bins here are the
    documented ones. The start is the exact minimum over all rows.
    """
    rows = stats.valid_rows(phot)
    start = rows.agg(F.floor(F.min("hjd")).alias("_start"))
    binned = stats.attach_row(rows, start).withColumn("bin", F.floor(F.col("hjd") - F.col("_start")))
    return binned.groupBy(*keys, "bin").agg(
        (F.max("_start") + F.col("bin") + 0.5).alias("centre"), w.weighted_mean("mag", "mag_err").alias("mag"), w.weighted_error("mag_err").alias("mag_err")
    )


def dataset_residuals(bins: DataFrame, references: list[str]) -> DataFrame:
    """Reference minus dataset in common bins for the references in order of preference.

    Every star and filter has one reference, the first of the list that saw it, so all references
    are one join. The bins are written once and read three times. Columns of ``bins``: star_id filter site bin mag mag_err.
    """
    keys = ["star_id", "filter"]
    table = stored(bins.select(*keys, "site", "bin", "mag", "mag_err"))
    rank = F.lit(None).cast("int")
    for n, site in reversed(list(enumerate(references))):
        rank = F.when(F.col("site") == site, n).otherwise(rank)
    first = table.groupBy(*keys).agg(F.min(rank).alias("_rank")).where("_rank is not null")
    first = first.select(*keys, F.element_at(F.array(*[F.lit(r) for r in references]), F.col("_rank") + 1).alias("reference"))
    placed = join_groups(table, first, keys)
    ref = placed.where(F.col("site") == F.col("reference")).select(*keys, "bin", F.col("mag").alias("_m"), F.col("mag_err").alias("_e"))
    both = join_groups(placed.where(~F.col("site").eqNullSafe(F.col("reference"))), ref, [*keys, "bin"])
    return both.select("reference", *keys, "site", "bin", (F.col("_m") - F.col("mag")).alias("delta"), quadrature("_e", "mag_err").alias("delta_err"))


def star_offsets(residuals: DataFrame, keys: list[str], threshold: float = 0.1, min_bins: int = 2) -> DataFrame:
    """Robust constant offset per group: median, then twice the mean of what lies within the threshold.

    Deterministic instead of a random consensus search. The error is the weighted mean deviation
    of the kept bins; groups with ``min_bins`` bins or fewer get 0 and 0.
    """
    # the residuals are read five times: write the short table instead of binning the photometry again
    rows = stored(residuals.select(*keys, "delta", "delta_err"))
    start = aggregate_with_quantiles(rows, keys, [F.count("*").alias("n_bins")], {"_q": ("delta", [0.5])})
    state = stored(start.select(*keys, "n_bins", F.col("_q")[0].alias("offset")))
    near = F.abs(F.col("delta") - F.col("offset")) <= threshold
    for _ in range(2):
        better = join_groups(rows, state, keys).where(near).groupBy(*keys).agg(F.avg("delta").alias("_better"))
        state = stored(join_groups(state, better, keys, "left").select(*keys, "n_bins", F.coalesce("_better", "offset").alias("offset")))
    kept = join_groups(rows, state, keys).where(near & (F.col("delta_err") > 0))
    spread = kept.groupBy(*keys).agg(w.weighted_mean(F.abs(F.col("delta") - F.col("offset")), "delta_err").alias("_spread"))
    enough = F.col("n_bins") > min_bins
    return join_groups(state, spread, keys, "left").select(
        *keys, "n_bins", F.when(enough, F.col("offset")).otherwise(num(0.0)).alias("delta_mag"),
        F.when(enough, F.coalesce("_spread", num(0.0))).otherwise(num(0.0)).alias("delta_mag_err"),
    )


def apply_offsets(phot: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    d = phot.join(offsets.select(*keys, "delta_mag", "delta_mag_err"), keys, "left")
    return d.select(
        *phot.columns, (F.col("mag") + F.coalesce("delta_mag", num(0.0))).alias("norm_mag"),
        quadrature("mag_err", F.coalesce("delta_mag_err", num(0.0))).alias("norm_mag_err"),
    )


def merge_offset(pairs: DataFrame, keys: list[str], rounds: int = 3) -> DataFrame:
    """Median difference, refined three times within ±5 hundredths of the whole range; error 1/n."""
    start = aggregate_with_quantiles(
        pairs, keys, [F.count("*").alias("n"), ((F.max("delta") - F.min("delta")) / 100.0).alias("width")], {"_q": ("delta", [0.5])}
    )
    state = stored(start.select(*keys, "n", "width", F.col("_q")[0].alias("offset")))
    for _ in range(rounds):
        inside = join_groups(pairs, state, keys).where(F.abs(F.col("delta") - F.col("offset")) <= 5.0 * F.col("width"))
        better = grouped_quantiles(inside, keys, "delta", [0.5], "_q").select(*keys, F.col("_q")[0].alias("_better"))
        state = stored(join_groups(state, better, keys, "left").select(*keys, "n", "width", F.coalesce("_better", "offset").alias("offset")))
    return state.select(*keys, "n", F.col("offset").alias("delta_mag"), (1.0 / F.col("n")).alias("delta_mag_err"))


def line_with_two_errors(points: DataFrame, keys: list[str], x: str, y: str, x_err: str, y_err: str, rounds: int = 40, tolerance: float = 1e-10) -> DataFrame:
    """Line with errors in both coordinates per group by the iteration of York.

    Each round is two aggregates over the points; what is carried along is one slope per group,
    so a group of any size is spread over all tasks. Groups whose slope no longer moves by more than
    ``tolerance`` of itself stay as they are and leave the rounds; ``converged`` is false for those
    that still move after ``rounds``. Points without a value are left out, and a slope that cannot be
    formed is null.
    """
    rows = points.select(*keys, F.col(x).alias("_x"), F.col(y).alias("_y"), F.col(x_err).alias("_sx"), F.col(y_err).alias("_sy"))
    rows = stored(rows.where(reduce(lambda p, c: p & F.col(c).isNotNull(), ["_y", "_sx", "_sy"], F.col("_x").isNotNull())))
    state = stored(rows.groupBy(*keys).agg(F.regr_slope("_y", "_x").alias("slope")))
    vx, vy = F.col("_sx") * F.col("_sx"), F.col("_sy") * F.col("_sy")
    weight = ratio(num(1.0), vy + F.col("slope") * F.col("slope") * vx)
    centre_cols = [w.centroid("_x", weight).alias("_mx"), w.centroid("_y", weight).alias("_my"), F.max("slope").alias("slope"), F.count("*").alias("n")]
    u, v = F.col("_x") - F.col("_mx"), F.col("_y") - F.col("_my")
    done = None
    for n in range(rounds):
        own = join_groups(rows, state, keys)
        centred = join_groups(own.drop("slope"), own.groupBy(*keys).agg(*centre_cols).drop("n"), keys)
        beta = weight * (u * vy + F.col("slope") * v * vx)
        step = centred.groupBy(*keys).agg(F.max("slope").alias("_old"), ratio(F.sum(weight * beta * v), F.sum(weight * beta * u)).alias("slope"))
        step = stored(step.withColumn("converged", F.coalesce(F.abs(F.col("slope") - F.col("_old")) <= tolerance * F.abs("slope"), F.col("slope").isNull())))
        still, last = step.where(~F.col("converged")), n == rounds - 1
        ended = (step if last else step.where("converged")).select(*keys, "slope", "converged")
        done = ended if done is None else done.unionByName(ended)
        state = still.select(*keys, "slope")
        if last or state.isEmpty():
            break
    state = stored(done)
    full = join_groups(rows, state, keys)
    centre = full.groupBy(*keys).agg(*centre_cols, F.every("converged").alias("converged"))
    adjusted = F.col("_mx") + weight * (u * vy + F.col("slope") * v * vx)
    inner = join_groups(rows, centre, keys).groupBy(*keys).agg(
        F.max("_mx").alias("_mx"), F.max("_my").alias("_my"), F.max("slope").alias("slope"), F.max("n").alias("n"), F.every("converged").alias("converged"),
        F.sum(weight).alias("_w"), w.centroid(adjusted, weight).alias("_ax"), F.sum(weight * adjusted * adjusted).alias("_axx"),
    )
    var_slope = ratio(num(1.0), F.col("_axx") - F.col("_w") * F.col("_ax") * F.col("_ax"))
    return inner.select(
        *keys, "n", "slope", (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"), F.sqrt(var_slope).alias("slope_err"),
        F.sqrt(ratio(num(1.0), F.col("_w")) + F.col("_ax") * F.col("_ax") * var_slope).alias("intercept_err"), "converged",
    )


def source_colour(fits: DataFrame) -> DataFrame:
    """Colour −2.5 log10(slope) with its relative error, blend flux = intercept; null for a negative slope."""
    ok = F.col("slope") > 0
    colour = F.when(ok, -2.5 * F.log10("slope"))
    return fits.select("*", colour.alias("colour"), F.when(ok, F.abs(ratio(F.col("slope_err"), F.col("slope")) * colour)).alias("colour_err"))


def plane_fit(pairs: DataFrame, keys: list[str], x: str, y: str, z: str) -> list[Column]:
    """Aggregates for z = a·x + b·y + c by least squares."""
    sxx, syy, sxy = F.var_pop(x), F.var_pop(y), F.covar_pop(x, y)
    sxz, syz = F.covar_pop(x, z), F.covar_pop(y, z)
    det = sxx * syy - sxy * sxy
    a, b = ratio(sxz * syy - syz * sxy, det), ratio(syz * sxx - sxz * sxy, det)
    return [a, b, F.avg(z) - a * F.avg(x) - b * F.avg(y)]


def affine_fit(pairs: DataFrame, keys: list[str], max_residual: float, rounds: int = 2) -> DataFrame:
    """Affine transform (x, y) → (u, v) per dataset from all pairs, outliers dropped and fitted again.

    Only sums leave the map side: every pair is used and nothing is drawn at random.
    """

    def measure(d: DataFrame) -> DataFrame:
        ax, bx, cx = plane_fit(d, keys, "x", "y", "u")
        ay, by, cy = plane_fit(d, keys, "x", "y", "v")
        return d.groupBy(*keys).agg(
            F.count("*").alias("n_pairs"), ax.alias("a11"), bx.alias("a12"), cx.alias("a13"), ay.alias("a21"), by.alias("a22"), cy.alias("a23")
        )

    fit = measure(pairs)
    for _ in range(rounds):
        du = F.col("a11") * F.col("x") + F.col("a12") * F.col("y") + F.col("a13") - F.col("u")
        dv = F.col("a21") * F.col("x") + F.col("a22") * F.col("y") + F.col("a23") - F.col("v")
        kept = pairs.join(fit, keys).where(F.sqrt(du * du + dv * dv) <= max_residual).select(*pairs.columns)
        fit = measure(kept)
    return fit


def polynomial_fit(points: DataFrame, keys: list[str], x: str, y: str, degree: int, x_centre: float) -> DataFrame:
    """Polynomial per group in powers of x - x_centre: power sums in Spark, then one batched solve of the small systems in a Pandas UDF.

    The sums are taken over the group's own middle and half width, and of y about its mean, so that they
    neither overflow nor cancel; the coefficients are turned back afterwards. A group with fewer
    different x than coefficients gets NaN. Points without x or y are left out.
    """
    known = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    span = known.groupBy(*keys).agg(
        ((F.max("_x") + F.min("_x")) / 2).alias("_mid"), F.when(F.max("_x") > F.min("_x"), (F.max("_x") - F.min("_x")) / 2).otherwise(num(1.0)).alias("_half"), F.avg("_y").alias("_level"), F.countDistinct("_x").alias("_places"))
    d = (F.col("_x") - F.col("_mid")) / F.col("_half")
    rest = F.col("_y") - F.col("_level")
    powers = [F.sum(F.pow(d, num(float(k)))).alias(f"_s{k}") for k in range(2 * degree + 1)]
    mixed = [F.sum(rest * F.pow(d, num(float(k)))).alias(f"_t{k}") for k in range(degree + 1)]
    kept = [F.max(c).alias(c) for c in ("_mid", "_half", "_level", "_places")]
    sums = join_groups(known, span, keys).groupBy(*keys).agg(F.count("*").alias("n"), *kept, *powers, *mixed)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        i = np.arange(degree + 1)
        for s, t, mid, half, level, places in batches:
            if len(s) == 0:
                yield pd.Series([], dtype=object)
                continue
            s_all, t_all = np.vstack(s.to_list()), np.vstack(t.to_list())
            matrix = s_all[:, i[:, None] + i[None, :]]
            ok = (places > degree).to_numpy()
            out = np.full(t_all.shape, np.nan)
            out[ok] = np.linalg.solve(matrix[ok], t_all[ok][..., None])[..., 0]
            out[:, 0] += level.to_numpy()
            # a polynomial in (x - mid) / half as one in x - x_centre
            yield pd.Series([np.polynomial.Polynomial(c)(np.polynomial.Polynomial([(x_centre - m) / h, 1 / h])).coef for c, m, h in zip(out, mid, half)])

    columns = [F.array(*[f"_s{k}" for k in range(2 * degree + 1)]), F.array(*[f"_t{k}" for k in range(degree + 1)]), "_mid", "_half", "_level", "_places"]
    return sums.select(*keys, "n", solve(*columns).alias("coefficients"))
