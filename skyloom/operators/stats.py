"""Grouped statistics of light curves and images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions import weights as w
from skyloom.functions.common import as_column, num, ratio
from skyloom.operators.ordering import with_following, with_group_index, with_row_index
from skyloom.operators.quantiles import aggregate_with_quantiles, grouped_quantiles
from skyloom.operators.skew import attach_groups, join_groups
from skyloom.session import cut_lineage

# (magnitude, error) column names per photometry kind
PHOT_COLUMNS = {
    "instrumental": ("mag", "mag_err"),
    "calibrated": ("cal_mag", "cal_mag_err"),
    "corrected": ("corr_mag", "corr_mag_err"),
    "normalized": ("norm_mag", "norm_mag_err"),
}


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Columns of a one-row table on every row, as a scalar subquery instead of a join."""
    row = one_row.select(F.struct(*one_row.columns)).scalar()
    tagged = df.withColumn("_row", row)
    return tagged.select(*df.columns, *[F.col(f"_row.{c}").alias(c) for c in one_row.columns])


def valid_rows(df: DataFrame, mag: str = "mag", err: str = "mag_err", qc: str | None = None) -> DataFrame:
    """Measurements with positive magnitude and error and, if given, a clean quality flag."""
    keep = (F.col(mag) > 0) & (F.col(err) > 0)
    return df.where(keep & (F.col(qc) == 0) if qc else keep)


def star_statistics(df: DataFrame, keys: list[str], kind: str = "instrumental", qc: str | None = None) -> DataFrame:
    """Weighted mean, its error, weighted RMS and percentile RMS per group of valid rows."""
    mag, err = PHOT_COLUMNS[kind]
    out = aggregate_with_quantiles(
        valid_rows(df, mag, err, qc),
        keys,
        [
            F.count("*").alias("n"),
            w.weighted_mean(mag, err).alias("wmean"),
            w.weighted_error(err).alias("werror"),
            w.weighted_rms(mag, err).alias("wrms"),
        ],
        {"_p": (mag, [0.16, 0.84])},
    )
    return out.select(*keys, "n", "wmean", "werror", "wrms", ((F.col("_p")[1] - F.col("_p")[0]) / 2).alias("prms"))


def residuals(df: DataFrame, keys: list[str], mag: str = "mag", err: str = "mag_err") -> DataFrame:
    """Magnitude minus the group's weighted mean, with both errors in quadrature."""
    good = valid_rows(df, mag, err)
    means = good.groupBy(*keys).agg(w.weighted_mean(mag, err).alias("_m"), w.weighted_error(err).alias("_e"))
    return (
        join_groups(good, means, keys)
        .withColumn("residual", F.col(mag) - F.col("_m"))
        .withColumn("residual_err", F.sqrt(F.col(err) * F.col(err) + F.col("_e") * F.col("_e")))
        .drop("_m", "_e")
    )


def image_residuals(res: DataFrame, keys: list[str], time: str | None = "hjd") -> DataFrame:
    """Weighted mean residual per image, scatter about that mean, and mean time if there is a time column."""
    return res.groupBy(*keys).agg(
        F.count("*").alias("n"),
        w.weighted_mean("residual", "residual_err").alias("mean_residual"),
        w.weighted_rms("residual", "residual_err", 0.0).alias("rms"),
        w.weighted_error("residual_err").alias("std_error"),
        *([F.avg(time).alias("mean_time")] if time else []),
    )


def sigma_clip(df: DataFrame, keys: list[str], value: str, nsigma: float, rounds: int) -> DataFrame:
    """Mean and population deviation after ``rounds`` of keeping values within nsigma of the last mean."""
    measures = [F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count("*").alias("n")]
    stats = df.groupBy(*keys).agg(*measures)
    for _ in range(rounds):
        inside = attach_groups(df, stats.drop("n"), keys).where(F.abs(F.col(value) - F.col("mean")) <= nsigma * F.col("std"))
        stats = inside.groupBy(*keys).agg(*measures)
    return stats


def median_mad(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median and median absolute deviation per group."""
    med = grouped_quantiles(df, keys, value, [0.5], "_q").select(*keys, F.col("_q")[0].alias("median"))
    med = cut_lineage(med)
    dev = attach_groups(df, med, keys).withColumn("_dev", F.abs(F.col(value) - F.col("median")))
    mad = grouped_quantiles(dev, keys, "_dev", [0.5], "_q").select(*keys, F.col("_q")[0].alias("mad"))
    return join_groups(med, mad, keys)


def centre_and_spread(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median, half inter-quartile range, mean and half range."""
    out = aggregate_with_quantiles(
        df, keys, [F.avg(value).alias("mean"), ((F.max(value) - F.min(value)) / 2).alias("half_range")],
        {"_q": (value, [0.25, 0.5, 0.75])},
    )
    return out.select(
        *keys, F.col("_q")[1].alias("median"), ((F.col("_q")[2] - F.col("_q")[0]) / 2).alias("half_iqr"), "mean", "half_range"
    )


def bin_number(value, low, high, bins: int) -> Column:
    """0-based bin of equal width; the upper edge belongs to the last bin."""
    value, low, high = as_column(value), as_column(low), as_column(high)
    raw = F.floor((value - low) / ((high - low) / bins))
    return F.when(high > low, F.least(raw, F.lit(bins - 1))).otherwise(F.lit(0)).cast("bigint")


def histogram_2d(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Counts in bins × bins cells over the whole range, with cell centres."""
    span = df.agg(F.min(x).alias("xlo"), F.max(x).alias("xhi"), F.min(y).alias("ylo"), F.max(y).alias("yhi"))
    cells = attach_row(df, span).select(
        bin_number(x, "xlo", "xhi", bins).alias("xbin"), bin_number(y, "ylo", "yhi", bins).alias("ybin"),
        "xlo", "xhi", "ylo", "yhi",
    )
    counted = cells.groupBy("xbin", "ybin", "xlo", "xhi", "ylo", "yhi").agg(F.count("*").alias("n"))
    return counted.select(
        "xbin", "ybin", "n",
        (F.col("xlo") + (F.col("xbin") + 0.5) * (F.col("xhi") - F.col("xlo")) / bins).alias("xcentre"),
        (F.col("ylo") + (F.col("ybin") + 0.5) * (F.col("yhi") - F.col("ylo")) / bins).alias("ycentre"),
    )


def background_peak(df: DataFrame, keys: list[str], value: str, bins: int = 100) -> DataFrame:
    """Lower edge of the fullest histogram bin among values up to twice the median, per group."""
    med = grouped_quantiles(df, keys, value, [0.5], "_q").select(*keys, F.col("_q")[0].alias("median"))
    low = attach_groups(df, med, keys).where(F.col(value) <= 2 * F.col("median"))
    span = low.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    binned = attach_groups(low.select(*keys, value), span, keys).withColumn("_bin", bin_number(value, "lo", "hi", bins))
    counts = binned.groupBy(*keys, "_bin", "lo", "hi").agg(F.count("*").alias("_n"))
    edge = F.col("lo") + F.col("_bin") * (F.col("hi") - F.col("lo")) / bins
    top = F.min_by(F.struct(edge.alias("edge"), "_n"), F.struct(-F.col("_n"), F.col("_bin")))
    return counts.groupBy(*keys).agg(top.alias("_t")).select(
        *keys, F.col("_t.edge").alias("background"), F.col("_t._n").alias("n_peak")
    )


def remove_all_bad(df: DataFrame, time: str = "hjd", mag: str = "mag", err: str = "mag_err") -> DataFrame:
    """Rows whose time, magnitude and error are numbers and whose error is positive."""
    good = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < num(float("inf")))
    return df.where(good(time) & good(mag) & good(err) & (F.col(err) > 0))


def normalized(df: DataFrame, keys: list[str], mag: str = "mag", err: str = "mag_err") -> DataFrame:
    """Light curves put to the range 0 to 1, errors with them; a constant one becomes 0 with null errors."""
    span = df.groupBy(*keys).agg(F.min(mag).alias("_lo"), (F.max(mag) - F.min(mag)).alias("_span"))
    put = join_groups(df, span, keys)
    cells = {mag: F.coalesce(ratio(F.col(mag) - F.col("_lo"), F.col("_span")), F.col(mag) * 0.0), err: ratio(F.col(err), F.col("_span"))}
    return put.select(*[cells[c].alias(c) if c in cells else F.col(c) for c in df.columns])


def star_features(df: DataFrame, keys: list[str], time: str = "hjd", mag: str = "mag", err: str = "mag_err") -> DataFrame:
    """Variability features per light curve from their published definitions.

    Order-dependent features compare a row with the next three in the whole time-ordered table, found
    in chunks of row numbers: no light curve has to fit into one task. ``con`` and ``con2`` count the
    stretches of three or more points in a row that are brighter than the mean by three and two
    deviations; the buffer ranges are the shares of points within a fifth of the amplitude of the median
    and of those brighter than that; the median distance is that of successive points in time and
    magnitude. A null key is a light curve like any other. Sample entropy needs all pairs of a light
    curve and is left out.
    """
    rows = with_row_index(df.select(*keys, time, mag, err), [*keys, time, mag])
    level = cut_lineage(
        aggregate_with_quantiles(
            rows, keys,
            [F.count("*").alias("n"), F.avg(mag).alias("mean_mag"), F.stddev_samp(mag).alias("rms"),
             w.weighted_mean(mag, err).alias("_wm"), F.min(mag).alias("_min"), F.max(mag).alias("_max"), F.min("idx").alias("_i0")],
            {"_q": (mag, [0.5])},
        ).withColumn("median_mag", F.col("_q")[0]).drop("_q")
    )
    # a following row counts only if it belongs to the same light curve
    led = with_following(rows, [*keys, mag, err, time], 3)
    same = {n: F.col(f"{mag}{n}").isNotNull() for n in (1, 2, 3)}
    for n in same:
        for k in keys:
            same[n] = same[n] & F.col(k).eqNullSafe(F.col(f"{k}{n}"))
    ordered = led.select(
        *keys, time, mag, err, "idx", F.when(same[1], F.col(mag + "1")).alias("_m1"), F.when(same[1], F.col(err + "1")).alias("_e1"),
        F.when(same[1], F.col(time + "1")).alias("_t1"), F.when(same[2], F.col(mag + "2")).alias("_m2"), F.when(same[3], F.col(mag + "3")).alias("_m3"),
    )
    full = join_groups(ordered, level, keys).withColumn("idx", F.col("idx") - F.col("_i0"))
    m, e, mean = F.col(mag), F.col(err), F.col("mean_mag")
    z = ratio(m - mean, F.col("rms"))
    bias = F.sqrt(ratio(F.col("n"), F.col("n") - 1.0))
    delta = ratio(bias * (m - F.col("_wm")), e)
    delta1 = ratio(bias * (F.col("_m1") - F.col("_wm")), F.col("_e1"))
    step = F.col("_m1") - m

    def count_if(c: Column) -> Column:
        return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")

    def stretches(sigmas: float) -> Column:
        # a stretch begins at the first row of a light curve or behind a fainter one
        bright = [F.coalesce(c < mean - sigmas * F.col("rms"), F.lit(False)) for c in (m, F.col("_m1"), F.col("_m2"), F.col("_m3"))]
        at_once = (F.col("idx") == 0) & bright[0] & bright[1] & bright[2]
        return count_if(at_once) + count_if(~bright[0] & bright[1] & bright[2] & bright[3])

    n = F.max("n")
    buffer = (F.col("_max") - F.col("_min")) / 10
    feats = full.groupBy(*keys).agg(
        n.alias("n"), F.max("mean_mag").alias("mean_mag"), F.max("rms").alias("rms"), F.max("median_mag").alias("median_mag"),
        ((F.max("_max") - F.max("_min")) / 2).alias("amplitude"),
        ratio(F.max("rms"), F.max("mean_mag")).alias("std_over_mean"),
        F.avg(z * z * z).alias("skewness"), (F.avg(z * z * z * z) - 3.0).alias("kurtosis"),
        ratio(ratio(F.sum(step * step), n - 1), F.max(F.col("rms") * F.col("rms"))).alias("von_neumann"),
        ratio(F.sum(F.signum(delta * delta1) * F.sqrt(F.abs(delta * delta1))), n - 1).alias("stetson_j"),
        ratio(F.avg(F.abs(delta)), F.sqrt(F.avg(delta * delta))).alias("stetson_k"),
        count_if(m > mean + F.col("rms")).alias("above1"), count_if(m > mean + 3 * F.col("rms")).alias("above3"),
        count_if(m > mean + 5 * F.col("rms")).alias("above5"), count_if(m < mean - F.col("rms")).alias("below1"),
        count_if(m < mean - 3 * F.col("rms")).alias("below3"), count_if(m < mean - 5 * F.col("rms")).alias("below5"),
        count_if(m > mean).alias("count_above"), count_if(m < mean).alias("count_below"),
        F.sqrt(F.avg(m * m)).alias("root_mean_squared"), F.sum(m * m).alias("abs_energy"), F.sum(m).alias("sum_values"),
        F.sum(F.abs(step)).alias("abs_sum_changes"), F.avg(step).alias("mean_change"), F.avg(F.abs(step)).alias("mean_abs_change"),
        F.sqrt(F.sum(step * step)).alias("complexity"),
        F.avg((F.col("_m2") - 2 * F.col("_m1") + m) / 2).alias("mean_second_derivative"),
        F.avg(F.col("_m2") * F.col("_m1") * m).alias("c3"),
        F.avg(F.col("_m2") * F.col("_m2") * F.col("_m1") - F.col("_m1") * m * m).alias("time_reversal_asymmetry"),
        ratio(ratio(F.sum((m - mean) * (F.col("_m1") - mean)), n - 1), F.max(F.col("rms") * F.col("rms"))).alias("auto_corr"),
        F.sum((F.col("_m1") + m) / 2 * (F.col("_t1") - F.col(time))).alias("integral"),
        (F.min(F.when(m == F.col("_max"), F.col("idx"))) / n).alias("first_loc_max"),
        (F.min(F.when(m == F.col("_min"), F.col("idx"))) / n).alias("first_loc_min"),
        ((F.max(F.when(m == F.col("_max"), F.col("idx"))) + 1) / n).alias("last_loc_max"),
        ((F.max(F.when(m == F.col("_min"), F.col("idx"))) + 1) / n).alias("last_loc_min"),
        (count_if(m == F.col("_max")) > 1).alias("max_duplicate"), (count_if(m == F.col("_min")) > 1).alias("min_duplicate"),
        count_if((F.col("_m1") > m) & (F.col("_m1") > F.col("_m2"))).alias("peaks"),
        stretches(3.0).alias("con"), stretches(2.0).alias("con2"),
        (count_if(F.abs(m - F.col("median_mag")) < buffer) / n).alias("median_buffer_range"),
        (count_if(m < F.col("median_mag") - buffer) / n).alias("median_buffer_range2"),
    )
    repeats = rows.groupBy(*keys, mag).agg(F.count("*").alias("_c")).groupBy(*keys).agg(
        (F.max("_c") > 1).alias("has_duplicate"),
        (F.sum(F.when(F.col("_c") > 1, F.col("_c")).otherwise(0)) / F.sum("_c")).alias("ratio_recurring"),
        (F.log(F.sum("_c")) - F.sum(F.col("_c") * F.log("_c")) / F.sum("_c")).alias("shannon_entropy"),
    )
    gap = F.col("_t1") - F.col(time)
    apart = ordered.where(F.col("_m1").isNotNull()).select(*keys, F.sqrt(gap * gap + step * step).alias("_apart"))
    distance = grouped_quantiles(apart, keys, "_apart", [0.5], "_q").select(*keys, F.col("_q")[0].alias("median_distance"))
    side = join_groups(rows, level.select(*keys, "mean_mag"), keys).withColumn(
        "_side", F.when(m > mean, 1).when(m < mean, -1).otherwise(0)
    )
    strikes = _longest_runs(side, keys, "_side")
    spread = median_mad(rows, keys, mag).select(*keys, F.col("mad").alias("median_abs_dev"))
    out = feats
    for part, how in ((repeats, "inner"), (strikes, "inner"), (spread, "inner"), (distance, "left")):
        out = join_groups(out, part, keys, how)
    return out.withColumn("stetson_l", F.col("stetson_j") * F.col("stetson_k") / 0.798)


def _longest_runs(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    """Longest unbroken runs above and below: within one side, idx minus the rank is constant in a run."""
    ranked = with_group_index(df.select(*keys, side, "idx"), [*keys, side], ["idx"], "_rank")
    runs = ranked.groupBy(*keys, side, (F.col("idx") - F.col("_rank")).alias("_run")).agg(F.count("*").alias("_len"))
    return runs.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col(side) == 1, F.col("_len"))), F.lit(0)).alias("longest_strike_above"),
        F.coalesce(F.max(F.when(F.col(side) == -1, F.col("_len"))), F.lit(0)).alias("longest_strike_below"),
    )


def joint_information(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Mutual information of two binned columns per group."""
    cell = df.groupBy(*keys, x, y).agg(F.count("*").alias("_c"))
    px = cell.groupBy(*keys, x).agg(F.sum("_c").alias("_cx"))
    py = cell.groupBy(*keys, y).agg(F.sum("_c").alias("_cy"))
    total = cell.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    full = cell.join(px, [*keys, x]).join(py, [*keys, y]).join(total, keys)
    p = F.col("_c") / F.col("_n")
    return full.groupBy(*keys).agg(F.sum(p * F.log(F.col("_c") * F.col("_n") / (F.col("_cx") * F.col("_cy")))).alias("mutual_information"))


def offset_peak(pairs: DataFrame, dx: str, dy: str, limit: float, step: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Shift between two catalogues of an image (``keys``): centre of the fullest cell of the pair differences."""
    cells = pairs.where((F.abs(F.col(dx)) <= limit) & (F.abs(F.col(dy)) <= limit)).groupBy(
        *keys, F.floor(F.col(dx) / num(step)).alias("i"), F.floor(F.col(dy) / num(step)).alias("j")
    ).agg(F.count("*").alias("votes"))
    best = cells.groupBy(*keys).agg(F.min_by(F.struct("i", "j", "votes"), F.struct(-F.col("votes"), "i", "j")).alias("b"))
    return best.select(
        *keys, ((F.col("b.i") + 0.5) * step).alias("offset_x"), ((F.col("b.j") + 0.5) * step).alias("offset_y"), F.col("b.votes").alias("votes")
    )
