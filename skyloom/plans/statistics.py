"""Grouped statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import weights as w
from skyloom.functions.common import settled
from skyloom.operators import stats
from skyloom.operators.match import pairs_within, pixels_of
from skyloom.operators.quantiles import aggregate_with_quantiles, grouped_quantiles
from skyloom.operators.skew import attach_groups
from skyloom.plans.base import Tables, query, r6, with_views

def night():
    return F.floor("hjd").cast("bigint")


NIGHT_SQL = "CAST(floor(hjd) AS bigint) AS night"


def tidy(df, *columns, keep=()):
    """Key columns as they are, computed columns rounded."""
    return df.select(*keep, *[settled(c).alias(c) for c in columns])


@query("weighted_mean", with_views("valid") + f"""SELECT star_id, filter, {r6('sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err))')} AS wmean,
    {r6('sqrt(1/sum(1/(mag_err*mag_err)))')} AS werror, {r6('1/sum(1/(mag_err*mag_err))', 9)} AS wvariance
    FROM valid GROUP BY star_id, filter""")
def weighted_mean(t: Tables):
    return stats.valid_rows(t.phot).groupBy("star_id", "filter").agg(
        settled(w.weighted_mean("mag", "mag_err")).alias("wmean"),
        settled(w.weighted_error("mag_err")).alias("werror"),
        settled(w.weighted_variance_of_mean("mag_err"), 9).alias("wvariance"),
    )


MEANS_SQL = """m AS (SELECT star_id, filter, sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err)) AS wm,
    sqrt(1/sum(1/(mag_err*mag_err))) AS we FROM valid GROUP BY star_id, filter)"""
RMS_SQL = "sqrt(sum((mag-wm)*(mag-wm)/(mag_err*mag_err))/sum(1/(mag_err*mag_err)))"


@query("weighted_rms", with_views("valid", extra=MEANS_SQL) + f"""SELECT star_id, filter, {r6(RMS_SQL)} AS wrms
    FROM valid JOIN m USING (star_id, filter) GROUP BY star_id, filter""")
def weighted_rms(t: Tables):
    return stats.valid_rows(t.phot).groupBy("star_id", "filter").agg(settled(w.weighted_rms("mag", "mag_err")).alias("wrms"))


PRMS_SQL = "(quantile_cont(mag, 0.84) - quantile_cont(mag, 0.16))/2"


@query("percentile_rms", with_views("valid") + f"SELECT star_id, filter, {r6(PRMS_SQL)} AS prms FROM valid GROUP BY star_id, filter")
def percentile_rms(t: Tables):
    q = grouped_quantiles(stats.valid_rows(t.phot), ["star_id", "filter"], "mag", [0.16, 0.84])
    return q.select("star_id", "filter", settled((F.col("q")[1] - F.col("q")[0]) / 2).alias("prms"))


@query("star_statistics", with_views("valid", extra=MEANS_SQL) + f"""SELECT star_id, filter, count(*) AS n, {r6('any_value(wm)')} AS wmean,
    {r6('any_value(we)')} AS werror, {r6(RMS_SQL)} AS wrms, {r6(PRMS_SQL)} AS prms
    FROM valid JOIN m USING (star_id, filter) GROUP BY star_id, filter""")
def star_statistics(t: Tables):
    out = stats.star_statistics(t.phot, ["star_id", "filter"])
    return tidy(out, "wmean", "werror", "wrms", "prms", keep=["star_id", "filter", "n"])


RES_SQL = MEANS_SQL + """, res AS (SELECT v.*, mag - wm AS residual, sqrt(mag_err*mag_err + we*we) AS residual_err
    FROM valid v JOIN m USING (star_id, filter))"""


@query("phot_residuals", with_views("valid", extra=RES_SQL) + f"""SELECT star_id, filter, image_id, seq, {r6('residual')} AS residual,
    {r6('residual_err')} AS residual_err FROM res""")
def phot_residuals(t: Tables):
    res = stats.residuals(t.phot, ["star_id", "filter"])
    return tidy(res, "residual", "residual_err", keep=["star_id", "filter", "image_id", "seq"])


IMAGE_RES_SQL = RES_SQL + f""", nm AS (SELECT {NIGHT_SQL}, sum(residual/(residual_err*residual_err))/sum(1/(residual_err*residual_err)) AS mr
    FROM res GROUP BY night)"""


@query("image_residuals", with_views("valid", extra=IMAGE_RES_SQL) + f"""SELECT night, count(*) AS n, {r6('any_value(mr)')} AS mean_residual,
    {r6('sqrt(sum((residual-mr)*(residual-mr)/(residual_err*residual_err))/sum(1/(residual_err*residual_err)))', 5)} AS rms,
    {r6('sqrt(1/sum(1/(residual_err*residual_err)))')} AS std_error, {r6('avg(hjd)')} AS mean_time
    FROM (SELECT *, {NIGHT_SQL} FROM res) JOIN nm USING (night) GROUP BY night""")
def image_residuals(t: Tables):
    res = stats.residuals(t.phot, ["star_id", "filter"]).withColumn("night", night())
    out = stats.image_residuals(res, ["night"])
    return tidy(out, "mean_residual", "std_error", "mean_time", keep=["night", "n", settled("rms", 5).alias("rms")])


CLIP_SQL = """c0 AS (SELECT site, avg(mag) AS mu, stddev_pop(mag) AS sd FROM valid GROUP BY site),
    c1 AS (SELECT site, avg(mag) AS mu, stddev_pop(mag) AS sd FROM valid JOIN c0 USING (site) WHERE abs(mag-mu) <= 2*sd GROUP BY site),
    c2 AS (SELECT site, avg(mag) AS mu, stddev_pop(mag) AS sd FROM valid JOIN c1 USING (site) WHERE abs(mag-mu) <= 2*sd GROUP BY site),
    c3 AS (SELECT site, avg(mag) AS mu, stddev_pop(mag) AS sd, count(*) AS n FROM valid JOIN c2 USING (site) WHERE abs(mag-mu) <= 2*sd GROUP BY site)"""


@query("sigma_clip", with_views("valid", extra=CLIP_SQL) + f"SELECT site, {r6('mu')} AS mean, {r6('sd')} AS std, n FROM c3")
def sigma_clip(t: Tables):
    out = stats.sigma_clip(stats.valid_rows(t.phot), ["site"], "mag", 2.0, 3)
    return tidy(out, "mean", "std", keep=["site", "n"])


QUALITY_CLIP = CLIP_SQL.replace("site", "star_id, site").replace("2*sd", "3*sd")


@query("dataset_quality_metrics", with_views("valid", extra=QUALITY_CLIP) + f"""SELECT star_id, site, {r6('any_value(mu)')} AS mean_mag, {r6('any_value(sd)')} AS std_mag,
    {r6('quantile_cont(mag, 0.5)')} AS median_mag, {r6('quantile_cont(mag_err, 0.5)')} AS median_mag_error, count(*) AS n_valid,
    {r6('quantile_cont(pscale, 0.5)')} AS median_ps_factor FROM valid JOIN c3 USING (star_id, site) GROUP BY star_id, site""")
def dataset_quality_metrics(t: Tables):
    """Every star is used: the sample of the reference only saved time."""
    rows = stats.valid_rows(t.phot)
    keys = ["star_id", "site"]
    clipped = stats.sigma_clip(rows, keys, "mag", 3.0, 3).drop("n")
    meds = aggregate_with_quantiles(
        rows, keys, [F.count("*").alias("n_valid")],
        {"_m": ("mag", [0.5]), "_e": ("mag_err", [0.5]), "_s": ("pscale", [0.5])},
    )
    out = clipped.join(meds, keys)
    return out.select(
        *keys, settled("mean").alias("mean_mag"), settled("std").alias("std_mag"), settled(F.col("_m")[0]).alias("median_mag"),
        settled(F.col("_e")[0]).alias("median_mag_error"), "n_valid", settled(F.col("_s")[0]).alias("median_ps_factor"),
    )


MAD_SQL = """md AS (SELECT filter, quantile_cont(mag, 0.5) AS med FROM valid GROUP BY filter),
    mm AS (SELECT filter, any_value(med) AS med, quantile_cont(abs(mag-med), 0.5) AS mad FROM valid JOIN md USING (filter) GROUP BY filter)"""


@query("median_mad", with_views("valid", extra=MAD_SQL) + f"""SELECT filter, {r6('any_value(med)')} AS median, {r6('any_value(mad)')} AS mad,
    count(*) FILTER (WHERE mag BETWEEN med - 3*mad AND med + 3*mad) AS n_kept FROM valid JOIN mm USING (filter) GROUP BY filter""")
def median_mad(t: Tables):
    rows = stats.valid_rows(t.phot)
    limits = stats.median_mad(rows, ["filter"], "mag")
    kept = F.col("mag").between(F.col("median") - 3 * F.col("mad"), F.col("median") + 3 * F.col("mad"))
    return attach_groups(rows, limits, ["filter"]).groupBy("filter").agg(
        settled(F.max("median")).alias("median"), settled(F.max("mad")).alias("mad"), F.count_if(kept).alias("n_kept")
    )


@query("centre_and_spread", with_views("valid") + f"""SELECT site, filter, {r6('quantile_cont(mag, 0.5)')} AS median,
    {r6('(quantile_cont(mag, 0.75)-quantile_cont(mag, 0.25))/2')} AS half_iqr, {r6('avg(mag)')} AS mean, {r6('(max(mag)-min(mag))/2')} AS half_range
    FROM valid GROUP BY site, filter""")
def centre_and_spread(t: Tables):
    out = stats.centre_and_spread(stats.valid_rows(t.phot), ["site", "filter"], "mag")
    return tidy(out, "median", "half_iqr", "mean", "half_range", keep=["site", "filter"])


@query("histogram_1d", with_views("valid", extra="""md AS (SELECT site, quantile_cont(pscale, 0.5) AS med FROM valid GROUP BY site),
    low AS (SELECT site, pscale FROM valid JOIN md USING (site) WHERE pscale <= 2*med),
    sp AS (SELECT site, min(pscale) AS lo, max(pscale) AS hi FROM low GROUP BY site),
    h AS (SELECT site, least(CAST(floor((pscale-lo)/((hi-lo)/100)) AS bigint), 99) AS b, lo, hi, count(*) AS c FROM low JOIN sp USING (site) GROUP BY ALL)""")
    + f"""SELECT site, {r6('lo + b*(hi-lo)/100')} AS background, c AS n_peak FROM h
    QUALIFY row_number() OVER (PARTITION BY site ORDER BY c DESC, b) = 1""")
def histogram_1d(t: Tables):
    out = stats.background_peak(stats.valid_rows(t.phot), ["site"], "pscale")
    return tidy(out, "background", keep=["site", "n_peak"])


@query("histogram_2d", with_views("valid", extra="""sp AS (SELECT min(mag) AS xlo, max(mag) AS xhi, min(mag_err) AS ylo, max(mag_err) AS yhi FROM valid),
    h AS (SELECT least(CAST(floor((mag-xlo)/((xhi-xlo)/24)) AS bigint), 23) AS xbin, least(CAST(floor((mag_err-ylo)/((yhi-ylo)/24)) AS bigint), 23) AS ybin,
    any_value(xlo) AS xlo, any_value(xhi) AS xhi, any_value(ylo) AS ylo, any_value(yhi) AS yhi, count(*) AS n FROM valid, sp GROUP BY xbin, ybin)""")
    + f"""SELECT xbin, ybin, n, {r6('xlo + (xbin+5e-1)*(xhi-xlo)/24')} AS xcentre, {r6('ylo + (ybin+5e-1)*(yhi-ylo)/24')} AS ycentre FROM h""")
def histogram_2d(t: Tables):
    out = stats.histogram_2d(stats.valid_rows(t.phot), "mag", "mag_err", 24)
    return tidy(out, "xcentre", "ycentre", keep=["xbin", "ybin", "n"])


SHIFTED_SQL = "b AS (SELECT image_id, star_id AS bid, x + 3.3e0 + image_id AS bx, y - 2.1e0 AS byy FROM detections)"


@query("offset_vote", with_views("detections", extra=SHIFTED_SQL + """, p AS (SELECT image_id, bx - x AS dx, byy - y AS dy FROM detections JOIN b USING (image_id)
    WHERE abs(bx-x) <= 10 AND abs(byy-y) <= 10 AND sqrt((bx-x)*(bx-x)+(byy-y)*(byy-y)) <= 10),
    h AS (SELECT image_id, CAST(floor(dx/5e-1) AS bigint) AS i, CAST(floor(dy/5e-1) AS bigint) AS j, count(*) AS votes FROM p GROUP BY image_id, i, j)""")
    + f"SELECT image_id, {r6('(i+5e-1)*5e-1')} AS offset_x, {r6('(j+5e-1)*5e-1')} AS offset_y, votes FROM h QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY votes DESC, i, j) = 1")
def offset_vote(t: Tables):
    """Shift planted between two star lists of every image, found from the differences of all pairs within 10 pixels."""
    other = t.detections.select("image_id", "star_id", (F.col("x") + 3.3 + F.col("image_id")).alias("x"), (F.col("y") - 2.1).alias("y"))
    pairs = pairs_within(t.detections, other, 10.0, pixels_of("image_id"))
    diffs = pairs.select(F.col("l.image_id").alias("image_id"), (F.col("r.x") - F.col("l.x")).alias("dx"), (F.col("r.y") - F.col("l.y")).alias("dy"))
    return tidy(stats.offset_peak(diffs, "dx", "dy", 10.0, 0.5, ("image_id",)), "offset_x", "offset_y", keep=["image_id", "votes"])


@query("spatial_rms", with_views("valid", "stars", extra="""s AS (SELECT star_id, stddev_pop(mag) AS sd FROM valid GROUP BY star_id),
    j AS (SELECT star_id, sd, ra, dec FROM s JOIN stars USING (star_id)),
    sp AS (SELECT min(ra) AS a0, max(ra) AS a1, min(dec) AS d0, max(dec) AS d1 FROM j)""")
    + f"""SELECT least(CAST(floor((ra-a0)/((a1-a0)/16)) AS bigint), 15) AS xbin, least(CAST(floor((dec-d0)/((d1-d0)/16)) AS bigint), 15) AS ybin,
    count(*) AS n_stars, {r6('avg(sd)')} AS mean_rms, {r6('quantile_cont(sd, 0.5)')} AS median_rms FROM j, sp GROUP BY xbin, ybin""")
def spatial_rms(t: Tables):
    per_star = stats.valid_rows(t.phot).groupBy("star_id").agg(F.stddev_pop("mag").alias("sd"))
    placed = per_star.join(t.stars.select("star_id", "ra", "dec"), "star_id")
    span = placed.agg(F.min("ra").alias("a0"), F.max("ra").alias("a1"), F.min("dec").alias("d0"), F.max("dec").alias("d1"))
    binned = stats.attach_row(placed, span).select(
        stats.bin_number("ra", "a0", "a1", 16).alias("xbin"), stats.bin_number("dec", "d0", "d1", 16).alias("ybin"), "sd"
    )
    out = aggregate_with_quantiles(
        binned, ["xbin", "ybin"], [F.count("*").alias("n_stars"), F.avg("sd").alias("mean_rms")], {"_q": ("sd", [0.5])}
    )
    return out.select("xbin", "ybin", "n_stars", settled("mean_rms").alias("mean_rms"), settled(F.col("_q")[0]).alias("median_rms"))


@query("star_colours_table", with_views("valid", extra="""c AS (SELECT star_id,
    sum(CASE WHEN filter='gp' THEN mag/(mag_err*mag_err) END)/sum(CASE WHEN filter='gp' THEN 1/(mag_err*mag_err) END) AS g,
    sum(CASE WHEN filter='rp' THEN mag/(mag_err*mag_err) END)/sum(CASE WHEN filter='rp' THEN 1/(mag_err*mag_err) END) AS r,
    sum(CASE WHEN filter='ip' THEN mag/(mag_err*mag_err) END)/sum(CASE WHEN filter='ip' THEN 1/(mag_err*mag_err) END) AS i,
    sqrt(1/sum(CASE WHEN filter='gp' THEN 1/(mag_err*mag_err) END)) AS ge, sqrt(1/sum(CASE WHEN filter='rp' THEN 1/(mag_err*mag_err) END)) AS re,
    sqrt(1/sum(CASE WHEN filter='ip' THEN 1/(mag_err*mag_err) END)) AS ie FROM valid GROUP BY star_id)""")
    + f"""SELECT star_id, {r6('g')} AS g, {r6('r')} AS r, {r6('i')} AS i, {r6('g-r')} AS gr, {r6('sqrt(ge*ge+re*re)')} AS gr_err,
    {r6('g-i')} AS gi, {r6('sqrt(ge*ge+ie*ie)')} AS gi_err, {r6('r-i')} AS ri, {r6('sqrt(re*re+ie*ie)')} AS ri_err FROM c""")
def star_colours_table(t: Tables):
    def band(f: str):
        m, e = F.when(F.col("filter") == f, F.col("mag")), F.when(F.col("filter") == f, F.col("mag_err"))
        return w.weighted_mean(m, e).alias(f[0]), w.weighted_error(e).alias(f[0] + "e")

    wide = stats.valid_rows(t.phot).groupBy("star_id").agg(*band("gp"), *band("rp"), *band("ip"))
    for a, b in ("gr", "gi", "ri"):
        wide = wide.withColumn(a + b, F.col(a) - F.col(b)).withColumn(
            f"{a}{b}_err", F.sqrt(F.col(a + "e") * F.col(a + "e") + F.col(b + "e") * F.col(b + "e"))
        )
    return tidy(wide, "g", "r", "i", "gr", "gr_err", "gi", "gi_err", "ri", "ri_err", keep=["star_id"])


@query("survey_bounds", with_views("stars") + f"""SELECT {r6('min(ra)*0.99e0')} AS ra_min, {r6('max(ra)*1.01e0')} AS ra_max,
    {r6('min(dec)*1.01e0')} AS dec_min, {r6('max(dec)*0.99e0')} AS dec_max FROM stars""")
def survey_bounds(t: Tables):
    return t.stars.agg(
        settled(F.min("ra") * 0.99).alias("ra_min"), settled(F.max("ra") * 1.01).alias("ra_max"),
        settled(F.min("dec") * 1.01).alias("dec_min"), settled(F.max("dec") * 0.99).alias("dec_max"),
    )


@query("stellar_density", with_views("stars", extra="""z AS (SELECT CAST(floor((dec+90)/1e-1) AS bigint) AS zone, count(*) AS n FROM stars GROUP BY zone)""")
    + f"SELECT zone, n, {r6('n/(pow(1e-1*60, 2)*pi())')} AS density, CAST(n/(pow(1e-1*60, 2)*pi()) > 10 AS int) AS crowded FROM z")
def stellar_density(t: Tables):
    """Stars per square arcmin for a circle of 0.1 degree, and the crowded flag above 10."""
    area = (0.1 * 60.0) ** 2 * 3.141592653589793
    n = t.stars.groupBy(F.floor((F.col("dec") + 90.0) / F.lit(0.1)).alias("zone")).agg(F.count("*").alias("n"))
    d = F.col("n") / F.lit(area)
    return n.select("zone", "n", settled(d).alias("density"), (d > 10).cast("int").alias("crowded"))


@query("reference_flux", with_views("valid") + f"SELECT site, filter, {r6('min(pow(10e0, (mag-25e0)/-2.5e0))')} AS reference_flux FROM valid GROUP BY site, filter")
def reference_flux(t: Tables):
    """Faintest positive flux per dataset."""
    flux = F.pow(F.lit(10.0), (F.col("mag") - 25.0) / -2.5)
    rows = t.phot.select("site", "filter", F.when(F.col("mag") > 0, flux).otherwise(0.0).alias("flux"))
    return rows.where("flux > 0").groupBy("site", "filter").agg(settled(F.min("flux")).alias("reference_flux"))


@query("catalogue_sql", with_views("phot", "stars") + f"""SELECT star_id, {r6('any_value(ra)')} AS ra, count(*) AS n, {r6('avg(mag)')} AS meanmag, {r6('max(mag)-avg(mag)')} AS maxdiff
    FROM phot NATURAL JOIN stars WHERE mag > 0 AND ra BETWEEN 260e0 AND 270e0 AND dec BETWEEN -30e0 AND -20e0
    GROUP BY star_id ORDER BY maxdiff DESC, star_id LIMIT 5""")
def catalogue_sql(t: Tables):
    """The five stars with the largest brightening inside a region, as one SQL text with bound arguments."""
    return t.spark.sql(
        """SELECT star_id, round(any_value(ra), 6) + 0e0 AS ra, count(*) AS n, round(avg(mag), 6) + 0e0 AS meanmag,
               round(max(mag) - avg(mag), 6) + 0e0 AS maxdiff
           FROM {phot} NATURAL JOIN {stars}
           WHERE mag > 0 AND ra BETWEEN :ra0 AND :ra1 AND dec BETWEEN :dec0 AND :dec1
           GROUP BY star_id ORDER BY maxdiff DESC, star_id LIMIT 5""",
        args={"ra0": 260.0, "ra1": 270.0, "dec0": -30.0, "dec1": -20.0}, phot=t.phot, stars=t.stars,
    )


FEATURE_SQL = """o AS (SELECT *, row_number() OVER w - 1 AS idx, lead(mag, 1) OVER w AS m1, lead(mag, 2) OVER w AS m2, lead(mag, 3) OVER w AS m3, lead(mag_err, 1) OVER w AS e1, lead(hjd, 1) OVER w AS t1
      FROM valid WINDOW w AS (PARTITION BY star_id, filter ORDER BY hjd, mag)),
    l AS (SELECT star_id, filter, count(*) AS n, avg(mag) AS mu, stddev_samp(mag) AS sd, min(mag) AS lo, max(mag) AS hi, quantile_cont(mag, 0.5) AS med, sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err)) AS wm FROM valid GROUP BY star_id, filter),
    d AS (SELECT star_id, filter, quantile_cont(abs(mag-med), 0.5) AS mad FROM valid JOIN l USING (star_id, filter) GROUP BY star_id, filter),
    sd AS (SELECT *, CASE WHEN mag > mu THEN 1 WHEN mag < mu THEN -1 ELSE 0 END AS side, (mag-mu)/nullif(sd, 0) AS z, sqrt(n/nullif(n - 1e0, 0))*(mag-wm)/mag_err AS d0, sqrt(n/nullif(n - 1e0, 0))*(m1-wm)/e1 AS d1,
      coalesce(mag < mu - 3*sd, FALSE) AS a0, coalesce(m1 < mu - 3*sd, FALSE) AS a1, coalesce(m2 < mu - 3*sd, FALSE) AS a2, coalesce(m3 < mu - 3*sd, FALSE) AS a3,
      coalesce(mag < mu - 2*sd, FALSE) AS b0, coalesce(m1 < mu - 2*sd, FALSE) AS b1, coalesce(m2 < mu - 2*sd, FALSE) AS b2, coalesce(m3 < mu - 2*sd, FALSE) AS b3 FROM o JOIN l USING (star_id, filter)),
    rn AS (SELECT star_id, filter, side, idx - row_number() OVER (PARTITION BY star_id, filter, side ORDER BY idx) AS g FROM sd),
    rl AS (SELECT star_id, filter, side, count(*) AS len FROM rn GROUP BY star_id, filter, side, g),
    st AS (SELECT star_id, filter, coalesce(max(CASE WHEN side = 1 THEN len END), 0) AS up, coalesce(max(CASE WHEN side = -1 THEN len END), 0) AS down FROM rl GROUP BY star_id, filter),
    vc AS (SELECT star_id, filter, mag, count(*) AS c FROM valid GROUP BY star_id, filter, mag),
    rp AS (SELECT star_id, filter, max(c) > 1 AS dup, sum(CASE WHEN c > 1 THEN c ELSE 0 END)/sum(c) AS rec, ln(sum(c)) - sum(c*ln(c))/sum(c) AS ent FROM vc GROUP BY star_id, filter)"""
# column, SQL over the joined tables (grouped by star and filter), whether it is rounded
FEATURES = [
    ("n", "any_value(n)", 0), ("mean_mag", "any_value(mu)", 1), ("rms", "any_value(sd)", 1), ("median_mag", "any_value(med)", 1), ("median_abs_dev", "any_value(mad)", 1), ("amplitude", "any_value(hi-lo)/2", 1),
    ("std_over_mean", "any_value(sd/mu)", 1), ("skewness", "avg(z*z*z)", 1), ("kurtosis", "avg(z*z*z*z) - 3", 1), ("von_neumann", "sum((m1-mag)*(m1-mag))/nullif(any_value(n)-1, 0)/nullif(any_value(sd*sd), 0)", 1),
    ("stetson_j", "sum(sign(d0*d1)*sqrt(abs(d0*d1)))/nullif(any_value(n)-1, 0)", 1), ("stetson_k", "avg(abs(d0))/nullif(sqrt(avg(d0*d0)), 0)", 1),
    ("stetson_l", "sum(sign(d0*d1)*sqrt(abs(d0*d1)))/nullif(any_value(n)-1, 0)*avg(abs(d0))/nullif(sqrt(avg(d0*d0)), 0)/0.798e0", 1),
    ("above1", "count(*) FILTER (WHERE mag > mu + sd)", 0), ("above3", "count(*) FILTER (WHERE mag > mu + 3*sd)", 0), ("above5", "count(*) FILTER (WHERE mag > mu + 5*sd)", 0),
    ("below1", "count(*) FILTER (WHERE mag < mu - sd)", 0), ("below3", "count(*) FILTER (WHERE mag < mu - 3*sd)", 0), ("below5", "count(*) FILTER (WHERE mag < mu - 5*sd)", 0),
    ("count_above", "count(*) FILTER (WHERE mag > mu)", 0), ("count_below", "count(*) FILTER (WHERE mag < mu)", 0), ("root_mean_squared", "sqrt(avg(mag*mag))", 1), ("abs_energy", "sum(mag*mag)", 4), ("sum_values", "sum(mag)", 4),
    ("abs_sum_changes", "sum(abs(m1-mag))", 1), ("mean_change", "avg(m1-mag)", 1), ("mean_abs_change", "avg(abs(m1-mag))", 1), ("complexity", "sqrt(sum((m1-mag)*(m1-mag)))", 1),
    ("mean_second_derivative", "avg((m2-2*m1+mag)/2)", 1), ("c3", "avg(m2*m1*mag)", 1), ("time_reversal_asymmetry", "avg(m2*m2*m1 - m1*mag*mag)", 4), ("auto_corr", "sum((mag-mu)*(m1-mu))/nullif(any_value(n)-1, 0)/nullif(any_value(sd*sd), 0)", 1),
    ("integral", "sum((m1+mag)/2*(t1-hjd))", 3), ("first_loc_max", "min(idx) FILTER (WHERE mag = hi)/any_value(n)", 1), ("first_loc_min", "min(idx) FILTER (WHERE mag = lo)/any_value(n)", 1),
    ("last_loc_max", "(max(idx) FILTER (WHERE mag = hi) + 1)/any_value(n)", 1), ("last_loc_min", "(max(idx) FILTER (WHERE mag = lo) + 1)/any_value(n)", 1),
    ("max_duplicate", "count(*) FILTER (WHERE mag = hi) > 1", 0), ("min_duplicate", "count(*) FILTER (WHERE mag = lo) > 1", 0), ("peaks", "count(*) FILTER (WHERE m1 > mag AND m1 > m2)", 0),
    ("con", "count(*) FILTER (WHERE idx = 0 AND a0 AND a1 AND a2) + count(*) FILTER (WHERE NOT a0 AND a1 AND a2 AND a3)", 0), ("con2", "count(*) FILTER (WHERE idx = 0 AND b0 AND b1 AND b2) + count(*) FILTER (WHERE NOT b0 AND b1 AND b2 AND b3)", 0),
    ("median_buffer_range", "count(*) FILTER (WHERE abs(mag-med) < (hi-lo)/10)/any_value(n)", 1), ("median_buffer_range2", "count(*) FILTER (WHERE mag < med - (hi-lo)/10)/any_value(n)", 1),
    ("has_duplicate", "any_value(dup)", 0), ("ratio_recurring", "any_value(rec)", 1), ("shannon_entropy", "any_value(ent)", 1), ("longest_strike_above", "any_value(up)", 0), ("longest_strike_below", "any_value(down)", 0),
    ("median_distance", "quantile_cont(sqrt((t1-hjd)*(t1-hjd) + (m1-mag)*(m1-mag)), 0.5)", 1),
]
DIGITS = {1: 6, 3: 3, 4: 4}


@query("star_features", with_views("valid", extra=FEATURE_SQL) + "SELECT star_id, filter, " + ", ".join(f"{r6(sql, DIGITS[kind]) if kind else sql} AS {name}" for name, sql, kind in FEATURES)
    + " FROM sd JOIN d USING (star_id, filter) JOIN st USING (star_id, filter) JOIN rp USING (star_id, filter) GROUP BY star_id, filter")
def star_features(t: Tables):
    """All features of every star and filter."""
    out = stats.star_features(stats.remove_all_bad(stats.valid_rows(t.phot)), ["star_id", "filter"])
    return out.select("star_id", "filter", *[settled(name, DIGITS[kind]).alias(name) if kind else F.col(name) for name, _, kind in FEATURES])
