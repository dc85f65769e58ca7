"""Calibration, normalization and light curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import phot as p, stellar, weights as w
from skyloom.functions.common import settled
from skyloom.operators import ingest, calibrate as cal, catalog, crossmatch, lightcurves as lc, stats
from skyloom.operators.ordering import with_row_index
from skyloom.operators.quantiles import aggregate_with_quantiles
from skyloom.operators.skew import pick_first
from skyloom.plans.base import Tables, query, r6, sep_sql, with_views
from skyloom.plans.expressions import rounded
from skyloom.plans.matching import ARCSEC, TWO, one_to_one_sql
from skyloom.plans.statistics import NIGHT_SQL, night
from skyloom.session import cut_lineage, stored
from skyloom.sources import tables, textfiles

POINT = ["image_id", "seq", "star_id"]


@query("calibration_star_selection", with_views("star_mags", "stars", extra="""l AS (SELECT 2*quantile_cont(g_err, 0.5) AS lg, 2*quantile_cont(r_err, 0.5) AS lr, 2*quantile_cont(i_err, 0.5) AS li FROM star_mags)""")
    + "SELECT star_id, gaia_source_id FROM star_mags JOIN stars USING (star_id), l WHERE g_err <= lg AND r_err <= lr AND i_err <= li AND g < 16 AND r < 16 AND i < 16 AND i > 10 AND i_err > 0 AND gaia_source_id <> 'None'")
def calibration_star_selection(t: Tables):
    d = t.star_mags.join(t.stars.select("star_id", "gaia_source_id"), "star_id").withColumn("mag", F.col("i")).withColumn("mag_err", F.col("i_err"))
    return cal.select_calibration_stars(d, ["g", "r", "i"], "gaia_source_id", faint=16.0).select("star_id", "gaia_source_id")


RIDGE = """d AS (SELECT 17e0 + (p_partkey % 700)/2e2 AS x, 17.35e0 + 1.02e0*(p_partkey % 700)/2e2 + (p_partkey % 13 - 6)/1e2 AS y FROM part),
    sp AS (SELECT min(x) AS xlo, max(x) AS xhi, min(y) AS ylo, max(y) AS yhi FROM d),
    h AS (SELECT least(CAST(floor((x-xlo)/((xhi-xlo)/24)) AS bigint), 23) AS i, least(CAST(floor((y-ylo)/((yhi-ylo)/24)) AS bigint), 23) AS j, any_value(xlo) AS xlo, any_value(xhi) AS xhi, any_value(ylo) AS ylo, any_value(yhi) AS yhi, count(*) AS n FROM d, sp GROUP BY 1, 2),
    c AS (SELECT i, j, n, xlo + (i+5e-1)*(xhi-xlo)/24 AS xc, ylo + (j+5e-1)*(yhi-ylo)/24 AS yc FROM h WHERE n > 5e-2*(SELECT max(n) FROM h)),
    mo AS (SELECT i, arg_min(yc, (-n, j)) AS y, max(xc) AS x FROM c GROUP BY i), pt AS (SELECT mo.x, mo.y FROM c JOIN mo USING (i) WHERE mo.x >= 15 AND mo.x < 21),
    f AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS sxx, var_pop(y) AS syy, covar_pop(x, y) AS sxy FROM pt),
    g AS (SELECT *, (syy-sxx+sqrt((syy-sxx)*(syy-sxx)+4*sxy*sxy))/(2*sxy) AS a FROM f), v AS (SELECT *, (syy-2*a*sxy+a*a*sxx)*n/(n-2) AS rv FROM g)"""


@query("calibration_fit", "WITH " + RIDGE + f"SELECT n AS n_points, {r6('a')} AS a, {r6('my-a*mx')} AS b, {r6('rv/(n*sxx)', 9)} AS c00, {r6('-mx*rv/(n*sxx)', 9)} AS c01, {r6('rv/n + mx*mx*rv/(n*sxx)', 9)} AS c11 FROM v")
def calibration_fit(t: Tables):
    k = F.col("p_partkey")
    d = t.raw("part").select(
        (F.lit(17.0) + (k % 700) / 200.0).alias("x"), (F.lit(17.35) + F.lit(1.02) * (k % 700) / 200.0 + (k % 13 - 6) / 100.0).alias("y")
    )
    limits = cal.calibration_limits("ip", use_gaia=True)
    fit = cal.fit_line(cal.ridge_line(d, "x", "y", limits["det_mags_min"], limits["det_mags_max"]), [], "x", "y", "weight")
    return fit.select("n_points", settled("a").alias("a"), settled("b").alias("b"), *[settled(c, 9).alias(c) for c in ("c00", "c01", "c11")])


COEF_SQL = "co AS (SELECT DISTINCT dataset, 1e0 + ascii(site)/1e4 AS a, -1e-1 - ascii(filter)/1e4 AS b, 1e-6 AS c00, -1e-5 AS c01, 2e-4 AS c11 FROM dataset_phot)"


def coefficients(t: Tables):
    d = t.dataset_phot.select("dataset", "site", "filter").distinct()
    return d.select(
        "dataset", (F.lit(1.0) + F.ascii("site") / 10000.0).alias("a"), (F.lit(-0.1) - F.ascii("filter") / 10000.0).alias("b"),
        F.lit(1e-6).alias("c00"), F.lit(-1e-5).alias("c01"), F.lit(2e-4).alias("c11"),
    )


@query("apply_calibration", with_views("dataset_phot", extra=COEF_SQL + """, x AS (SELECT p.*, CASE WHEN mag >= 7 THEN a*mag+b ELSE 0e0 END AS cm, CASE WHEN mag >= 7 THEN sqrt(mag*mag*c00+2*mag*c01+c11+a*a*mag_err*mag_err) ELSE 0e0 END AS ce FROM dataset_phot p JOIN co USING (dataset))""")
    + f"SELECT image_id, seq, star_id, {r6('cm')} AS cal_mag, {r6('ce')} AS cal_mag_err, {r6('pow(1e1, (cm-25e0)/-2.5e0)', 3)} AS cal_flux FROM x")
def apply_calibration(t: Tables):
    out = cal.apply_calibration(t.dataset_phot, coefficients(t), ["dataset"])
    return out.select(*POINT, settled("cal_mag").alias("cal_mag"), settled("cal_mag_err").alias("cal_mag_err"), settled("cal_flux", 3).alias("cal_flux"))


@query("scan_calibration_file", with_views("dataset_phot", extra=COEF_SQL) + f"SELECT dataset, {r6('a')} AS a, {r6('b')} AS b, {r6('c11')} AS c11, count(*) AS n FROM dataset_phot JOIN co USING (dataset) GROUP BY ALL")
def scan_calibration_file(t: Tables):
    """Coefficients written as text, read back with their schema and joined with the rows they belong to."""
    stored = textfiles.write_calibrations(coefficients(t))
    counts = t.dataset_phot.groupBy("dataset").agg(F.count("*").alias("n"))
    return counts.join(textfiles.read_calibrations(t.spark, stored), "dataset").select("dataset", settled("a").alias("a"), settled("b").alias("b"), settled("c11").alias("c11"), "n")


CONST = """pm AS (SELECT star_id, sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err)) AS wm FROM valid WHERE site = 'lsc-doma' AND filter = 'ip' GROUP BY star_id),
    pr AS (SELECT star_id, sqrt(sum((mag-wm)*(mag-wm)/(mag_err*mag_err))/sum(1/(mag_err*mag_err))) AS rms FROM valid JOIN pm USING (star_id) WHERE site = 'lsc-doma' AND filter = 'ip' GROUP BY star_id),
    cs AS (SELECT star_id, rms FROM pr WHERE rms <= (SELECT min(rms) + (max(rms)-min(rms))*4e-1 FROM pr))"""


@query("constant_stars", with_views("valid", extra=CONST) + f"SELECT star_id, {r6('rms')} AS rms FROM cs")
def constant_stars(t: Tables):
    out = cal.constant_stars(t.phot.where("site = 'lsc-doma' AND filter = 'ip'"), fraction=0.4)
    return rounded(out, ["star_id"], {"rms": "rms"})


NORM = CONST + f""", dm AS (SELECT star_id, site, filter, sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err)) AS mag, sqrt(1/sum(1/(mag_err*mag_err))) AS err FROM valid GROUP BY ALL),
    st AS (SELECT * FROM dm WHERE star_id IN (SELECT star_id FROM cs)),
    bo AS (SELECT a.site, a.filter, a.mag AS x, r.mag AS y FROM st a JOIN st r ON r.star_id = a.star_id AND r.filter = a.filter AND r.site = 'lsc-doma' WHERE a.site <> 'lsc-doma' AND a.err <= 5e-2 AND r.err <= 5e-2 AND abs(a.mag-r.mag) <= 5e-1),
    ag AS (SELECT site, filter, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS sxx, var_pop(y) AS syy, covar_pop(x, y) AS sxy FROM bo GROUP BY ALL),
    ft AS (SELECT *, (syy-sxx+sqrt((syy-sxx)*(syy-sxx)+4*sxy*sxy))/(2*sxy) AS a FROM ag)"""


@query("dataset_normalization", with_views("valid", extra=NORM) + f"""SELECT star_id, v.site, v.filter, count(*) AS n, {r6('avg(CASE WHEN v.site = $$lsc-doma$$ THEN mag WHEN mag >= 7 THEN a*mag + my - a*mx ELSE 0e0 END)', 4)} AS mean_norm_mag
    FROM valid v LEFT JOIN ft ON ft.site = v.site AND ft.filter = v.filter GROUP BY ALL""")
def dataset_normalization(t: Tables):
    """Fits of all datasets against the reference site over constant stars, applied to every measurement."""
    # one scan of the photometry for the means and one for the result
    means = stored(cal.dataset_means(t.dataset_phot))
    fits = cal.normalization_fits(means, cal.constant_among(means, "lsc-doma", "ip", fraction=0.4), "lsc-doma")
    out = cal.normalize(t.dataset_phot, fits, "lsc-doma").where("mag > 0 AND mag_err > 0")
    return out.groupBy("star_id", "site", "filter").agg(F.count("*").alias("n"), settled(F.avg("norm_mag"), 4).alias("mean_norm_mag"))


BINS = """sv AS (SELECT floor(min(hjd)) AS s0 FROM valid), bn AS (SELECT star_id, site, filter, CAST(floor(hjd - s0) AS bigint) AS bin, any_value(s0) + CAST(floor(hjd - s0) AS bigint) + 5e-1 AS centre,
    sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err)) AS mag, sqrt(1/sum(1/(mag_err*mag_err))) AS err FROM valid, sv GROUP BY star_id, site, filter, CAST(floor(hjd - s0) AS bigint))"""
STAR_DATASET = ["star_id", "site", "filter"]


@query("time_bins", with_views("valid", extra=BINS) + f"SELECT star_id, site, filter, bin, {r6('centre')} AS centre, {r6('mag')} AS mag, {r6('err')} AS mag_err FROM bn")
def time_bins(t: Tables):
    return rounded(cal.time_bins(t.phot, STAR_DATASET), [*STAR_DATASET, "bin"], {"centre": "centre", "mag": "mag", "mag_err": "mag_err"})


RESID = BINS + """, rs AS (SELECT 'lsc-doma' AS reference, a.star_id, a.filter, a.site, a.bin, r.mag-a.mag AS d, sqrt(r.err*r.err+a.err*a.err) AS e FROM bn a JOIN bn r ON r.star_id = a.star_id AND r.filter = a.filter AND r.bin = a.bin AND r.site = 'lsc-doma' WHERE a.site <> 'lsc-doma'
    UNION ALL SELECT 'cpt-doma', a.star_id, a.filter, a.site, a.bin, r.mag-a.mag, sqrt(r.err*r.err+a.err*a.err) FROM bn a JOIN bn r ON r.star_id = a.star_id AND r.filter = a.filter AND r.bin = a.bin AND r.site = 'cpt-doma' WHERE a.site <> 'cpt-doma'
    AND NOT EXISTS (SELECT 1 FROM bn z WHERE z.site = 'lsc-doma' AND z.star_id = a.star_id AND z.filter = a.filter)
    UNION ALL SELECT 'coj-doma', a.star_id, a.filter, a.site, a.bin, r.mag-a.mag, sqrt(r.err*r.err+a.err*a.err) FROM bn a JOIN bn r ON r.star_id = a.star_id AND r.filter = a.filter AND r.bin = a.bin AND r.site = 'coj-doma' WHERE a.site <> 'coj-doma'
    AND NOT EXISTS (SELECT 1 FROM bn z WHERE z.site IN ('lsc-doma', 'cpt-doma') AND z.star_id = a.star_id AND z.filter = a.filter))"""
REFS = ["lsc-doma", "cpt-doma", "coj-doma"]


@query("dataset_residuals", with_views("valid", extra=RESID) + f"SELECT reference, star_id, filter, site, bin, {r6('d')} AS delta, {r6('e')} AS delta_err FROM rs")
def dataset_residuals(t: Tables):
    out = cal.dataset_residuals(cal.time_bins(t.phot, STAR_DATASET), REFS)
    return rounded(out, ["reference", "star_id", "filter", "site", "bin"], {"delta": "delta", "delta_err": "delta_err"})


OFFS = RESID + """, k0 AS (SELECT reference, star_id, filter, site, count(*) AS n, quantile_cont(d, 0.5) AS o FROM rs GROUP BY ALL),
    k1 AS (SELECT k0.* EXCLUDE (o), coalesce((SELECT avg(d) FROM rs WHERE rs.reference = k0.reference AND rs.star_id = k0.star_id AND rs.filter = k0.filter AND rs.site = k0.site AND abs(d-k0.o) <= 1e-1), k0.o) AS o FROM k0),
    k2 AS (SELECT k1.* EXCLUDE (o), coalesce((SELECT avg(d) FROM rs WHERE rs.reference = k1.reference AND rs.star_id = k1.star_id AND rs.filter = k1.filter AND rs.site = k1.site AND abs(d-k1.o) <= 1e-1), k1.o) AS o FROM k1),
    k3 AS (SELECT k2.reference, k2.star_id, k2.filter, k2.site, any_value(n) AS n, any_value(o) AS o, sum(abs(d-o)/(e*e)) FILTER (WHERE abs(d-o) <= 1e-1)/sum(1/(e*e)) FILTER (WHERE abs(d-o) <= 1e-1) AS s
      FROM k2 JOIN rs USING (reference, star_id, filter, site) GROUP BY ALL)"""


@query("star_offset", with_views("valid", extra=OFFS) + f"""SELECT reference, star_id, filter, site, n AS n_bins, {r6('CASE WHEN n > 2 THEN o ELSE 0e0 END', 5)} AS delta_mag, {r6('CASE WHEN n > 2 THEN coalesce(s, 0e0) ELSE 0e0 END', 5)} AS delta_mag_err FROM k3""")
def star_offset(t: Tables):
    res = cal.dataset_residuals(cal.time_bins(t.phot, STAR_DATASET), REFS)
    keys = ["reference", "star_id", "filter", "site"]
    out = cal.star_offsets(res, keys)
    return out.select(*keys, "n_bins", settled("delta_mag", 5).alias("delta_mag"), settled("delta_mag_err", 5).alias("delta_mag_err"))


@query("sink_normalizations", with_views("valid", extra=OFFS) + f"""SELECT reference, star_id, filter, {r6("coalesce(max(CASE WHEN site = 'cpt-doma' AND n > 2 THEN o END), 0e0)", 5)} AS delta_cpt, {r6("coalesce(max(CASE WHEN site = 'coj-doma' AND n > 2 THEN o END), 0e0)", 5)} AS delta_coj
    FROM k3 GROUP BY ALL""")
def sink_normalizations(t: Tables):
    """Long table written out; wide view by pivot with a fixed list of datasets."""
    res = cal.dataset_residuals(cal.time_bins(t.phot, STAR_DATASET), REFS)
    path = tables.write_normalizations(cal.star_offsets(res, ["reference", "star_id", "filter", "site"]))
    wide = tables.read_normalizations_wide(t.spark, path, ["cpt-doma", "coj-doma"])
    zero = F.lit(0.0)
    return wide.select(
        "reference", "star_id", "filter", settled(F.coalesce("`cpt-doma`", zero), 5).alias("delta_cpt"), settled(F.coalesce("`coj-doma`", zero), 5).alias("delta_coj")
    )


MERGE = """pm AS (SELECT star_id, site, filter, sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err)) AS m FROM valid GROUP BY ALL),
    pd AS (SELECT a.site, a.filter, r.m - a.m AS d FROM pm a JOIN pm r ON r.star_id = a.star_id AND r.filter = a.filter AND r.site = 'lsc-doma' WHERE a.site <> 'lsc-doma'),
    s0 AS (SELECT site, filter, count(*) AS n, (max(d)-min(d))/100 AS wd, quantile_cont(d, 0.5) AS o FROM pd GROUP BY ALL)""" + "".join(
    f", s{i} AS (SELECT s.site, s.filter, any_value(n) AS n, any_value(wd) AS wd, coalesce(quantile_cont(d, 0.5), any_value(s.o)) AS o FROM s{i-1} s LEFT JOIN pd ON pd.site = s.site AND pd.filter = s.filter AND abs(d-s.o) <= 5*s.wd GROUP BY s.site, s.filter)" for i in (1, 2, 3))


@query("merge_offset", with_views("valid", extra=MERGE) + f"SELECT site, filter, n, {r6('o')} AS delta_mag, {r6('1e0/n')} AS delta_mag_err FROM s3")
def merge_offset(t: Tables):
    means = cal.dataset_means(t.dataset_phot)
    ref = means.where("site = 'lsc-doma'").select("star_id", "filter", F.col("mag").alias("ref_mag"))
    pairs = means.where("site != 'lsc-doma'").join(ref, ["star_id", "filter"]).select("site", "filter", (F.col("ref_mag") - F.col("mag")).alias("delta"))
    out = cal.merge_offset(cut_lineage(pairs), ["site", "filter"])
    return rounded(out, ["site", "filter", "n"], {"delta_mag": "delta_mag", "delta_mag_err": "delta_mag_err"})


SOURCE = f"""nb AS (SELECT star_id, filter, {NIGHT_SQL}, sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err)) AS m, sqrt(1/sum(1/(mag_err*mag_err))) AS e FROM valid GROUP BY ALL),
    fx AS (SELECT star_id, filter, night, pow(1e1, (m-25e0)/-2.5e0) AS f, e/(2.5e0*log10(exp(1e0)))*pow(1e1, (m-25e0)/-2.5e0) AS fe FROM nb),
    pr AS (SELECT g.star_id, r.f AS x, g.f AS y FROM fx g JOIN fx r ON r.star_id = g.star_id AND r.night = g.night AND g.filter = 'gp' AND r.filter = 'rp'),
    fit AS (SELECT star_id, count(*) AS n, regr_slope(y, x) AS sl, regr_intercept(y, x) AS ic FROM pr GROUP BY star_id)"""


def paired_fluxes(t: Tables):
    """Fluxes in two bands of the same star and night."""
    n = t.valid.groupBy("star_id", "filter", night().alias("night")).agg(w.weighted_mean("mag", "mag_err").alias("m"), w.weighted_error("mag_err").alias("e"))
    flux, err = p.mag_to_flux("m", "e")
    d = n.select("star_id", "filter", "night", flux.alias("f"), err.alias("fe"))
    g = d.where("filter = 'gp'").select("star_id", "night", F.col("f").alias("y"), F.col("fe").alias("ye"))
    r = d.where("filter = 'rp'").select("star_id", "night", F.col("f").alias("x"), F.col("fe").alias("xe"))
    return g.join(r, ["star_id", "night"])


@query("source_colour_fit", with_views("valid", extra=SOURCE) + f"SELECT star_id, n, {r6('sl', 5)} AS slope, {r6('ic', 4)} AS blend_flux, {r6('CASE WHEN sl > 0 THEN -2.5e0*log10(sl) ELSE -99.999e0 END', 4)} AS colour FROM fit WHERE n > 2")
def source_colour_fit(t: Tables):
    fit = paired_fluxes(t).groupBy("star_id").agg(F.count("*").alias("n"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("blend")).where("n > 2")
    out = cal.source_colour(fit.withColumn("slope_err", F.lit(0.0)))
    return out.select("star_id", "n", settled("slope", 5).alias("slope"), settled("blend", 4).alias("blend_flux"), settled(p.with_sentinel("colour"), 4).alias("colour"))


@query("source_colour_fit_two_errors")
def source_colour_fit_two_errors(t: Tables):
    """The weighted form with errors in both bands, iterated as aggregates."""
    out = cal.source_colour(cal.line_with_two_errors(paired_fluxes(t), ["star_id"], "x", "y", "xe", "ye"))
    return out.select("star_id", "n", settled("slope", 4).alias("slope"), settled("intercept", 2).alias("blend_flux"), settled("slope_err", 4).alias("slope_err"), settled(p.with_sentinel("colour"), 3).alias("colour"))


@query("align_trios", with_views("valid", "images", extra="tr AS (SELECT image_id, fwhm FROM images WHERE fwhm <= 2e0), lq AS (SELECT image_id, arg_min(hjd, (seq, star_id, hjd, mag)) AS hjd, arg_min(mag, (seq, star_id, hjd, mag)) AS mag FROM valid WHERE filter = 'ip' GROUP BY image_id)")
    + f"SELECT image_id, {r6('coalesce(hjd, 9999999.999e0)')} AS hjd, {r6('coalesce(mag, 99.999e0)')} AS mag, {r6('coalesce(pow(1e1, (mag-27.4e0)/-2.5e0), 9999999.999e0)', 4)} AS flux FROM tr LEFT JOIN lq USING (image_id)")
def align_trios(t: Tables):
    """Light curve on the list of good images, sentinels where an image is missing."""
    trios = t.images.where("fwhm <= 2e0").select("image_id")
    one = pick_first(t.valid.where("filter = 'ip'"), ["image_id"], [F.col(c) for c in ("seq", "star_id", "hjd", "mag")], ["hjd", "mag", "mag_err"])
    out = lc.align_on_trios(trios, one, ["image_id"])
    big = F.lit(9999999.999)
    return out.select("image_id", settled(F.coalesce("hjd", big)).alias("hjd"), settled(F.coalesce("mag", F.lit(99.999))).alias("mag"), settled(F.coalesce("flux", big), 4).alias("flux"))


@query("source_lightcurve", with_views("phot", extra="mo AS (SELECT s_suppkey AS star_id, 18e0 + s_suppkey % 5 AS sm, 5e-2 AS se, 17e0 + s_suppkey % 3 AS bm, 3e-2 AS be FROM supplier)")
    + f"SELECT image_id, seq, star_id, {r6('CASE WHEN mag_err > 2e-3 THEN sm + mag - bm ELSE 99.99999e0 END')} AS source_lc, {r6('CASE WHEN mag_err > 2e-3 THEN sqrt(mag_err*mag_err+be*be+se*se) ELSE -9.9999e0 END')} AS source_lc_err FROM phot JOIN mo USING (star_id)")
def source_lightcurve(t: Tables):
    models = t.raw("supplier").select(
        F.col("s_suppkey").alias("star_id"), (F.lit(18.0) + F.col("s_suppkey") % 5).alias("source_mag"), F.lit(0.05).alias("source_err"),
        (F.lit(17.0) + F.col("s_suppkey") % 3).alias("base_mag"), F.lit(0.03).alias("base_err"),
    )
    marked = t.phot.withColumn("mag_err", F.when(F.col("mag_err") > 0.002, F.col("mag_err")).otherwise(F.lit(-9.999)))
    out = lc.source_lightcurve(marked, models, "star_id")
    return rounded(out, POINT, {"source_lc": "source_lc", "source_lc_err": "source_lc_err"})


CONE = sep_sql("ra", "dec", "267.079e0", "-29.95e0")


@query("extract_lightcurve", with_views("valid", "stars", extra=f"nr AS (SELECT star_id, {CONE} AS sep FROM stars WHERE {CONE} <= 0.5e0 ORDER BY sep, star_id LIMIT 1)")
    + f"SELECT star_id, image_id, seq, filter, {r6('hjd')} AS hjd, {r6('mag')} AS mag, {r6('mag_err')} AS mag_err FROM valid JOIN nr USING (star_id) WHERE mag_err <= 3e-2 AND pscale >= 8e-1 ORDER BY hjd")
def extract_lightcurve(t: Tables):
    """Nearest measured star to a position, usable points in time order."""
    out = lc.extract_lightcurve(t.valid, t.stars, 267.079, -29.95, 0.5, max_error=0.03, min_scale=0.8).orderBy("hjd", "image_id", "seq")
    return rounded(out, ["star_id", "image_id", "seq", "filter"], {"hjd": "hjd", "mag": "mag", "mag_err": "mag_err"})


@query("field_lightcurve", with_views("valid", "targets", "stars", extra=f"""h AS (SELECT l.target_id, r.star_id, {sep_sql('l.ra', 'l.dec', 'r.ra', 'r.dec')} AS sep FROM targets l, stars r WHERE abs(l.dec-r.dec) <= {TWO}),
    n AS (SELECT * FROM h WHERE sep <= {TWO} QUALIFY row_number() OVER (PARTITION BY target_id ORDER BY sep, star_id) = 1)""")
    + f"SELECT target_id, star_id, filter, count(*) AS n, {r6('min(hjd)')} AS first_hjd, {r6('max(hjd)')} AS last_hjd FROM valid JOIN n USING (star_id) WHERE mag_err <= 3e-2 AND pscale >= 8e-1 GROUP BY ALL")
def field_lightcurve(t: Tables):
    """Light curves of all targets in one pass, summarised per filter."""
    out = lc.extract_many(t.valid, t.stars, t.targets, 2 * ARCSEC, "target_id", max_error=0.03, min_scale=0.8)
    return out.groupBy("target_id", "star_id", "filter").agg(F.count("*").alias("n"), settled(F.min("hjd")).alias("first_hjd"), settled(F.max("hjd")).alias("last_hjd"))


@query("reference_photometry", with_views("valid", extra="q AS (SELECT star_id, filter, arg_min(mag, (mag_err, image_id, seq)) AS mag, min(mag_err) AS err FROM valid GROUP BY star_id, filter)")
    + f"SELECT star_id, " + ", ".join(f"{r6(f'''max(CASE WHEN filter = '{f}' THEN mag END)''')} AS {f[0]}_mag, {r6(f'''max(CASE WHEN filter = '{f}' THEN err END)''')} AS {f[0]}_err" for f in ("gp", "rp", "ip")) + " FROM q GROUP BY star_id")
def reference_photometry(t: Tables):
    """Best measurement of every star in g, r and i, in one scan."""
    best = pick_first(t.valid, ["star_id", "filter"], [F.col("mag_err"), F.col("image_id"), F.col("seq")], ["mag", "mag_err"])
    wide = best.groupBy("star_id").pivot("filter", ["gp", "rp", "ip"]).agg(F.first("mag").alias("mag"), F.first("mag_err").alias("err"))
    return rounded(wide, ["star_id"], {f"{f[0]}_{c}": f"{f}_{c}" for f in ("gp", "rp", "ip") for c in ("mag", "err")})


CLUMP = """bx AS (SELECT g, r, i FROM star_mags WHERE g > 0 AND r > 0 AND i > 0 AND i BETWEEN 13.5e0 AND 15e0 AND r-i BETWEEN 0e0 AND 8e-1),
    c AS (SELECT count(*) AS n, quantile_cont(g, 0.5) AS g, quantile_cont(r, 0.5) AS r, quantile_cont(i, 0.5) AS i, (quantile_cont(r-i, 0.75)-quantile_cont(r-i, 0.25))/2 AS e, quantile_cont(r-i, 0.5) AS ri, quantile_cont(g-r, 0.5) AS gr FROM bx)"""


@query("red_clump_offset", with_views("star_mags", extra=CLUMP) + f"""SELECT n, {r6('g - (1.331e0 + 5*log10(8e3) - 5)')} AS a_g, {r6('r - (0.552e0 + 5*log10(8e3) - 5)')} AS a_r, {r6('i - (0.262e0 + 5*log10(8e3) - 5)')} AS a_i, {r6('gr - (1.331e0-0.552e0)')} AS e_gr,
    {r6('ri - (0.552e0-0.262e0)')} AS e_ri, {r6('e')} AS ri_spread, {r6('(g - 0.59e0*gr - 0.01e0) - (0.97e0 + 5*log10(8e3) - 5)')} AS a_v FROM c""")
def red_clump_offset(t: Tables):
    """Median position of the clump box against the model at 8 kpc."""
    box = t.star_mags.where("g > 0 AND r > 0 AND i > 0").withColumn("ri", F.col("r") - F.col("i")).withColumn("gr", F.col("g") - F.col("r"))
    box = box.where(F.col("i").between(13.5, 15.0) & F.col("ri").between(0.0, 0.8))
    q = aggregate_with_quantiles(box, [], [F.count("*").alias("n")], {c: (c, [0.25, 0.5, 0.75]) for c in ("g", "r", "i", "ri", "gr")})

    def at(c: str, k: int = 1):
        return F.col(c)[k]

    def model(band: str):
        return stellar.red_clump_apparent(band, F.lit(8.0))

    rc = stellar.RED_CLUMP
    return q.select(
        "n", settled(at("g") - model("g")).alias("a_g"), settled(at("r") - model("r")).alias("a_r"), settled(at("i") - model("i")).alias("a_i"),
        settled(at("gr") - (rc["g"][0] - rc["r"][0])).alias("e_gr"), settled(at("ri") - (rc["r"][0] - rc["i"][0])).alias("e_ri"),
        settled((at("ri", 2) - at("ri", 0)) / 2).alias("ri_spread"), settled((at("g") - 0.59 * at("gr") - 0.01) - model("V")).alias("a_v"),
    )


AFF = """pq AS (SELECT s.star_id % 3 AS dataset, x, y, 1.001e0*x - 2e-3*y + 5 + (s.star_id % 7 - 3)/1e1 + CASE WHEN s.star_id % 50 = 0 THEN 40 ELSE 0 END AS u, 2e-3*x + 0.999e0*y - 3 + (s.star_id % 5 - 2)/1e1 AS v FROM star_pixels s)"""


def _plane(z: str) -> str:
    det = "(var_pop(x)*var_pop(y)-covar_pop(x,y)*covar_pop(x,y))"
    a = f"((covar_pop(x,{z})*var_pop(y)-covar_pop(y,{z})*covar_pop(x,y))/{det})"
    b = f"((covar_pop(y,{z})*var_pop(x)-covar_pop(x,{z})*covar_pop(x,y))/{det})"
    return f"{a} AS a{z}, {b} AS b{z}, avg({z}) - {a}*avg(x) - {b}*avg(y) AS c{z}"


AFF += f", a0 AS (SELECT dataset, count(*) AS n, {_plane('u')}, {_plane('v')} FROM pq GROUP BY dataset)" + "".join(
    f", a{i} AS (SELECT dataset, count(*) AS n, {_plane('u')}, {_plane('v')} FROM (SELECT pq.* FROM pq JOIN a{i-1} USING (dataset) WHERE sqrt(pow(au*x+bu*y+cu-u,2)+pow(av*x+bv*y+cv-v,2)) <= 2) GROUP BY dataset)" for i in (1, 2))


@query("affine_fit", with_views("star_pixels", extra=AFF) + f"SELECT dataset, n AS n_pairs, {r6('au')} AS a11, {r6('bu')} AS a12, {r6('cu', 4)} AS a13, {r6('av')} AS a21, {r6('bv')} AS a22, {r6('cv', 4)} AS a23 FROM a2")
def affine_fit(t: Tables):
    k, x, y = F.col("star_id"), F.col("x"), F.col("y")
    pairs = t.star_pixels.select(
        (k % 3).alias("dataset"), "x", "y", (F.lit(1.001) * x - F.lit(0.002) * y + 5 + (k % 7 - 3) / 10.0 + F.when(k % 50 == 0, 40).otherwise(0)).alias("u"),
        (F.lit(0.002) * x + F.lit(0.999) * y - 3 + (k % 5 - 2) / 10.0).alias("v"),
    )
    f = cal.affine_fit(pairs, ["dataset"], 2.0)
    return f.select("dataset", "n_pairs", *[settled(c).alias(c) for c in ("a11", "a12", "a21", "a22")], settled("a13", 4).alias("a13"), settled("a23", 4).alias("a23"))


INGEST = one_to_one_sql("m", "catalog2", "star_id", "stars", "star_id", TWO) + """,
    k AS (SELECT star_id, row_number() OVER (ORDER BY star_id) AS number FROM stars),
    p1 AS (SELECT 1 AS refimg_id, number AS star_id, image_id, arg_max(mag, (seq, mag)) AS mag FROM valid JOIN k USING (star_id) WHERE site = 'lsc-doma' AND filter = 'ip' GROUP BY number, image_id),
    p2 AS (SELECT 3 AS refimg_id, number AS star_id, image_id, arg_max(mag, (seq, mag)) AS mag FROM valid JOIN m ON valid.star_id + 10000000000 = m.lid JOIN k ON k.star_id = m.rid WHERE site = 'cpt-doma' AND filter = 'gp' GROUP BY number, image_id),
    p AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2)"""


@query("ingest_reference", with_views("catalog2", "valid", extra=INGEST)
    + f"""SELECT CASE refimg_id WHEN 1 THEN 'lsc-doma' ELSE 'cpt-doma' END AS facility_code, CASE refimg_id WHEN 1 THEN 'ip' ELSE 'gp' END AS filter_name, CASE refimg_id WHEN 1 THEN '1.0' ELSE '1.1' END AS version,
    refimg_id, CAST(CASE refimg_id WHEN 1 THEN 1 ELSE 3 END AS bigint) AS component_id, CAST(4 AS bigint) AS n_stamps, star_id, image_id, {r6('mag')} AS mag FROM p""")
def ingest_reference(t: Tables):
    """A primary and a second dataset into the stored database, the second twice with a better reference image; every attempt is repeated.

    Shown is the stored photometry that is in sight, with what the dimensions, components and stamps hold for it.
    """
    db = ingest.open_database(t.spark)
    sized = t.spark.createDataFrame([(900, 900)], "w int, h int")
    stamps = sized.select(F.inline(crossmatch.stamp_array("w", "h", 450, 450, 10)))
    columns = ["star_id", "image_id", "seq", "mag", "mag_err"]
    first = t.valid.where("site = 'lsc-doma' AND filter = 'ip'").select(*columns)
    second = t.valid.where("site = 'cpt-doma' AND filter = 'gp'").withColumn("star_id", F.col("star_id") + 10_000_000_000).select(*columns)
    for name, site, band, version, stars, phot, primary in [
        ("primary", "lsc-doma", "ip", "1.0", t.stars, first, True), ("second", "cpt-doma", "gp", "1.0", t.catalog2, second, False), ("second again", "cpt-doma", "gp", "1.1", t.catalog2, second, False),
    ]:
        params = {"facility_code": site, "filter_name": band, "code_name": "stage3", "version": version, "ref_filename": f"{name}.fits", "filename": f"{site}-{band}.fits"}
        for _ in range(2):
            ingest.ingest_reference(db, name, params, stars, phot, stamps, primary, 2 * ARCSEC)
    counts = ingest.live(db, "stamps").groupBy("refimg_id").agg(F.count("*").alias("n_stamps"))
    shown = ingest.live(db, "phot").join(db.read("reference_images"), "refimg_id").join(db.read("facilities"), "facility_id").join(db.read("filters"), "filter_id")
    shown = shown.join(db.read("software"), "code_id").join(ingest.live(db, "reference_components").select("component_id", "refimg_id"), "refimg_id").join(counts, "refimg_id")
    return shown.select("facility_code", "filter_name", "version", F.col("refimg_id").cast("int").alias("refimg_id"), "component_id", "n_stamps", "star_id", "image_id", settled("mag").alias("mag"))
