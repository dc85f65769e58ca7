"""Image and datapoint quality control, masks and selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import weights as w
from skyloom.functions.common import num, settled
from skyloom.operators import crossmatch, lightcurves, quality, stats
from skyloom.plans.base import Tables, query, r6, sep_sql, with_views
from skyloom.plans.expressions import SEXA_SQL, rounded, sexagesimal_texts
from skyloom.plans.matching import FULL_STAMPS
from skyloom.plans.statistics import IMAGE_RES_SQL, NIGHT_SQL, night
from skyloom.session import stored


@query("valid_measurement", with_views("phot") + f"""SELECT star_id, filter, count(*) AS n_rows, count(CASE WHEN mag > 0 AND mag_err > 0 AND qc = 0 THEN mag END) AS n_valid, {r6('avg(CASE WHEN mag > 0 AND mag_err > 0 AND qc = 0 THEN mag END)')} AS mean_mag
    FROM (SELECT *, CASE WHEN pscale > 1.3e0 THEN 4 ELSE 0 END AS qc FROM phot) GROUP BY star_id, filter""")
def valid_measurement(t: Tables):
    flagged = t.phot.withColumn("qc", F.when(F.col("pscale") > 1.3, 4).otherwise(0))
    clean = quality.null_invalid(flagged, ["mag", "mag_err"], qc="qc")
    return clean.groupBy("star_id", "filter").agg(F.count("*").alias("n_rows"), F.count("mag").alias("n_valid"), settled(F.avg("mag")).alias("mean_mag"))


ASSESS = """a AS (SELECT image_id, nstars, fwhm - 15e-1 AS sx, fwhm - 12e-1 AS sy, sky, image_id % 37 <> 0 AS ok FROM images),
    f AS (SELECT *, nstars = 0 AS c1, sx > 1.2e0 OR sy > 1.2e0 AS c2, sx < 0 OR sy < 0 AS c3, sky > 12000 AS c4, sky > 5000 AS c5, NOT ok AS c6 FROM a)"""


@query("assess_image", with_views("images", extra=ASSESS) + """SELECT image_id, CAST(NOT (c1 OR c2 OR c3 OR c4 OR c6) AS int) AS use_phot, CAST(NOT (c1 OR c2 OR c3 OR c5 OR c6) AS int) AS use_ref, CAST(NOT (c1 OR c3 OR c6) AS int) AS use_image,
    CASE WHEN c1 OR c2 OR c3 OR c4 OR c5 OR c6 THEN concat_ws(', ', CASE WHEN c1 THEN 'frame without stars' END, CASE WHEN c2 THEN 'FWHM above its limit' END, CASE WHEN c3 THEN 'FWHM below zero' END,
    CASE WHEN c4 THEN 'Sky too bright for photometry' END, CASE WHEN c5 THEN 'Sky too bright for a reference' END, CASE WHEN c6 THEN 'pointing off the target' END) ELSE 'OK' END AS report FROM f""")
def assess_image(t: Tables):
    d = t.images.select("image_id", "nstars", (F.col("fwhm") - 1.5).alias("sigma_x"), (F.col("fwhm") - 1.2).alias("sigma_y"), "sky", (F.col("image_id") % 37 != 0).alias("pointing_ok"))
    return quality.assess_images(d, quality.Limits(max_sigma=1.2)).select("image_id", "use_phot", "use_ref", "use_image", "report")


def _sexa(col: str, hours: bool) -> str:
    body = f"ltrim({col}, '+-')"
    v = f"(CAST(split_part({body}, ':', 1) AS double) + CAST(split_part({body}, ':', 2) AS double)/60 + CAST(split_part({body}, ':', 3) AS double)/3600)"
    return f"(15*{v})" if hours else f"(CASE WHEN {col}[1] = '-' THEN -{v} ELSE {v} END)"


@query("pointing_check", "WITH " + SEXA_SQL + """, b AS (SELECT image_id, CASE WHEN image_id % 13 = 0 THEN 'N/A' ELSE ra_text END AS cat_ra, dec_text AS cat_dec, ra_text AS ra,
    concat(dec_text[1:4], printf('%02d', (CAST(dec_text[5:6] AS int) + image_id % 12) % 60), dec_text[7:]) AS dec FROM tx)"""
    + f"SELECT image_id, cat_ra = 'N/A' OR {sep_sql(_sexa('cat_ra', True), _sexa('cat_dec', False), _sexa('ra', True), _sexa('dec', False))} <= 5e0/6e1 AS pointing_ok FROM b WHERE cat_ra <> 'N/A' UNION ALL SELECT image_id, TRUE FROM b WHERE cat_ra = 'N/A'")
def pointing_check(t: Tables):
    x = sexagesimal_texts(t)
    minutes = F.format_string("%02d", (F.substring("dec_text", 5, 2).cast("int") + F.col("image_id") % 12) % 60)
    b = x.select(
        "image_id", F.when(F.col("image_id") % 13 == 0, "N/A").otherwise(F.col("ra_text")).alias("cat_ra"), F.col("dec_text").alias("cat_dec"), F.col("ra_text").alias("ra"),
        F.concat(F.substring("dec_text", 1, 4), minutes, F.substring("dec_text", 7, 20)).alias("dec"),
    )
    return b.select("image_id", quality.pointing_ok("cat_ra", "cat_dec", "ra", "dec", 5.0 / 60.0).alias("pointing_ok"))


@query("shift_check", with_views("images") + "SELECT image_id, CAST(CASE WHEN nstars = 7 OR abs(fwhm*40 - 100) >= 100 OR abs(sky/1e2 - 1e2) >= 100 THEN -1 ELSE 0 END AS int) AS status FROM images")
def shift_check(t: Tables):
    d = t.images.select("image_id", F.when(F.col("nstars") != 7, F.col("fwhm") * 40 - 100).alias("dx"), (F.col("sky") / 100.0 - 100.0).alias("dy"))
    return d.select("image_id", quality.shift_status("dx", "dy").alias("status"))


@query("mask_statistics", with_views("pixels") + f"SELECT image_id, {r6('avg(CASE WHEN v > 250 THEN 1e2 ELSE 0e0 END)')} AS percent_bad, avg(CASE WHEN v > 250 THEN 1e2 ELSE 0e0 END) < 2 AS passes FROM pixels GROUP BY image_id")
def mask_statistics(t: Tables):
    masked = t.pixels.withColumn("mask", F.when(F.col("v") > 250, 1).otherwise(0))
    return rounded(quality.mask_statistics(masked, ["image_id"], "mask"), ["image_id", "passes"], {"percent_bad": "percent_bad"})


@query("status_value_check", """SELECT o_orderkey AS image_id, CAST(o_custkey % 5 - 1 AS int) AS use_phot FROM orders WHERE o_custkey % 5 - 1 NOT IN (0, 1)""")
def status_value_check(t: Tables):
    flags = t.raw("orders").select(F.col("o_orderkey").alias("image_id"), (F.col("o_custkey") % 5 - 1).cast("int").alias("use_phot"))
    return quality.unknown_flags(flags, "use_phot", [0, 1])


MOON = "CASE WHEN moon_fraction < 4e-1 THEN 'dark' WHEN moon_fraction > 4e-1 AND moon_fraction < 7e-1 AND moon_distance > 60 THEN 'gray' ELSE 'bright' END"


@query("moon_class", with_views("images") + f"SELECT image_id, {MOON} AS moon FROM images")
def moon_class(t: Tables):
    return t.images.select("image_id", quality.moon_class("moon_fraction", "moon_distance").alias("moon"))


RANK = f"""c AS (SELECT image_id % 50 AS dataset_id, image_id, nstars, fwhm, sky, {MOON} AS moon, 30e0 + nstars AS exposure FROM images),
    s AS (SELECT *, 1.47371235e9*pow(1e1, -0.4e0*19)*exposure AS sig FROM c),
    g AS (SELECT dataset_id, image_id, CASE WHEN nstars > 34 AND fwhm*8e-1 < 3 AND moon <> 'bright' AND dataset_id <> 3 THEN 0 ELSE 1 END AS tier, sig/sqrt(sig + pi()*8e-1*(0.67e0*fwhm)*(0.67e0*fwhm)*(sky + 1e2)) AS snr, nstars/sky AS alt FROM s),
    k AS (SELECT dataset_id, image_id, tier, CASE WHEN tier = 0 THEN snr ELSE alt END AS score FROM g),
    n AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY tier, score DESC, image_id) AS rank, min(tier) OVER (PARTITION BY dataset_id) AS best FROM k)"""


@query("reference_rank", with_views("images", extra=RANK) + f"SELECT dataset_id, image_id, CAST(rank AS int) AS rank, {r6('score')} AS score FROM n WHERE rank <= 3 AND tier = best AND (tier = 0 OR rank = 1)")
def reference_rank(t: Tables):
    """The three best candidates of each dataset; a dataset without candidates gets its fallback."""
    d = t.images.withColumn("dataset_id", F.col("image_id") % 50).withColumn("exposure", F.lit(30.0) + F.col("nstars"))
    d = d.withColumn("use_ref", F.when(F.col("dataset_id") == 3, 0).otherwise(1))
    out = quality.reference_rank(d, ["dataset_id"], "image_id", 3, 0.8, 1.0, 10.0)
    return out.select("dataset_id", "image_id", "rank", settled("score").alias("score"))


@query("sort_with_defaults", with_views("images") + f"""SELECT o_orderkey AS image_id, {r6('coalesce(fwhm, -1e0)')} AS fwhm, {r6('coalesce(sky, -1e0)')} AS sky, coalesce(nstars, 0) AS nstars FROM orders LEFT JOIN (SELECT * FROM images WHERE nstars > 10) i ON i.image_id = o_orderkey""")
def sort_with_defaults(t: Tables):
    out = quality.sort_with_defaults(t.images, t.images.where("nstars > 10"), "image_id", ["fwhm", "sky"], "nstars")
    return rounded(out, ["image_id", "nstars"], {"fwhm": "fwhm", "sky": "sky"})


@query("star_selection", with_views("star_mags", "stars") + """SELECT star_id, gaia_source_id FROM star_mags JOIN stars USING (star_id) WHERE g > 0 AND r > 0 AND i > 0 AND g_err <= 3e-2 AND r_err <= 2e-2 AND i_err <= 1e-2
    AND sqrt(g_err*g_err+i_err*i_err) <= 32e-3 AND sqrt(g_err*g_err+r_err*r_err) <= 35e-3 AND sqrt(r_err*r_err+i_err*i_err) <= 25e-3 AND """
    + sep_sql("ra", "dec", "267.5e0", "-29.5e0") + " < 0.4e0 AND gaia_source_id <> 'None' AND (star_id % 100)/1e1 BETWEEN 1e0 AND 8e0 AND (star_id % 77)/1e1 BETWEEN 0e0 AND 6e0")
def star_selection(t: Tables):
    """All cuts of the definition, also the g and r limits and the proper-motion range."""
    d = t.star_mags.join(t.stars, "star_id").withColumn("parallax", (F.col("star_id") % 100) / 10.0).withColumn("pm", (F.col("star_id") % 77) / 10.0)
    out = lightcurves.select_stars(d, {"g": 0.03, "r": 0.02, "i": 0.01, "gi": 0.032, "gr": 0.035, "ri": 0.025}, (267.5, -29.5, 0.4), (1.0, 8.0), (0.0, 6.0))
    return out.select("star_id", "gaia_source_id")


@query("magnitude_colour_box", with_views("star_mags") + f"SELECT star_id, {r6('i')} AS i, {r6('r-i')} AS ri FROM star_mags WHERE r > 0 AND i > 0 AND i BETWEEN 14e0 AND 15e0 AND r-i BETWEEN 0e0 AND 5e-1")
def magnitude_colour_box(t: Tables):
    d = t.star_mags.where("r > 0 AND i > 0").withColumn("ri", F.col("r") - F.col("i"))
    box = d.where(F.col("i").between(14.0, 15.0) & F.col("ri").between(0.0, 0.5))
    return rounded(box, ["star_id"], {"i": "i", "ri": "ri"})


@query("invalid_to_null", with_views("stars", "star_mags") + f"""SELECT s.star_id, coalesce(CASE WHEN s.gaia_source_id <> 'None' THEN s.gaia_source_id END, 'None') AS gaia_id, {r6('coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, -9999.999e0)')} AS gaia_flux,
    {r6('coalesce(nullif(g, 0e0), -9999.999e0)')} AS g FROM stars s LEFT JOIN customer ON c_custkey = s.star_id LEFT JOIN star_mags m ON m.star_id = s.star_id""")
def invalid_to_null(t: Tables):
    """Catalogue rows attached to the detections: null inside, the sentinel only in the output."""
    gaia = t.raw("customer").select(F.col("c_custkey").alias("star_id"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).otherwise(num(float("nan"))).alias("flux"))
    survey = t.star_mags.select("star_id", F.when(F.col("g") > 0, F.col("g")).alias("g"))
    d = t.stars.join(gaia, "star_id", "left").join(survey, "star_id", "left")
    flux = F.when(~F.isnan("flux"), F.col("flux"))
    return d.select("star_id", F.col("gaia_source_id").alias("gaia_id"), settled(F.coalesce(flux, num(-9999.999))).alias("gaia_flux"), settled(F.coalesce("g", num(-9999.999))).alias("g"))


QC_SQL = IMAGE_RES_SQL + ", ex AS (SELECT image_id, 30e0 + nstars AS exposure, fwhm*nstars > 700 AS warped, sky FROM images), " + FULL_STAMPS + """,
    sst AS (SELECT star_id, max(stamp_id) AS stamp_id FROM star_pixels s, st WHERE s.x >= x_min AND s.x < x_max AND s.y >= y_min AND s.y < y_max GROUP BY star_id)"""
QC_FLAG = """CAST((CASE WHEN mag > 0 AND mag_err > 0 THEN 0 ELSE 1 END) | (CASE WHEN abs(mr) > 15e-2 THEN 2 ELSE 0 END) | (CASE WHEN pscale*1e2/exposure < 7e-1 THEN 4 ELSE 0 END) | (CASE WHEN warped THEN 8 ELSE 0 END)
    | (CASE WHEN sky*(1 + stamp_id/16e0) > 40000 THEN 16 ELSE 0 END) AS int)"""


def qc_inputs(t: Tables):
    images = t.images.select("image_id", (F.lit(30.0) + F.col("nstars")).alias("exposure"), F.when(F.col("fwhm") * F.col("nstars") > 700, F.array(num(1.0), num(0.0), num(150.0))).otherwise(F.array(num(1.0), num(0.0), num(3.0))).alias("warp"))
    stamped = t.images.select("image_id", "sky", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("stamp_id"))
    bad = stamped.where(F.col("sky") * (1 + F.col("stamp_id") / 16.0) > 40000)
    size = t.star_pixels.agg((F.ceil(F.max("x") / 1024) * 1024).alias("w"), (F.ceil(F.max("y") / 1024) * 1024).alias("h"))
    stamps = size.select(F.inline(crossmatch.stamp_array("w", "h", 1010, 1010, 10)))
    return images, bad, crossmatch.assign_stamps(t.star_pixels, stamps)


def flagged(t: Tables):
    images, bad, star_stamps = qc_inputs(t)
    return quality.qc_bitmask(
        t.phot.withColumn("night", night()), images, bad, star_stamps, star=["star_id", "filter"], residual_image=["night"], reference_exposure=100.0
    )


@query("qc_bitmask", with_views("valid", "images", "star_pixels", extra=QC_SQL) + f"""SELECT p.image_id, p.seq, p.star_id, {QC_FLAG} AS qc_flag FROM (SELECT *, {NIGHT_SQL} FROM phot) p
    LEFT JOIN nm USING (night) JOIN ex USING (image_id) JOIN sst USING (star_id)""")
def qc_bitmask(t: Tables):
    return flagged(t).select("image_id", "seq", "star_id", "qc_flag")


@query("ps_quality", with_views("phot", "images") + f"SELECT image_id, seq, star_id, {r6('pscale*1e2/(30e0 + nstars)')} AS ps_per_exposure FROM phot JOIN images USING (image_id)")
def ps_quality(t: Tables):
    d = t.phot.join(t.images.select("image_id", (F.lit(30.0) + F.col("nstars")).alias("exposure")), "image_id")
    return rounded(d, ["image_id", "seq", "star_id"], {"ps_per_exposure": quality.scale_per_exposure("pscale", "exposure", 100.0)})


@query("image_correction", with_views("valid", extra=IMAGE_RES_SQL + f""", nr AS (SELECT night, any_value(mr) AS mr, sqrt(sum((residual-mr)*(residual-mr)/(residual_err*residual_err))/sum(1/(residual_err*residual_err))) AS rms
    FROM (SELECT *, {NIGHT_SQL} FROM res) JOIN nm USING (night) GROUP BY night)""")
    + f"""SELECT image_id, seq, star_id, {r6('mag-mr')} AS corr_mag, {r6('sqrt(mag_err*mag_err+rms*rms)', 4)} AS corr_mag_err,
    CAST(mag_err > pow(1e1, 0.232444e0*wm - 5.0562e0 + 0.310577e0) AS int) AS error_flag FROM (SELECT *, {NIGHT_SQL} FROM valid) JOIN nr USING (night) JOIN m USING (star_id, filter)""")
def image_correction(t: Tables):
    keys = ["star_id", "filter"]
    rows = t.valid.withColumn("night", night())
    per_image = stats.image_residuals(stats.residuals(rows, keys), ["night"])
    corrected = quality.correct_by_image(rows, per_image, ["night"])
    means = t.valid.groupBy(*keys).agg(w.weighted_mean("mag", "mag_err").alias("wmean"))
    out = quality.flag_large_errors(corrected, means, keys)
    return out.select("image_id", "seq", "star_id", settled("corr_mag").alias("corr_mag"), settled("corr_mag_err", 4).alias("corr_mag_err"), "error_flag")


@query("pixel_bitmask", with_views("pixels", extra="k AS (SELECT *, CAST((CASE WHEN v > 200 THEN 16 ELSE 0 END) | (CASE WHEN v < -200 THEN 8 ELSE 0 END) | (CASE WHEN x = 0 THEN 4 ELSE 0 END) | (CASE WHEN y = 0 THEN 2 ELSE 0 END) | (CASE WHEN abs(v) < 10 THEN 1 ELSE 0 END) AS int) AS code FROM pixels)")
    + "SELECT image_id, x, y, code, CAST((code >> 4) & 1 AS int) AS saturated, CAST((code >> 3) & 1 AS int) AS low, CAST(code & 1 AS int) AS last FROM k")
def pixel_bitmask(t: Tables):
    v = F.col("v")
    code = quality.combine_masks([v > 200, v < -200, F.col("x") == 0, F.col("y") == 0, F.abs(v) < 10])
    d = t.pixels.withColumn("code", code.cast("int"))
    saturated, low, _, _, last = quality.split_masks("code", 5)
    return d.select("image_id", "x", "y", "code", saturated.alias("saturated"), low.alias("low"), last.alias("last"))


def clip_sql(name: str, rows: str, keys: str, value: str, nsigma: str, rounds: int) -> str:
    """Clipped means and deviations as a chain of CTEs; the last one is ``name``."""
    parts = [f"{name}_0 AS (SELECT {keys}, avg({value}) AS mu, stddev_pop({value}) AS sd FROM {rows} GROUP BY {keys})"]
    parts += [f"{name}_{i} AS (SELECT {keys}, avg({value}) AS mu, stddev_pop({value}) AS sd FROM {rows} JOIN {name}_{i-1} USING ({keys}) WHERE abs({value}-mu) <= {nsigma}*sd GROUP BY {keys})" for i in range(1, rounds + 1)]
    return ", ".join([*parts, f"{name} AS (SELECT * FROM {name}_{rounds})"])


# raw values as four amplifiers with gains of their own read them
RAW_SQL = """raw AS (SELECT image_id, x, y, CAST(x >= 4 AS int) AS rt, CAST(y >= 4 AS int) AS up, (v + 1e3)*CASE WHEN x >= 4 AND y >= 4 THEN 8e-1 WHEN x >= 4 THEN 13e-1 WHEN y >= 4 THEN 11e-1 ELSE 1e0 END AS v FROM pixels)"""
BAD_SQL = RAW_SQL + ", rp AS (SELECT * FROM raw WHERE v > 0), " + clip_sql("q", "rp", "image_id, rt, up", "v", "3e0", 3) + """,
    gn AS (SELECT image_id, up, max(mu) FILTER (WHERE rt = 0)/max(mu) FILTER (WHERE rt = 1) AS g FROM q GROUP BY image_id, up),
    l1 AS (SELECT image_id, x, y, up, v*CASE WHEN rt = 1 THEN g ELSE 1e0 END AS v, CASE WHEN rt = 1 THEN g ELSE 1e0 END AS g FROM raw JOIN gn USING (image_id, up)), """ + clip_sql("h", "l1", "image_id, up", "v", "3e0", 3) + """,
    lf AS (SELECT image_id, max(mu) FILTER (WHERE up = 0)/max(mu) FILTER (WHERE up = 1) AS f FROM h GROUP BY image_id),
    lv AS (SELECT image_id, x, y, v*CASE WHEN up = 1 THEN f ELSE 1e0 END AS v, g*CASE WHEN up = 1 THEN f ELSE 1e0 END AS gain FROM l1 JOIN lf USING (image_id)), """ + clip_sql("c", "lv", "image_id", "v", "15e-1", 2) + """,
    b AS (SELECT image_id, x, y, gain, CAST(abs(v-mu) > 15e-1*sd AS int) AS bad FROM lv JOIN c USING (image_id)),
    o AS (SELECT image_id, y FROM b GROUP BY image_id, y HAVING quantile_cont(bad, 0.5) = 1)"""


@query("bad_pixel_threshold", with_views("pixels", extra=BAD_SQL) + f"SELECT image_id, x, y, {r6('gain')} AS gain, bad, CAST(o.y IS NOT NULL AS int) AS overscan FROM b LEFT JOIN o USING (image_id, y)")
def bad_pixel_threshold(t: Tables):
    """Bad pixels of images whose four amplifiers differ in gain, after the quadrants have been levelled."""
    right, upper = F.col("x") >= 4, F.col("y") >= 4
    gain = F.when(right & upper, num(0.8)).when(right, num(1.3)).when(upper, num(1.1)).otherwise(num(1.0))
    raw = t.pixels.select("image_id", "x", "y", ((F.col("v") + 1000.0) * gain).alias("v"))
    bad = stored(quality.bad_pixels(quality.level_quadrants(raw, ["image_id"], "v", 4, 4), ["image_id"], "v", 1.5, 2))
    rows = quality.overscan_rows(bad, "image_id", "y", "bad").withColumn("overscan", F.lit(1))
    return bad.join(rows, ["image_id", "y"], "left").select("image_id", "x", "y", settled("gain").alias("gain"), "bad", F.coalesce("overscan", F.lit(0)).alias("overscan"))


@query("matrix_columns", "SELECT vec_id AS image_id, list_max(embedding) > 25e-2 AS warped, CAST(len(list_filter(embedding, lambda c: c > 25e-2)) AS int) AS n_large, " + r6("CAST(embedding[1] AS double)") + " AS m00 FROM embeddings")
def matrix_columns(t: Tables):
    """A stored matrix as one array column; coefficients above a limit."""
    e = t.raw("embeddings").select(F.col("vec_id").alias("image_id"), F.col("embedding").cast("array<double>").alias("warp"))
    return e.select("image_id", quality.warp_outlier("warp", 0.25).alias("warped"), F.size(F.filter("warp", lambda c: c > 0.25)).alias("n_large"), settled(F.col("warp")[0]).alias("m00"))
