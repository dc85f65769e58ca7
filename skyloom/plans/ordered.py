"""Operators that depend on an order: trios, runs, ranks, samples, central region."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions.common import settled
from skyloom.operators import sequences as seq
from skyloom.operators.ordering import contiguous_runs as runs, with_group_index
from skyloom.operators.skew import pick_first
from skyloom.plans.base import Tables, query, r6, with_views
from skyloom.plans.expressions import rounded

TRIO = """i AS (SELECT image_id, concat('lsc1m0-fa15-', 20240000 + image_id // 100, '-', printf('%04d', image_id % 100), '-e91') AS name, CASE image_id % 4 WHEN 0 THEN 'g' WHEN 1 THEN 'r' ELSE 'i' END AS f, fwhm, sky FROM images),
    p AS (SELECT *, CAST(split_part(name, '-', 3) AS bigint) AS d, CAST(split_part(name, '-', 4) AS bigint) AS n, fwhm <= 35e-1 AND sky <= 20000 AS ok FROM i),
    w AS (SELECT *, lead(name) OVER o AS n1, lead(name, 2) OVER o AS n2, lead(d) OVER o AS d1, lead(d, 2) OVER o AS d2, lead(n) OVER o AS m1, lead(n, 2) OVER o AS m2, lead(f) OVER o AS f1, lead(f, 2) OVER o AS f2, lead(ok) OVER o AS k1, lead(ok, 2) OVER o AS k2 FROM p WINDOW o AS (ORDER BY name)),
    z AS (SELECT * FROM w WHERE d = d1 AND d1 = d2 AND m1 = n+1 AND m2 = n+2 AND f <> f1 AND f <> f2 AND f1 <> f2 AND ok AND k1 AND k2)"""


def pick(f: str) -> str:
    return f"CASE '{f}' WHEN f THEN name WHEN f1 THEN n1 ELSE n2 END"


@query("image_trios", with_views("images", extra=TRIO) + f"SELECT {pick('g')} AS g_image, {pick('r')} AS r_image, {pick('i')} AS i_image FROM z")
def image_trios(t: Tables):
    k = F.col("image_id")
    name = F.concat(F.lit("lsc1m0-fa15-"), 20240000 + F.floor(k / 100), F.lit("-"), F.format_string("%04d", k % 100), F.lit("-e91"))
    d = t.images.select(name.alias("name"), F.when(k % 4 == 0, "g").when(k % 4 == 1, "r").otherwise("i").alias("filter"), F.col("fwhm").alias("fwhm_x"), F.col("fwhm").alias("fwhm_y"), "sky")
    return seq.image_trios(d, 3.5, 20000.0)


@query("contiguous_runs", with_views("pixels", extra="""c AS (SELECT image_id, x, count(*) AS n FROM pixels WHERE v > 100 GROUP BY image_id, x HAVING count(*) > 1),
    g AS (SELECT *, x - row_number() OVER (PARTITION BY image_id ORDER BY x) AS k FROM c)""") + "SELECT image_id, min(x) AS first, max(x) AS last, count(*) AS length FROM g GROUP BY image_id, k")
def contiguous_runs(t: Tables):
    """Regions of neighbouring columns with more than one bright pixel."""
    columns = t.pixels.where("v > 100").groupBy("image_id", "x").agg(F.count("*").alias("n")).where("n > 1")
    return runs(columns, ["image_id"], "x")


@query("rank_top_n", with_views("star_pixels", extra="r AS (SELECT star_id, flux, row_number() OVER (ORDER BY flux DESC, star_id) - 1 AS k, count(*) OVER () AS n FROM star_pixels)")
    + f"SELECT star_id, k AS brightness_rank, {r6('flux')} AS flux FROM r WHERE k >= floor(n*0.66e0) AND k < floor(n*0.98e0)")
def rank_top_n(t: Tables):
    """The slice of the catalogue between 66 and 98 percent in brightness rank."""
    out = seq.rank_slice(t.star_pixels, [F.col("flux").desc(), F.col("star_id")], 0.66, 0.98)
    return out.select("star_id", F.col("idx").alias("brightness_rank"), settled("flux").alias("flux"))


@query("top_n_per_group", with_views("valid") + f"""SELECT star_id, filter, image_id, seq, {r6('mag')} AS mag, row_number() OVER (PARTITION BY star_id, filter ORDER BY mag, image_id, seq) AS rank FROM valid
    QUALIFY rank <= 3""")
def top_n_per_group(t: Tables):
    """The three brightest measurements of every star and filter."""
    out = seq.top_per_group(t.valid, ["star_id", "filter"], [F.col("mag"), F.col("image_id"), F.col("seq")], 3)
    return rounded(out, ["star_id", "filter", "image_id", "seq", "rank"], {"mag": "mag"})


@query("dedupe_window", with_views("valid") + f"SELECT star_id, filter, image_id, seq, {r6('mag_err')} AS mag_err FROM valid QUALIFY row_number() OVER (PARTITION BY star_id, filter ORDER BY mag_err, image_id, seq) = 1")
def dedupe_window(t: Tables):
    """Best measurement per star and filter, as an aggregate that combines before the shuffle."""
    out = pick_first(t.valid.select("star_id", "filter", "image_id", "seq", "mag_err"), ["star_id", "filter"], [F.col("mag_err"), F.col("image_id"), F.col("seq")])
    return rounded(out, ["star_id", "filter", "image_id", "seq"], {"mag_err": "mag_err"})


@query("time_order", with_views("valid") + f"SELECT star_id, filter, image_id, seq, {r6('hjd')} AS hjd, row_number() OVER (PARTITION BY star_id, filter ORDER BY hjd, image_id, seq) - 1 AS point FROM valid")
def time_order(t: Tables):
    """Datasets of one filter joined and numbered in time."""
    d = with_group_index(t.valid.select("star_id", "filter", "image_id", "seq", "hjd"), ["star_id", "filter"], ["hjd", "image_id", "seq"], "point")
    return rounded(d, ["star_id", "filter", "image_id", "seq", "point"], {"hjd": "hjd"})


@query("random_star_sample", with_views("stars") + "SELECT star_id, gaia_source_id FROM stars WHERE gaia_source_id <> 'None' ORDER BY md5(concat('42:', CAST(star_id AS varchar))), star_id LIMIT 500")
def random_star_sample(t: Tables):
    """Reproducible sample of 500 stars that have a catalogue id."""
    return seq.hash_sample(t.stars.where("gaia_source_id != 'None'").select("star_id", "gaia_source_id"), "star_id", 500, seed=42)


@query("central_region", with_views("detections", extra="""m AS (SELECT image_id, avg(x) AS cx, avg(y) AS cy FROM detections GROUP BY image_id), k AS (SELECT CAST(s AS int) AS box, s*200 AS half FROM range(1, 11) t(s)),
    c AS (SELECT image_id, box, half, count(*) FILTER (WHERE abs(x-cx) <= half AND abs(y-cy) <= half) AS n FROM detections JOIN m USING (image_id), k GROUP BY image_id, box, half),
    b AS (SELECT image_id, box, half FROM c QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY greatest(100 - n, n - 1000, 0), box) = 1)""")
    + f"SELECT image_id, star_id, box, {r6('flux')} AS flux FROM detections JOIN m USING (image_id) JOIN b USING (image_id) WHERE abs(x-cx) <= half AND abs(y-cy) <= half")
def central_region(t: Tables):
    """Smallest central box of every image that holds 100 to 1000 stars."""
    out = seq.central_region(t.detections, [200.0 * n for n in range(1, 11)], 100, 1000, ("image_id",))
    return out.select("image_id", "star_id", "box", settled("flux").alias("flux"))


ISO = """iso AS (SELECT p_partkey AS row_id, 1e8 + (p_partkey % 30)*1e8 AS age, 8e-1 + (p_partkey % 40)/2e1 AS mass, 3.5e0 + (p_partkey % 11)/2e1 AS log_teff, 1e0 + (p_partkey % 50)/1e1 AS logg, (p_partkey % 83)/5e1 AS gr, (p_partkey % 61)/5e1 AS ri FROM part),
    tg AS (SELECT c_custkey AS target_id, (c_custkey % 79)/5e1 + 3e-3 AS gr, (c_custkey % 53)/5e1 - 2e-3 AS ri FROM customer),
    u AS (SELECT DISTINCT gr, ri FROM tg), dd AS (SELECT u.gr, u.ri, mass, pow(1e1, log_teff) AS teff, logg, sqrt((iso.gr-u.gr)*(iso.gr-u.gr)+(iso.ri-u.ri)*(iso.ri-u.ri)) AS d FROM u, iso WHERE age > 1e8),
    mn AS (SELECT gr, ri, min(d) AS dm FROM dd GROUP BY gr, ri), s AS (SELECT dd.* FROM dd JOIN mn USING (gr, ri) WHERE d <= dm + 1e-2),
    o AS (SELECT gr, ri, count(*) AS n, quantile_cont(mass, 0.5) AS mass, (quantile_cont(mass, 0.75)-quantile_cont(mass, 0.25))/2 AS me, quantile_cont(teff, 0.5) AS teff, greatest((quantile_cont(teff, 0.75)-quantile_cont(teff, 0.25))/2, 50e0) AS te,
    quantile_cont(logg, 0.5) AS logg FROM s GROUP BY gr, ri)"""


@query("nearest_isochrone", "WITH " + ISO + f"SELECT target_id, n, {r6('mass')} AS mass, {r6('me')} AS mass_err, {r6('teff', 3)} AS teff, {r6('te', 3)} AS teff_err, {r6('logg')} AS logg FROM tg JOIN o USING (gr, ri)")
def nearest_isochrone(t: Tables):
    k = F.col("p_partkey")
    iso = t.raw("part").select(
        (F.lit(1e8) + (k % 30) * 1e8).alias("age"), (F.lit(0.8) + (k % 40) / 20.0).alias("mass"), (F.lit(3.5) + (k % 11) / 20.0).alias("log_teff"),
        (F.lit(1.0) + (k % 50) / 10.0).alias("logg"), ((k % 83) / 50.0).alias("gr"), ((k % 61) / 50.0).alias("ri"),
    )
    c = F.col("c_custkey")
    targets = t.raw("customer").select(c.alias("target_id"), ((c % 79) / 50.0 + 0.003).alias("gr"), ((c % 53) / 50.0 - 0.002).alias("ri"))
    out = seq.nearest_isochrone(targets, iso, "target_id", 0.01, min_age=1e8)
    return out.select(
        "target_id", "n", settled("mass").alias("mass"), settled("mass_err").alias("mass_err"), settled("teff", 3).alias("teff"), settled("teff_err", 3).alias("teff_err"), settled("logg").alias("logg")
    )
