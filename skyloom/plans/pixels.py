"""Operators on pixel tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions.common import settled
from skyloom.operators import pixels as px, stats
from skyloom.operators.stats import attach_row, joint_information
from skyloom.plans.base import Tables, query, r6, with_views
from skyloom.plans.expressions import rounded


@query("pixel_stack", with_views("pixels") + f"""SELECT x, y, count(*) AS n, {r6('avg(v)')} AS mean, {r6('quantile_cont(v, 0.5)')} AS median,
    {r6('sum(v/greatest(abs(v), 1e-9))/sum(1/greatest(abs(v), 1e-9))', 4)} AS weighted_mean FROM pixels GROUP BY x, y""")
def pixel_stack(t: Tables):
    out = px.stack(t.pixels)
    return out.select("x", "y", "n", settled("mean").alias("mean"), settled("median").alias("median"), settled("weighted_mean", 4).alias("weighted_mean"))


@query("weighted_centroid", with_views("pixels", extra="w AS (SELECT image_id, x, y, abs(v) + 1 AS v FROM pixels), m AS (SELECT image_id, sum(x*v)/sum(v) AS mx, sum(y*v)/sum(v) AS my, sum(x*x*v)/sum(v) AS xx, sum(y*y*v)/sum(v) AS yy FROM w GROUP BY image_id)")
    + f"SELECT image_id, {r6('mx')} AS mu_x, {r6('my')} AS mu_y, {r6('sqrt(xx-mx*mx)')} AS sigma_x, {r6('sqrt(yy-my*my)')} AS sigma_y, {r6('sqrt((xx-mx*mx+yy-my*my)/2)')} AS sigma_rms FROM m")
def weighted_centroid(t: Tables):
    w = t.pixels.withColumn("v", F.abs("v") + 1)
    return rounded(px.moments(w, ["image_id"]), ["image_id"], {c: c for c in ("mu_x", "mu_y", "sigma_x", "sigma_y", "sigma_rms")})


REF_SQL = "ref AS (SELECT x, y, avg(v) AS rv FROM pixels GROUP BY x, y), b AS (SELECT image_id, x, y, v, rv FROM pixels JOIN ref USING (x, y))"


def mean_image(t: Tables):
    return t.pixels.groupBy("x", "y").agg(F.avg("v").alias("v"))


@query("pixel_correlation", with_views("pixels", extra=REF_SQL + """, h AS (SELECT image_id, v > 0 AS p, rv > 0 AS q, count(*) AS c FROM b GROUP BY ALL), hx AS (SELECT image_id, p, sum(c) AS cx FROM h GROUP BY ALL),
    hy AS (SELECT image_id, q, sum(c) AS cy FROM h GROUP BY ALL), hn AS (SELECT image_id, sum(c) AS n FROM h GROUP BY ALL),
    mi AS (SELECT image_id, sum(c/n*ln(c*n/(cx*cy))) AS mi FROM h JOIN hx USING (image_id, p) JOIN hy USING (image_id, q) JOIN hn USING (image_id) GROUP BY image_id), co AS (SELECT image_id, corr(v, rv) AS r FROM b GROUP BY image_id)""")
    + f"SELECT image_id, {r6('r')} AS correlation, {r6('mi')} AS mutual_information FROM co JOIN mi USING (image_id)")
def pixel_correlation(t: Tables):
    """Each image against the mean image."""
    ref = mean_image(t)
    cut = px.with_reference(t.pixels, ref).select("image_id", (F.col("v") > 0).alias("p"), (F.col("ref") > 0).alias("q"))
    out = px.correlation(t.pixels, ref).join(joint_information(cut, ["image_id"], "p", "q"), "image_id")
    return rounded(out, ["image_id"], {"correlation": "correlation", "mutual_information": "mutual_information"})


@query("pixel_outlier_mask", with_views("pixels", extra=REF_SQL + """, f AS (SELECT image_id, regr_slope(v, rv) AS a, regr_intercept(v, rv) AS c FROM b WHERE rv > 0 GROUP BY image_id),
    d AS (SELECT image_id, x, y, rv*a + c - v AS d FROM b JOIN f USING (image_id)), s AS (SELECT image_id, stddev_pop(d) AS s FROM d GROUP BY image_id)""")
    + "SELECT x, y, count(*) FILTER (WHERE abs(d) > 25e-1*s) AS n_outliers, bool_or(abs(d) > 25e-1*s) AS masked FROM d JOIN s USING (image_id) GROUP BY x, y")
def pixel_outlier_mask(t: Tables):
    return px.outlier_mask(t.pixels, mean_image(t), 2.5)


@query("pixel_crop", with_views("pixels") + f"SELECT image_id, CAST(x - greatest(CAST(image_id % 8 AS int) - 2, 0) AS int) AS x, CAST(y - 1 AS int) AS y, {r6('v')} AS v FROM pixels WHERE x >= image_id % 8 - 2 AND x < least(image_id % 8 + 2, 8) AND y >= 1 AND y < 5")
def pixel_crop(t: Tables):
    out = px.crop(t.pixels, (F.col("image_id") % 8).cast("int"), 3, 4, 4, 8, 8)
    return rounded(out, ["image_id", "x", "y"], {"v": "v"})


@query("stamp_statistics", with_views("pixels", extra="i AS (SELECT DISTINCT image_id FROM pixels), g AS (SELECT image_id, CAST(s AS int) AS stamp_id FROM i, range(0, 5) t(s)), f AS (SELECT image_id, CAST((y // 4)*2 + x // 4 AS int) AS stamp_id, quantile_cont(v, 0.5) AS med, stddev_pop(v) AS sd FROM pixels GROUP BY ALL)")
    + f"SELECT image_id, stamp_id, {r6('coalesce(med, -99e0)')} AS median, {r6('coalesce(sd, 15e3)')} AS std FROM g LEFT JOIN f USING (image_id, stamp_id)")
def stamp_statistics(t: Tables):
    """Four quarter stamps and one that no pixel falls into."""
    stamp = (F.floor(F.col("y") / 4) * 2 + F.floor(F.col("x") / 4)).cast("int")
    out = px.stamp_statistics(t.pixels, t.raw("embeddings").select(F.col("vec_id").alias("image_id")), 5, stamp, 1500.0)
    return rounded(out, ["image_id", "stamp_id"], {"median": "median", "std": "std"})


@query("saturated_fraction", with_views("pixels", extra="k AS (SELECT image_id, CAST(x // 4 AS bigint) AS bx, CAST(y // 4 AS bigint) AS by_, count(*) FILTER (WHERE v >= 150) AS n_saturated, avg(CASE WHEN v >= 150 THEN 1e0 ELSE 0e0 END) AS fr FROM pixels GROUP BY ALL)")
    + f"SELECT image_id, bx, by_ AS \"by\", n_saturated, {r6('fr')} AS fraction, row_number() OVER (PARTITION BY image_id ORDER BY n_saturated, bx, by_) = 1 AS best FROM k")
def saturated_fraction(t: Tables):
    return rounded(px.saturated_blocks(t.pixels, 4, 150.0), ["image_id", "bx", "by", "n_saturated", "best"], {"fraction": "fraction"})


@query("cumulative_radius", with_views("pixels") + f"SELECT image_id, {r6('min(sqrt((x-35e-1)*(x-35e-1)+(y-35e-1)*(y-35e-1)))')} AS mask_radius FROM pixels WHERE v < 300 AND v < -50 GROUP BY image_id")
def cumulative_radius(t: Tables):
    r = F.sqrt((F.col("x") - 3.5) * (F.col("x") - 3.5) + (F.col("y") - 3.5) * (F.col("y") - 3.5))
    out = px.mask_radius(t.pixels.withColumn("r", r), ["image_id"], "r", "v", 300.0, -50.0)
    return rounded(out, ["image_id"], {"mask_radius": "mask_radius"})


@query("connected_pixels", "WITH RECURSIVE " + with_views("pixels")[5:].rstrip() + """, s AS (SELECT image_id, x, y, y*8 + x AS id FROM pixels WHERE v > 120),
    r AS (SELECT image_id, id, id AS label FROM s UNION SELECT r.image_id, b.id, r.label FROM r JOIN s a ON a.image_id = r.image_id AND a.id = r.id JOIN s b ON b.image_id = a.image_id AND abs(a.x-b.x) <= 1 AND abs(a.y-b.y) <= 1),
    l AS (SELECT image_id, id, min(label) AS label FROM r GROUP BY image_id, id)
    SELECT image_id, CAST(label // 8 AS int) AS label_y, CAST(label % 8 AS int) AS label_x, count(*) AS n_pixels, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max FROM l JOIN s USING (image_id, id) GROUP BY image_id, label""")
def connected_pixels(t: Tables):
    return px.connected_pixels(t.pixels.where("v > 120"))
