"""Cross-match, stamps and quadrants."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions.common import settled
from skyloom.operators import crossmatch, match, stats
from skyloom.operators.match import cone, match_one_to_one, pairs_within, pixels_of
from skyloom.operators.skew import by_shuffle, pick_first
from skyloom.plans.base import Tables, query, r6, sep_sql, with_views
from skyloom.plans.expressions import rounded

ARCSEC = 1.0 / 3600.0
TWO = "(2e0/3600e0)"
SEP = sep_sql("l.ra", "l.dec", "r.ra", "r.dec")


def one_to_one_sql(name: str, left: str, lid: str, right: str, rid: str, radius: str, sep: str = SEP, box: str = "dec") -> str:
    return f"""{name}_p AS (SELECT l.{lid} AS lid, r.{rid} AS rid, {sep} AS sep FROM {left} l, {right} r WHERE abs(l.{box}-r.{box}) <= {radius}),
    {name}_n AS (SELECT * FROM {name}_p WHERE sep < {radius} QUALIFY row_number() OVER (PARTITION BY lid ORDER BY sep, rid) = 1),
    {name} AS (SELECT * FROM {name}_n QUALIFY row_number() OVER (PARTITION BY rid ORDER BY sep, lid) = 1)"""


# field, right ascension, declination and radius: an ordinary one, one across RA 0, one beside and one around the pole
CONES = [("plain", 267.5, -29.5, 0.2), ("zero", 359.95, 0.03, 0.2), ("beside", 130.0, 89.8, 0.15), ("pole", 40.0, 89.9, 0.25)]
# field, RA range (low above high: across 0), declination range
BOXES = [("plain", 267.3, 267.7, -29.6, -29.4), ("zero", 359.8, 0.2, -0.1, 0.1), ("pole", 350.0, 20.0, 89.7, 90.0)]


def fields(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CONE_ROWS = ", ".join(f"('{n}', {a}e0, {d}e0, {r}e0)" for n, a, d, r in CONES)
BOX_ROWS = ", ".join(f"('{n}', {a}e0, {b}e0, {c}e0, {d}e0)" for n, a, b, c, d in BOXES)


@query("cone_search", with_views("sky_stars", extra=f"c(field, ra0, dec0, radius) AS (VALUES {CONE_ROWS}), s AS (SELECT field, star_id, ra, dec, radius, {sep_sql('ra', 'dec', 'ra0', 'dec0')} AS sep FROM sky_stars, c)")
    + f"SELECT field, star_id, {r6('ra')} AS ra, {r6('dec')} AS dec, {r6('sep')} AS sep FROM s WHERE sep <= radius")
def cone_search(t: Tables):
    found = fields([cone(t.sky_stars, a, d, r).withColumn("field", F.lit(n)) for n, a, d, r in CONES])
    return rounded(found, ["field", "star_id"], {"ra": "ra", "dec": "dec", "sep": "sep"})


@query("box_search", with_views("sky_stars", extra=f"b(field, a0, a1, d0, d1) AS (VALUES {BOX_ROWS})") + f"""SELECT field, star_id, {r6('ra')} AS ra, {r6('dec')} AS dec FROM sky_stars, b
    WHERE CASE WHEN a0 <= a1 THEN ra BETWEEN a0 AND a1 ELSE ra >= a0 OR ra <= a1 END AND dec BETWEEN d0 AND d1""")
def box_search(t: Tables):
    found = fields([match.box(t.sky_stars, *b).withColumn("field", F.lit(n)) for n, *b in BOXES])
    return rounded(found, ["field", "star_id"], {"ra": "ra", "dec": "dec"})


BULK = f"p AS (SELECT l.target_id, r.star_id, {SEP} AS sep FROM targets l, stars r WHERE abs(l.dec-r.dec) <= {TWO})"


@query("bulk_cone_search", with_views("targets", "stars", extra=BULK) + f"""SELECT target_id, count(*) AS n_hits, arg_min(star_id, (sep, star_id)) AS closest, {r6('min(sep)*3600')} AS sep_arcsec
    FROM p WHERE sep <= {TWO} GROUP BY target_id""")
def bulk_cone_search(t: Tables):
    hits = pairs_within(t.stars, t.targets, 2 * ARCSEC)
    return hits.groupBy(F.col("r.target_id").alias("target_id")).agg(
        F.count("*").alias("n_hits"), F.min_by("l.star_id", F.struct("sep", "l.star_id")).alias("closest"), settled(F.min("sep") * 3600).alias("sep_arcsec")
    )


@query("nearest_match_1to1", with_views("catalog2", extra=one_to_one_sql("m", "catalog2", "star_id", "stars", "star_id", TWO))
    + f"SELECT rid AS field_id, lid AS dataset_star_id, {r6('sep*3600')} AS sep_arcsec FROM m")
def nearest_match_1to1(t: Tables):
    m = match_one_to_one(t.catalog2, t.stars, 2 * ARCSEC, "star_id", "star_id")
    return m.select(F.col("r.star_id").alias("field_id"), F.col("l.star_id").alias("dataset_star_id"), settled(F.col("sep") * 3600).alias("sep_arcsec"))


FOLD = (one_to_one_sql("ma", "catalog2", "star_id", "stars", "star_id", TWO)
    + """, oa AS (SELECT star_id, ra, dec, (SELECT max(star_id) FROM stars) + row_number() OVER (ORDER BY star_id) AS field_id FROM catalog2 WHERE star_id NOT IN (SELECT lid FROM ma)),
    f1 AS (SELECT star_id AS field_id, ra, dec FROM stars UNION ALL SELECT field_id, ra, dec FROM oa), tb AS (SELECT target_id AS star_id, ra, dec FROM targets), """
    + one_to_one_sql("mb", "tb", "star_id", "f1", "field_id", TWO)
    + """, ob AS (SELECT star_id, ra, dec, (SELECT max(field_id) FROM f1) + row_number() OVER (ORDER BY star_id) AS field_id FROM tb WHERE star_id NOT IN (SELECT lid FROM mb))""")


@query("orphan_merge", with_views("catalog2", "targets", extra=FOLD) + f"""SELECT star_id AS field_id, 'primary' AS dataset, star_id AS dataset_star_id, 0e0 AS sep_arcsec FROM stars
    UNION ALL SELECT rid, 'second', lid, {r6('sep*3600')} FROM ma UNION ALL SELECT field_id, 'second', star_id, -1e0 FROM oa
    UNION ALL SELECT rid, 'third', lid, {r6('sep*3600')} FROM mb UNION ALL SELECT field_id, 'third', star_id, -1e0 FROM ob""")
def orphan_merge(t: Tables):
    """Fold of two datasets into the field index of the primary."""
    field = crossmatch.FieldIndex.start(t.stars, "primary").add_dataset(t.catalog2, "second", 2 * ARCSEC)
    field = field.add_dataset(t.targets.withColumnRenamed("target_id", "star_id"), "third", 2 * ARCSEC)
    sep = F.when(F.col("separation") < 0, F.lit(-1.0)).otherwise(settled(F.col("separation") * 3600))
    return field.members.select("field_id", "dataset", "dataset_star_id", sep.alias("sep_arcsec"))


@query("attach_gaia", with_views("targets", "stars", extra="""gaia AS (SELECT target_id AS source_id, ra, dec, c_acctbal AS g_flux, c_acctbal/1e3 AS parallax FROM targets JOIN customer ON target_id = c_custkey),
    """ + one_to_one_sql("m", "gaia", "source_id", "stars", "star_id", TWO)) + f"""SELECT s.star_id, coalesce(source_id, -1) AS source_id, {r6('g_flux')} AS g_flux, {r6('coalesce(parallax, 0e0)')} AS parallax, {r6('sep*3600')} AS sep_arcsec
    FROM stars s LEFT JOIN m ON m.rid = s.star_id LEFT JOIN gaia ON gaia.source_id = m.lid""")
def attach_gaia(t: Tables):
    extra = t.raw("customer").select(F.col("c_custkey").alias("source_id"), F.col("c_acctbal").alias("g_flux"), (F.col("c_acctbal") / 1000.0).alias("parallax"))
    gaia = t.targets.withColumnRenamed("target_id", "source_id").join(by_shuffle(extra), "source_id")
    out = crossmatch.attach_catalogue(t.stars, gaia, ["g_flux", "parallax"], 2 * ARCSEC, "star_id", "source_id")
    return rounded(out.na.fill({"source_id": -1}), ["star_id", "source_id"], {"g_flux": "g_flux", "parallax": F.coalesce("parallax", F.lit(0.0)), "sep_arcsec": F.col("sep") * 3600})


@query("id_match", with_views("stars", extra=f"""d AS (SELECT star_id + 500000 AS star_id, ra + 3e-1/3600e0 AS ra, dec, concat('G', CASE WHEN star_id % 5 = 1 THEN star_id - 1 ELSE star_id END) AS gid FROM stars WHERE gaia_source_id <> 'None'
    UNION ALL SELECT star_id + 500000, ra, dec, 'None' FROM stars WHERE gaia_source_id = 'None'),
    u AS (SELECT * FROM d WHERE gid <> 'None' AND gid IN (SELECT gid FROM d GROUP BY gid HAVING count(*) = 1))""")
    + f"SELECT l.gid AS gaia_source_id, l.star_id AS dataset_star_id, r.star_id AS field_id, {r6(SEP + '*3600')} AS sep_arcsec FROM u l JOIN stars r ON l.gid = r.gaia_source_id")
def id_match(t: Tables):
    """Ids shared by two or more dataset stars do not match."""
    known = F.col("gaia_source_id") != "None"
    d = t.stars.select(
        (F.col("star_id") + 500000).alias("star_id"), F.when(known, F.col("ra") + F.lit(0.3) / 3600.0).otherwise(F.col("ra")).alias("ra"), "dec",
        F.when(known, F.concat(F.lit("G"), F.when(F.col("star_id") % 5 == 1, F.col("star_id") - 1).otherwise(F.col("star_id")))).otherwise("None").alias("gaia_source_id"),
    )
    m = crossmatch.match_by_identifier(d, t.stars, "gaia_source_id")
    return m.select("gaia_source_id", F.col("l.star_id").alias("dataset_star_id"), F.col("r.star_id").alias("field_id"), settled(F.col("sep") * 3600).alias("sep_arcsec"))


@query("radius_pairs", with_views("catalog2", extra=f"p AS (SELECT l.star_id AS star1, r.star_id AS star2, {SEP} AS sep FROM catalog2 l, stars r WHERE abs(l.dec-r.dec) <= 1e0/3600e0)")
    + f"SELECT star1, star2, {r6('sep*3600')} AS sep_arcsec FROM p WHERE sep <= 1e0/3600e0")
def radius_pairs(t: Tables):
    p = pairs_within(t.catalog2, t.stars, ARCSEC)
    return p.select(F.col("l.star_id").alias("star1"), F.col("r.star_id").alias("star2"), settled(F.col("sep") * 3600).alias("sep_arcsec"))


@query("combine_catalogs", with_views("catalog2", "targets", extra=f"""pr AS (SELECT l.star_id, r.star_id AS rid, {SEP} AS sep FROM stars l, catalog2 r WHERE abs(l.dec-r.dec) <= {TWO}),
    nr AS (SELECT * FROM pr WHERE sep <= {TWO} QUALIFY row_number() OVER (PARTITION BY star_id ORDER BY sep, rid) = 1),
    pg AS (SELECT l.star_id, r.target_id AS rid, {SEP} AS sep FROM stars l, targets r WHERE abs(l.dec-r.dec) <= {TWO}),
    ng AS (SELECT * FROM pg WHERE sep <= {TWO} QUALIFY row_number() OVER (PARTITION BY star_id ORDER BY sep, rid) = 1)""")
    + f"""SELECT s.star_id, coalesce(nr.rid, -1) AS r_id, {r6('15e0 + (nr.rid % 50)/1e1')} AS r_mag, coalesce(ng.rid, -1) AS g_id, {r6('16e0 + (ng.rid % 50)/1e1')} AS g_mag, {r6('nr.sep*3600')} AS r_sep
    FROM stars s LEFT JOIN nr ON s.star_id = nr.star_id LEFT JOIN ng ON s.star_id = ng.star_id""")
def combine_catalogs(t: Tables):
    r = t.catalog2.withColumn("mag", F.lit(15.0) + (F.col("star_id") % 50) / 10.0)
    g = t.targets.withColumnRenamed("target_id", "star_id").withColumn("mag", F.lit(16.0) + (F.col("star_id") % 50) / 10.0)
    out = crossmatch.combine_bands(t.stars, {"r": r, "g": g}, 2 * ARCSEC)
    out = out.na.fill({"r_id": -1, "g_id": -1})
    return out.select("star_id", "r_id", settled("r_mag").alias("r_mag"), "g_id", settled("g_mag").alias("g_mag"), settled(F.col("r_sep") * 3600).alias("r_sep"))


@query("two_pass_match", with_views("catalog2", extra=one_to_one_sql("a", "stars", "star_id", "catalog2", "star_id", TWO)
    + ", rl AS (SELECT * FROM stars WHERE star_id NOT IN (SELECT lid FROM a)), rr AS (SELECT * FROM catalog2 WHERE star_id NOT IN (SELECT rid FROM a)), "
    + one_to_one_sql("b", "rr", "star_id", "stars", "star_id", TWO))
    + f"SELECT lid AS left_id, rid AS right_id, {r6('sep*3600')} AS sep_arcsec, 1 AS round FROM a")
def two_pass_match(t: Tables):
    out = crossmatch.two_pass_match(t.stars, t.catalog2, 2 * ARCSEC, "star_id", "star_id")
    return out.select("left_id", "right_id", settled(F.col("sep") * 3600).alias("sep_arcsec"), "round")


SHIFT = "b AS (SELECT image_id, star_id + 1000000 AS star_id, x + ((star_id*31) % 9 - 4)*3e-1 AS x, y - (star_id % 4)*4e-1 AS y, flux FROM detections)"
PIX = "sqrt((l.x-r.x)*(l.x-r.x) + (l.y-r.y)*(l.y-r.y))"
IMAGE = "image_id"


def shifted(t: Tables):
    k = F.col("star_id")
    return t.detections.select(IMAGE, (k + 1000000).alias("star_id"), (F.col("x") + ((k * 31) % 9 - 4) * F.lit(0.3)).alias("x"), (F.col("y") - (k % 4) * F.lit(0.4)).alias("y"), "flux")


@query("pixel_match", with_views("detections", extra=SHIFT + f""", p AS (SELECT image_id, l.star_id AS lid, r.star_id AS rid, {PIX} AS sep FROM b l JOIN detections r USING (image_id) WHERE abs(l.y-r.y) <= 1.5e0),
    n AS (SELECT * FROM p WHERE sep < 1.5e0 QUALIFY row_number() OVER (PARTITION BY image_id, lid ORDER BY sep, rid) = 1),
    m AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY image_id, rid ORDER BY sep, lid) = 1)""") + f"SELECT image_id, lid AS star1, rid AS star2, {r6('sep')} AS sep FROM m")
def pixel_match(t: Tables):
    """Detections of an image and its catalogue stars, one to one; images never mix."""
    m = match_one_to_one(shifted(t), t.detections, 1.5, "star_id", "star_id", pixels_of(IMAGE))
    return m.select(F.col("l.image_id").alias(IMAGE), F.col("l.star_id").alias("star1"), F.col("r.star_id").alias("star2"), settled("sep").alias("sep"))


@query("brightest_within", with_views("detections", extra=SHIFT + f""", p AS (SELECT image_id, l.star_id AS det_id, r.star_id AS ref_id, r.flux AS ref_flux, {PIX} AS sep FROM b l JOIN detections r USING (image_id) WHERE abs(l.y-r.y) <= 30),
    c AS (SELECT * FROM p WHERE sep < 30 QUALIFY row_number() OVER (PARTITION BY image_id, det_id ORDER BY ref_flux DESC, ref_id) = 1)""")
    + f"SELECT image_id, det_id, ref_id, {r6('sep')} AS sep FROM c QUALIFY row_number() OVER (PARTITION BY image_id, ref_id ORDER BY det_id) = 1")
def brightest_within(t: Tables):
    out = crossmatch.brightest_within(shifted(t), t.detections, 30.0, "star_id", "star_id", keys=(IMAGE,))
    return out.select(IMAGE, "det_id", "ref_id", settled("sep").alias("sep"))


PLACES = "w AS (SELECT image_id, any_value(width)/2e0 + 50*image_id AS x0, any_value(height)/2e0 AS y0 FROM detections GROUP BY image_id)"


@query("nearest_star", with_views("detections", extra=PLACES) + f"""SELECT image_id, star_id, {r6('x')} AS x, {r6('y')} AS y, {r6('sqrt((x-x0)*(x-x0)+(y-y0)*(y-y0))')} AS sep FROM detections JOIN w USING (image_id)
    QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY sqrt((x-x0)*(x-x0)+(y-y0)*(y-y0)), star_id) = 1""")
def nearest_star(t: Tables):
    """The star nearest to a wanted place of every image."""
    d = t.detections
    places = d.groupBy(IMAGE).agg((F.max("width") / 2.0 + 50 * F.max(IMAGE)).alias("x0"), (F.max("height") / 2.0).alias("y0"))
    return rounded(crossmatch.nearest_to(d, places, [IMAGE], "star_id"), [IMAGE, "star_id"], {"x": "x", "y": "y", "sep": "sep"})


MATCHED = one_to_one_sql("m", "catalog2", "star_id", "stars", "star_id", TWO)


def matched(t: Tables):
    m = match_one_to_one(t.catalog2, t.stars, 2 * ARCSEC, "star_id", "star_id")
    return m.select(F.col("r.star_id").alias("star_id"), F.col("l.star_id").alias("other_id"), "sep")


@query("translate_ids", with_views("catalog2", "valid", extra=MATCHED) + """SELECT star_id, filter, count(*) AS n, coalesce(any_value(lid), -1) AS other_id
    FROM valid LEFT JOIN m ON m.rid = valid.star_id GROUP BY star_id, filter""")
def translate_ids(t: Tables):
    counts = t.valid.groupBy("star_id", "filter").agg(F.count("*").alias("n"))
    return crossmatch.translate_ids(counts, matched(t), "star_id", "other_id").select("star_id", "filter", "n", "other_id")


@query("keep_inliers", with_views("catalog2", extra=MATCHED) + f"SELECT rid AS star_id, lid AS other_id FROM m WHERE sep*3600 <= (SELECT 2*avg(sep)*3600 FROM m)")
def keep_inliers(t: Tables):
    m = matched(t)
    flagged = stats.attach_row(m, m.agg(F.avg("sep").alias("mean_sep")))
    return flagged.where(F.col("sep") * 3600 <= 2 * F.col("mean_sep") * 3600).select("star_id", "other_id")


STAMPS = """g AS (SELECT image_id, w, h, i, j, nx, ny FROM (SELECT image_id, w, h, CAST(ceil((w - 200)/4e2) AS int) AS nx, CAST(ceil((h - 200)/4e2) AS int) AS ny
      FROM (SELECT o_orderkey AS image_id, CAST(900 + (o_custkey % 7)*150 AS int) AS w, CAST(700 + (o_orderkey % 5)*200 AS int) AS h FROM orders)), range(0, 6) a(j), range(0, 6) b(i)
      WHERE (j < nx AND i < ny AND h >= 800 AND w >= 800) OR (i = 0 AND j = 0)),
    st AS (SELECT image_id, CASE WHEN h < 800 OR w < 800 THEN 0 ELSE i*nx+j END AS stamp_id,
      CASE WHEN h < 800 OR w < 800 THEN 0 ELSE greatest(200+400*j-200-20, 0) END AS x_min, CASE WHEN h < 800 OR w < 800 OR j = nx-1 THEN w ELSE least(200+400*j+200+20, w) END AS x_max,
      CASE WHEN h < 800 OR w < 800 THEN 0 ELSE greatest(200+400*i-200-20, 0) END AS y_min, CASE WHEN h < 800 OR w < 800 OR i = ny-1 THEN h ELSE least(200+400*i+200+20, h) END AS y_max FROM g)"""


@query("stamp_grid", "WITH " + STAMPS + "SELECT image_id, CAST(stamp_id AS int) AS stamp_id, CAST(x_min AS int) AS x_min, CAST(x_max AS int) AS x_max, CAST(y_min AS int) AS y_min, CAST(y_max AS int) AS y_max FROM st")
def stamp_grid(t: Tables):
    """Sub-images of every image from its own size."""
    sized = t.raw("orders").select(
        F.col("o_orderkey").alias("image_id"), (900 + (F.col("o_custkey") % 7) * 150).cast("int").alias("w"), (700 + (F.col("o_orderkey") % 5) * 200).cast("int").alias("h")
    )
    return sized.select("image_id", F.inline(crossmatch.stamp_array("w", "h", 400, 400, 20)))


FULL_STAMPS = """st AS (SELECT CAST(i*4+j AS int) AS stamp_id, greatest(505+1010*j-505-10, 0) AS x_min, CASE WHEN j = 3 THEN 4096 ELSE 505+1010*j+505+10 END AS x_max,
    greatest(505+1010*i-505-10, 0) AS y_min, CASE WHEN i = 3 THEN 4096 ELSE 505+1010*i+505+10 END AS y_max FROM range(0, 4) a(i), range(0, 4) b(j))"""

IMAGE_STAMPS = """z AS (SELECT DISTINCT image_id, width AS w, height AS h FROM detections),
    g AS (SELECT image_id, w, h, CAST(i AS int) AS i, CAST(j AS int) AS j, CAST(ceil((w - 505)/1010e0) AS int) AS nx, CAST(ceil((h - 505)/1010e0) AS int) AS ny FROM z, range(0, 6) a(i), range(0, 6) b(j)),
    st AS (SELECT image_id, i*nx+j AS stamp_id, greatest(1010*j-10, 0) AS x_min, CASE WHEN j = nx-1 THEN w ELSE least(1010*j+1020, w) END AS x_max,
      greatest(1010*i-10, 0) AS y_min, CASE WHEN i = ny-1 THEN h ELSE least(1010*i+1020, h) END AS y_max FROM g WHERE i < ny AND j < nx),
    hit AS (SELECT s.image_id, s.star_id, max(stamp_id) AS stamp_id FROM detections s JOIN st USING (image_id) WHERE s.x >= x_min AND s.x < x_max AND s.y >= y_min AND s.y < y_max GROUP BY s.image_id, s.star_id)"""


@query("stamp_assignment", with_views("detections", extra=IMAGE_STAMPS) + f"""SELECT d.image_id, d.star_id, {r6('x')} AS x, {r6('y')} AS y, coalesce(stamp_id, -1) AS stamp_id
    FROM detections d LEFT JOIN hit ON hit.image_id = d.image_id AND hit.star_id = d.star_id""")
def stamp_assignment(t: Tables):
    """Stamps of every image from its own size; a star beyond them keeps its row (-1 here, null in the operator)."""
    sized = t.detections.select(IMAGE, "width", "height").distinct()
    stamps = sized.select(IMAGE, F.inline(crossmatch.stamp_array("width", "height", 1010, 1010, 10)))
    out = crossmatch.assign_stamps(t.detections, stamps, keys=(IMAGE,)).withColumn("stamp_id", F.coalesce("stamp_id", F.lit(-1)))
    return rounded(out, [IMAGE, "star_id", "stamp_id"], {"x": "x", "y": "y"})


@query("assign_quadrant", with_views("stars", extra="""b AS (SELECT min(ra) + (max(ra)-min(ra))/2 AS mr, min(dec) + (max(dec)-min(dec))/2 AS md FROM stars),
    q AS (SELECT star_id, CASE WHEN ra <= mr AND dec >= md THEN 4 WHEN ra >= mr AND dec >= md THEN 3 WHEN ra >= mr THEN 2 ELSE 1 END AS quadrant FROM stars, b)""")
    + "SELECT star_id AS field_id, quadrant, row_number() OVER (PARTITION BY quadrant ORDER BY star_id) AS quadrant_id FROM q")
def assign_quadrant(t: Tables):
    field = t.stars.select(F.col("star_id").alias("field_id"), "ra", "dec")
    return crossmatch.assign_quadrants(field).select("field_id", "quadrant", "quadrant_id")


@query("remap_to_field", with_views("dataset_phot", "stars", extra="""b AS (SELECT min(ra) + (max(ra)-min(ra))/2 AS mr, min(dec) + (max(dec)-min(dec))/2 AS md FROM stars),
    q AS (SELECT star_id, CASE WHEN ra <= mr AND dec >= md THEN 4 WHEN ra >= mr AND dec >= md THEN 3 WHEN ra >= mr THEN 2 ELSE 1 END AS quadrant FROM stars, b),
    qi AS (SELECT star_id, quadrant, row_number() OVER (PARTITION BY quadrant ORDER BY star_id) AS quadrant_id FROM q),
    im AS (SELECT dataset, image_id, row_number() OVER (ORDER BY dataset, image_id) - 1 AS field_image_id FROM (SELECT DISTINCT dataset, image_id FROM dataset_phot))""")
    + f"SELECT quadrant, quadrant_id, field_image_id, star_id + 7000000 AS field_id, seq, {r6('hjd')} AS hjd, {r6('mag')} AS mag FROM dataset_phot JOIN qi USING (star_id) JOIN im USING (dataset, image_id)")
def remap_to_field(t: Tables):
    d = t.dataset_phot
    quads = crossmatch.assign_quadrants(t.stars.select(F.col("star_id").alias("field_id"), "ra", "dec"))
    codes = d.select("dataset").distinct()
    stars = d.select("dataset", "star_id").distinct().join(quads.select(F.col("field_id").alias("star_id"), "quadrant", "quadrant_id"), "star_id")
    star_map = stars.join(codes, "dataset").select("dataset", F.col("star_id").alias("dataset_star_id"), (F.col("star_id") + 7000000).alias("field_id"), "quadrant", "quadrant_id")
    image_map = crossmatch.with_row_index(d.select("dataset", "image_id").distinct(), ["dataset", "image_id"], "field_image_id")
    out = crossmatch.remap_to_field(d, star_map, image_map)
    return rounded(out, ["quadrant", "quadrant_id", "field_image_id", "field_id", "seq"], {"hjd": "hjd", "mag": "mag"})


SITES = ["lsc-doma", "cpt-doma", "coj-doma"]
PIVOT = [(s, f) for s in SITES for f in ("gp", "rp", "ip")]


@query("dataset_star_photometry", with_views("valid") + "SELECT star_id, " + ", ".join(
    f"{r6(f'''coalesce(sum(mag/(mag_err*mag_err)) FILTER (WHERE site = '{s}' AND filter = '{f}')/sum(1/(mag_err*mag_err)) FILTER (WHERE site = '{s}' AND filter = '{f}'), 0e0)''')} AS {f[0]}_mag_{s.replace('-', '_')}"
    for s, f in PIVOT) + " FROM valid GROUP BY star_id")
def dataset_star_photometry(t: Tables):
    """Wide view of the long table: one column per site and filter, zero where not measured."""
    w = F.sum(F.col("mag") / (F.col("mag_err") * F.col("mag_err"))) / F.sum(1.0 / (F.col("mag_err") * F.col("mag_err")))
    cells = t.valid.groupBy("star_id", F.concat(F.substring("filter", 1, 1), F.lit("_mag_"), F.translate("site", "-", "_")).alias("cell")).agg(w.alias("v"))
    names = [f"{f[0]}_mag_{s.replace('-', '_')}" for s, f in PIVOT]
    wide = cells.groupBy("star_id").pivot("cell", names).agg(F.first("v"))
    return rounded(wide, ["star_id"], {n: F.coalesce(n, F.lit(0.0)) for n in names})


@query("crowding_filter", with_views("detections", extra=f"""cr AS (SELECT DISTINCT image_id, l.star_id FROM detections l JOIN detections r USING (image_id) WHERE abs(l.y-r.y) <= 40 AND {PIX} < 40 AND l.star_id <> r.star_id AND l.flux/nullif(r.flux, 0) >= 0.5e0),
    b AS (SELECT image_id, quantile_cont(x, 0.1) AS x0, quantile_cont(x, 0.9) AS x1, quantile_cont(y, 0.1) AS y0, quantile_cont(y, 0.9) AS y1 FROM detections GROUP BY image_id)""")
    + f"SELECT image_id, star_id, {r6('flux')} AS flux FROM detections d JOIN b USING (image_id) WHERE NOT EXISTS (SELECT 1 FROM cr WHERE cr.image_id = d.image_id AND cr.star_id = d.star_id) AND x > x0 AND x < x1 AND y > y0 AND y < y1")
def crowding_filter(t: Tables):
    return rounded(crossmatch.crowding_filter(t.detections, "star_id", 40.0, 0.5, keys=(IMAGE,)), [IMAGE, "star_id"], {"flux": "flux"})


@query("isolation_filter", with_views("star_pixels", extra="""d AS (SELECT s.*, p_size AS image_id FROM star_pixels s JOIN part ON p_partkey = star_id),
    br AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY flux DESC, star_id) AS rk FROM d QUALIFY rk <= 100),
    bad AS (SELECT DISTINCT l.image_id, l.star_id FROM br l JOIN br r ON l.image_id = r.image_id AND r.rk > l.rk AND abs(l.x-r.x) < 60 AND abs(l.y-r.y) < 60)""")
    + f"""SELECT image_id, star_id, CAST(row_number() OVER (PARTITION BY image_id ORDER BY flux DESC, star_id) AS int) AS rank FROM br
    WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.image_id = br.image_id AND bad.star_id = br.star_id) AND x BETWEEN 50 AND 4046 AND y BETWEEN 50 AND 4046 QUALIFY rank <= 30""")
def isolation_filter(t: Tables):
    d = t.star_pixels.join(t.raw("part").select(F.col("p_partkey").alias("star_id"), F.col("p_size").alias("image_id")), "star_id")
    return crossmatch.isolation_filter(d, "image_id", "star_id", 60.0, 100, 30, 4096.0, 50.0).select("image_id", "star_id", "rank")
