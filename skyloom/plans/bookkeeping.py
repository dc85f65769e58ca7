"""Dimension tables, dataset codes, image status and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import text
from skyloom.functions.common import settled
from skyloom.operators import catalog, stats
from skyloom.operators.ordering import with_row_index
from skyloom.plans.base import FIELD_PREFIX, TELESCOPE_SUFFIX, Tables, query, r6, with_views

STATUS = """status AS (SELECT o_orderkey AS image_id, CAST(s AS int) AS stage, CAST(CASE WHEN (o_custkey + s*3) % 17 = 0 THEN -1 WHEN (o_orderkey + s) % 3 = 0 THEN 0 ELSE 1 END AS int) AS status
    FROM orders, range(0, 8) t(s))"""


def status_table(t: Tables):
    rows = t.raw("orders").select("o_orderkey", "o_custkey", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("stage"))
    status = F.when((F.col("o_custkey") + F.col("stage") * 3) % 17 == 0, -1).when((F.col("o_orderkey") + F.col("stage")) % 3 == 0, 0).otherwise(1)
    return rows.select(F.col("o_orderkey").alias("image_id"), "stage", status.alias("status"))


@query("insert_if_absent", """WITH n AS (SELECT c_custkey AS star_id, c_name AS name, c_acctbal AS flux FROM customer UNION ALL SELECT c_custkey + c_nationkey, c_name, -c_acctbal FROM customer),
    f AS (SELECT star_id, arg_min(name, (flux, name)) AS name FROM n WHERE star_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY star_id)
    SELECT s_suppkey AS star_id, s_name AS name FROM supplier UNION ALL SELECT star_id, name FROM f""")
def insert_if_absent(t: Tables):
    existing = t.raw("supplier").select(F.col("s_suppkey").alias("star_id"), F.col("s_name").alias("name"), F.struct(F.lit(0.0).alias("flux"), F.lit("").alias("name")).alias("arrival"))
    c = t.raw("customer")
    a = c.select(F.col("c_custkey").alias("star_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("flux"))
    b = c.select((F.col("c_custkey") + F.col("c_nationkey")).alias("star_id"), F.col("c_name").alias("name"), (-F.col("c_acctbal")).alias("flux"))
    new = a.unionByName(b).select("star_id", "name", F.struct("flux", "name").alias("arrival"))
    return catalog.insert_if_absent(existing, new, "star_id", "arrival").select("star_id", "name")


KEYS = ["star_id", "image_id", "filter"]


@query("upsert_last_wins", with_views("phot", extra="""v AS (SELECT star_id, image_id, filter, mag, seq FROM phot UNION ALL SELECT star_id, image_id, filter, mag + 1e-1, seq + 100 FROM phot WHERE pscale < 0.8e0)""")
    + f"SELECT star_id, image_id, filter, {r6('arg_max(mag, (seq, mag))')} AS mag, max(seq) AS seq FROM v GROUP BY star_id, image_id, filter")
def upsert_last_wins(t: Tables):
    """A second delivery of the measurements with a small scale factor replaces the first."""
    base = t.phot.select(*KEYS, "mag", F.struct("seq", "mag").alias("arrival"))
    again = t.phot.where("pscale < 0.8e0").select(*KEYS, (F.col("mag") + 0.1).alias("mag"), (F.col("seq") + 100).alias("seq"))
    again = again.select(*KEYS, "mag", F.struct("seq", "mag").alias("arrival"))
    out = catalog.upsert_last_wins(base, again, KEYS, "arrival")
    return out.select(*KEYS, settled("mag").alias("mag"), F.col("arrival.seq").alias("seq"))


PATCH_SQL = """pt AS (SELECT c_custkey AS image_id, 1 AS turn, abs(c_acctbal) AS fwhm, CAST(c_nationkey AS int) AS nstars FROM customer
    UNION ALL SELECT c_custkey, 2, c_acctbal/1e1, NULL FROM customer WHERE c_custkey % 3 = 0), lp AS (SELECT image_id, arg_max(struct_pack(f := fwhm, n := nstars), turn) AS p FROM pt GROUP BY image_id)"""


@query("update_cell", with_views("images", extra=PATCH_SQL) + f"""SELECT images.image_id, {r6('CASE WHEN p IS NULL THEN fwhm ELSE p.f END')} AS fwhm, coalesce(CASE WHEN p IS NULL THEN nstars ELSE p.n END, -1) AS nstars FROM images LEFT JOIN lp ON lp.image_id = images.image_id""")
def update_cell(t: Tables):
    """Two patches, of which the second sets a cell of every third row to null; the last one counts as a whole."""
    c = t.raw("customer")
    one = c.select(F.col("c_custkey").alias("image_id"), F.lit(1).alias("turn"), F.abs("c_acctbal").alias("fwhm"), F.col("c_nationkey").cast("int").alias("nstars"))
    two = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("image_id"), F.lit(2).alias("turn"), (F.col("c_acctbal") / 10.0).alias("fwhm"), F.lit(None).cast("int").alias("nstars"))
    out = catalog.update_cells(t.images, one.unionByName(two), ["image_id"], ["fwhm", "nstars"], ["turn"], set_null=True)
    return out.select("image_id", settled("fwhm").alias("fwhm"), F.coalesce("nstars", F.lit(-1)).alias("nstars"))


@query("extend_schema", with_views("images") + f"""SELECT image_id, {r6('fwhm')} AS fwhm, {r6('fwhm*0.389e0')} AS fwhm_arcsec, 'old' AS origin FROM images
    UNION ALL SELECT s_suppkey + 1000000000, {r6('s_acctbal')}, -1e0, 'new' FROM supplier""")
def extend_schema(t: Tables):
    """A new column for the old rows; new rows without it, filled by the default."""
    old = t.images.select("image_id", "fwhm", (F.col("fwhm") * 0.389).alias("fwhm_arcsec"), F.lit("old").alias("origin"))
    new = t.raw("supplier").select((F.col("s_suppkey") + 1000000000).alias("image_id"), F.col("s_acctbal").alias("fwhm"), F.lit("new").alias("origin"))
    out = old.unionByName(new, allowMissingColumns=True).na.fill({"fwhm_arcsec": -1.0})
    return out.select("image_id", settled("fwhm").alias("fwhm"), settled("fwhm_arcsec").alias("fwhm_arcsec"), "origin")


@query("row_to_map", """SELECT p_partkey AS star_id, n AS name, CASE n WHEN 'p_brand' THEN p_brand WHEN 'p_type' THEN p_type ELSE CAST(p_size AS varchar) END AS value, CAST(3 AS int) AS n_parameters,
    p_brand AS brand_again FROM part, (VALUES ('p_brand'), ('p_type'), ('p_size')) v(n)""")
def row_to_map(t: Tables):
    """Wide row → name/value rows → map, and one column back from the pairs."""
    names = ["p_brand", "p_type", "p_size"]
    pairs = catalog.wide_to_pairs(t.raw("part"), ["p_partkey"], names)
    maps = catalog.pairs_to_map(pairs, ["p_partkey"])
    back = catalog.pairs_to_wide(pairs, ["p_partkey"], names).select("p_partkey", F.col("p_brand").alias("brand_again"))
    out = maps.join(back, "p_partkey")
    return out.select(
        F.col("p_partkey").alias("star_id"), F.explode("parameters").alias("name", "value"), F.size("parameters").alias("n_parameters"), "brand_again"
    )


@query("cascade_delete", with_views("phot", "images") + f"""SELECT 'phot' AS child, count(*) AS n, {r6('sum(mag)', 4)} AS total FROM phot WHERE image_id NOT IN (SELECT image_id FROM images WHERE nstars < 20)
    UNION ALL SELECT 'images', count(*), {r6('sum(fwhm)', 4)} FROM images WHERE nstars >= 20""")
def cascade_delete(t: Tables):
    """Images with few stars go, and every measurement on them."""
    gone = t.images.where("nstars < 20")
    left = catalog.cascade_delete({"phot": (t.phot, "image_id"), "images": (t.images, "image_id")}, gone, "image_id")
    rows = [
        left[name].agg(F.count("*").alias("n"), settled(F.sum(col), 4).alias("total")).select(F.lit(name).alias("child"), "n", "total")
        for name, col in (("phot", "mag"), ("images", "fwhm"))
    ]
    return rows[0].unionByName(rows[1])


DIMS_SQL = """f AS (SELECT site AS name, row_number() OVER (ORDER BY site) AS id FROM (SELECT DISTINCT site FROM phot)), b AS (SELECT filter AS name, row_number() OVER (ORDER BY filter) AS id FROM (SELECT DISTINCT filter FROM phot)),
    r AS (SELECT site, filter, row_number() OVER (ORDER BY concat(site, '-', filter)) AS id FROM (SELECT DISTINCT site, filter FROM phot))"""


@query("dim_lookup", with_views("phot", extra=DIMS_SQL) + f"""SELECT star_id, seq, image_id, f.id AS facility_id, b.id AS band_id, CAST(CASE seq % 2 WHEN 0 THEN 3 ELSE 2 END AS bigint) AS software_id, image_id AS exposure_id, r.id AS reference_id,
    CAST(star_id % 4 + 10 AS bigint) AS stamp_id, {r6('mag')} AS mag FROM phot JOIN f ON f.name = phot.site JOIN b ON b.name = phot.filter JOIN r ON r.site = phot.site AND r.filter = phot.filter""")
def dim_lookup(t: Tables):
    """Facility, filter, software, exposure, reference image and stamp names back to ids in one pass; an unknown name raises."""
    named = t.phot.select(
        "star_id", "seq", "image_id", F.col("site").alias("facility"), F.col("filter").alias("band"), F.concat(F.lit("v"), F.col("seq") % 2).alias("software"),
        F.concat(F.lit("i"), "image_id").alias("exposure"), F.concat_ws("-", "site", "filter").alias("reference"), F.concat(F.lit("stamp"), F.col("star_id") % 4).alias("stamp"), "mag",
    )

    def counted(name: str):
        return with_row_index(named.select(name).distinct(), [name]).select(name, (F.col("idx") + 1).alias(f"{name}_id"))

    dims = {
        "facility": counted("facility"), "band": counted("band"), "reference": counted("reference"),
        # the first software row of v0 is superseded
        "software": t.spark.createDataFrame([("v0", 1), ("v1", 2), ("v0", 3)], "software string, software_id bigint"),
        "exposure": t.raw("orders").select(F.concat(F.lit("i"), "o_orderkey").alias("exposure"), F.col("o_orderkey").alias("exposure_id")),
        "stamp": t.spark.createDataFrame([(f"stamp{n}", n + 10) for n in range(4)], "stamp string, stamp_id bigint"),
    }
    out = catalog.resolve_names(named, dims)
    return out.select("star_id", "seq", "image_id", *[f"{d}_id" for d in ("facility", "band", "software", "exposure", "reference", "stamp")], settled("mag").alias("mag"))


@query("facility_key", """SELECT s_suppkey AS star_id, concat('s', s_nationkey, '-doma-1m0-', CASE s_suppkey % 3 WHEN 0 THEN 'fa' WHEN 1 THEN 'fl' ELSE 'kb' END, s_suppkey % 20) AS facility,
    CASE WHEN s_suppkey % 3 < 2 THEN 'sinistro' ELSE concat('kb', s_suppkey % 20) END AS instrument_class FROM supplier""")
def facility_key(t: Tables):
    k = F.col("s_suppkey")
    instrument = F.concat(F.when(k % 3 == 0, "fa").when(k % 3 == 1, "fl").otherwise("kb"), k % 20)
    return t.raw("supplier").select(
        k.alias("star_id"), text.facility_code(F.concat(F.lit("s"), "s_nationkey"), F.lit("doma"), F.lit("1m0"), instrument).alias("facility"),
        text.instrument_class(instrument).alias("instrument_class"),
    )


@query("parse_dataset_code", with_views("dataset_phot") + """SELECT dataset, split_part(dataset, '_', 1) AS field, split_part(split_part(dataset, '_', 2), '-', 1) AS site, split_part(split_part(dataset, '_', 2), '-', 2) AS enclosure,
    split_part(split_part(dataset, '_', 2), '-', 3) AS telescope, split_part(split_part(dataset, '_', 2), '-', 5) AS instrument, concat(site, '_', filter) AS short_code, filter[1] AS sloan,
    dataset LIKE '%doma%' AS primary_enclosure, count(*) AS n FROM dataset_phot GROUP BY ALL""")
def parse_dataset_code(t: Tables):
    per = t.dataset_phot.groupBy("dataset").agg(F.count("*").alias("n"))
    p = text.dataset_parts("dataset")
    return per.select(
        "dataset", *[p[c].alias(c) for c in ("field", "site", "enclosure", "telescope", "instrument")], text.short_code("dataset").alias("short_code"),
        text.sloan_filter(p["filter"]).alias("sloan"), text.is_primary_enclosure("dataset").alias("primary_enclosure"), "n",
    )


@query("route_images", """SELECT image_id, concat('FIELD-01_', site, '-doma-1m0a-', inst, '_', filt) AS dataset FROM (SELECT o_orderkey AS image_id, CASE o_custkey % 3 WHEN 0 THEN 'lsc' WHEN 1 THEN 'cpt' ELSE 'coj' END AS site,
    concat('fa', o_custkey % 20) AS inst, CASE WHEN o_orderkey % 4 = 0 THEN 'gp' WHEN o_orderkey % 4 = 1 THEN 'rp' WHEN o_orderkey % 4 = 2 THEN 'ip' ELSE 'V' END AS filt FROM orders)""")
def route_images(t: Tables):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    headers = t.raw("orders").select(
        o.alias("image_id"), F.lit("FIELD 01/").alias("object"), F.when(c % 3 == 0, "LSC").when(c % 3 == 1, "CPT").otherwise("COJ").alias("site"), F.lit("DOMA").alias("enclosure"),
        F.lit("1m0a").alias("telescope"), F.concat(F.when(c % 2 == 0, "fa").otherwise("fl"), c % 20).alias("instrument"), F.when(o % 4 == 3, "V").alias("filter"),
        F.when(o % 4 == 0, "gp").otherwise("air").alias("filter1"), F.when(o % 4 == 1, "rp").otherwise("None").alias("filter2"), F.when(o % 4 == 2, "ip").otherwise("AIR").alias("filter3"),
    )
    return catalog.route_images(headers).select("image_id", "dataset")


@query("group_datasets", with_views("dataset_phot", extra="d AS (SELECT dataset, site, filter, count(*) AS n, count(DISTINCT image_id) AS n_images FROM dataset_phot GROUP BY ALL)")
    + "SELECT filter, '1m0' AS aperture, count(*) AS n_datasets, min(dataset) AS first_dataset, CAST(sum(n) AS bigint) AS n_rows, CAST(sum(n_images) AS bigint) AS n_images FROM d GROUP BY filter")
def group_datasets(t: Tables):
    """Images and rows per dataset, then datasets per filter and aperture class."""
    per = t.dataset_phot.groupBy("dataset", "filter", "image_id").agg(F.count("*").alias("n")).groupBy("dataset", "filter").agg(F.sum("n").alias("n"), F.count("*").alias("n_images"))
    tagged = per.withColumn("aperture", text.dataset_parts("dataset")["telescope"])
    return tagged.groupBy("filter", "aperture").agg(
        F.count("*").alias("n_datasets"), F.min("dataset").alias("first_dataset"), F.sum("n").alias("n_rows"), F.sum("n_images").alias("n_images")
    )


@query("choose_by_preference", with_views("valid", extra=f"d AS (SELECT DISTINCT star_id, site, filter FROM valid)") + f"""SELECT star_id, arg_min(concat('{FIELD_PREFIX}', site, '{TELESCOPE_SUFFIX}', filter),
    ((CASE filter WHEN 'ip' THEN 0 WHEN 'rp' THEN 1 ELSE 2 END), (CASE site WHEN 'lsc-doma' THEN 0 WHEN 'cpt-doma' THEN 2 ELSE 5 END))) AS dataset, CAST(1 AS bigint) AS n_best FROM d GROUP BY star_id""")
def choose_by_preference(t: Tables):
    d = t.dataset_phot.where("mag > 0 AND mag_err > 0").select("star_id", "dataset").distinct()
    p = text.dataset_parts("dataset")
    named = d.select("star_id", "dataset", p["telescope"].alias("aperture"), p["filter"].alias("filter"), p["site"].alias("site"))
    return catalog.choose_by_preference(named, ["star_id"], "aperture", "filter", "site", "dataset")


@query("recent_datasets", """WITH d AS (SELECT o_custkey AS dataset_id, max(o_orderdate) AS latest, count(*) AS n_images FROM orders GROUP BY o_custkey)
    SELECT dataset_id, n_images, date_diff('day', DATE '1970-01-01', CAST(latest AS date)) AS latest_day FROM d WHERE latest > (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY""")
def recent_datasets(t: Tables):
    """Datasets with an image in the 30 days before the end of the data."""
    o = t.raw("orders")
    per = o.groupBy(F.col("o_custkey").alias("dataset_id")).agg(F.max("o_orderdate").alias("latest"), F.count("*").alias("n_images"))
    recent = stats.attach_row(per, o.agg(F.max("o_orderdate").alias("end"))).where(F.expr("latest > end - INTERVAL 30 DAY"))
    return recent.select("dataset_id", "n_images", F.datediff(F.col("latest").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint").alias("latest_day"))


@query("status_update", "WITH " + STATUS + """, u AS (SELECT s.image_id, s.stage, CASE WHEN o.o_custkey % 7 = 0 AND s.stage = 3 THEN -1 WHEN o.o_custkey % 7 = 1 AND s.stage = 2 THEN 1 ELSE s.status END AS status
    FROM status s JOIN orders o ON o.o_orderkey = s.image_id) SELECT image_id, stage, CAST(CASE WHEN min(status) OVER (PARTITION BY image_id ORDER BY stage) = -1 THEN -1 ELSE status END AS int) AS status FROM u""")
def status_update(t: Tables):
    o = t.raw("orders")
    image, cust = F.col("o_orderkey").alias("image_id"), F.col("o_custkey")
    updates = o.where(cust % 7 == 0).select(image, F.lit(3).alias("stage"), F.lit(-1).alias("status")).unionByName(
        o.where(cust % 7 == 1).select(image, F.lit(2).alias("stage"), F.lit(1).alias("status"))
    )
    return catalog.set_status(status_table(t), updates, refuse_unknown=True).select("image_id", "stage", "status")


@query("pending_images", "WITH " + STATUS + """, i AS (SELECT o_orderkey AS image_id FROM orders UNION ALL SELECT c_custkey + 1000000000 FROM customer)
    SELECT i.image_id FROM i LEFT JOIN status s ON s.image_id = i.image_id AND s.stage = 4 WHERE s.status IS NULL OR s.status = 0""")
def pending_images(t: Tables):
    """Images not done at stage 4 and images that have no status yet."""
    images = t.raw("orders").select(F.col("o_orderkey").alias("image_id")).unionByName(t.raw("customer").select((F.col("c_custkey") + 1000000000).alias("image_id")))
    return catalog.pending_images(images, status_table(t), 4)


@query("header_projection", with_views("ev") + """SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.airmass'), 'None') AS airmass FROM ev""")
def header_projection(t: Tables):
    out = catalog.header_fields(t.events, "props", {"k": "k", "airmass": "airmass"}, ["event_id"])
    return out.withColumn("airmass", F.coalesce("airmass", F.lit("None")))


@query("image_table", with_views("images", extra=STATUS + ", w AS (SELECT image_id, min(status) AS worst FROM status WHERE stage <= 6 GROUP BY image_id), h AS (SELECT o_orderkey AS image_id, concat('set', o_custkey % 9) AS dataset FROM orders)")
    + f"""SELECT image_id, dataset, {r6('fwhm')} AS fwhm, nstars, CAST(CASE WHEN worst = -1 THEN -1 ELSE 0 END AS int) AS qc_flag, row_number() OVER (ORDER BY dataset, image_id) - 1 AS image_index FROM h JOIN images USING (image_id) JOIN w USING (image_id)""")
def image_table(t: Tables):
    headers = t.raw("orders").select(F.col("o_orderkey").alias("image_id"), F.concat(F.lit("set"), F.col("o_custkey") % 9).alias("dataset"))
    out = catalog.image_table(headers, t.images, status_table(t))
    return out.select("image_id", "dataset", settled("fwhm").alias("fwhm"), "nstars", "qc_flag", "image_index")


@query("stage_durations", with_views("ev") + """SELECT filter AS file, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last,
    date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS seconds FROM ev GROUP BY filter""")
def stage_durations(t: Tables):
    """Log lines made from the events, one log per event type, read back as text."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    lines = t.events.select(F.col("filter").alias("file"), F.concat_ws(" ", stamp, F.lit("processed"), "event_id").alias("line"))
    out = catalog.stage_durations(lines)
    show = "yyyy-MM-dd'T'HH:mm:ss"
    return out.select("file", F.date_format("first", show).alias("first"), F.date_format("last", show).alias("last"), "seconds")


@query("set_union", with_views("phot") + " UNION ALL ".join(f"SELECT '{s}' AS site, count(*) AS n, {r6('sum(pscale)', 4)} AS total FROM phot WHERE site = '{s}'" for s in ("lsc-doma", "cpt-doma", "coj-doma")))
def set_union(t: Tables):
    parts = [t.phot.where(F.col("site") == s) for s in ("lsc-doma", "cpt-doma", "coj-doma")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("site").agg(F.count("*").alias("n"), settled(F.sum("pscale"), 4).alias("total"))


@query("set_intersection", with_views("valid") + "SELECT star_id, image_id FROM valid WHERE filter = 'gp' INTERSECT SELECT star_id, image_id FROM valid WHERE mag_err < 1e-2")
def set_intersection(t: Tables):
    ids = ["star_id", "image_id"]
    return t.valid.where("filter = 'gp'").select(*ids).intersect(t.valid.where("mag_err < 1e-2").select(*ids))


@query("set_difference", with_views("valid") + "SELECT DISTINCT star_id, image_id FROM valid v WHERE NOT EXISTS (SELECT 1 FROM valid w WHERE w.star_id = v.star_id AND w.image_id = v.image_id AND w.mag_err < 1e-2)")
def set_difference(t: Tables):
    ids = ["star_id", "image_id"]
    return t.valid.select(*ids).distinct().join(t.valid.where("mag_err < 1e-2").select(*ids), ids, "left_anti")
