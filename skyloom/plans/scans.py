"""Scans, sources and sinks: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions.common import num, settled
from skyloom.operators import crossmatch, lightcurves as lc
from skyloom.operators.match import pairs_within
from skyloom.plans.base import FIELD_PREFIX, TELESCOPE_SUFFIX, Tables, query, r6, sep_sql, with_views
from skyloom.plans.expressions import rounded
from skyloom.plans.matching import ARCSEC, BOXES, BOX_ROWS, CONES, CONE_ROWS, TWO, fields
from skyloom.schemas import FIELD_BUNDLE
from skyloom.session import scratch_path
from skyloom.sources import tables, textfiles
from skyloom.sources.versions import Spec, TableSet

STORED = "star_id bigint, image_id bigint, seq int, site string, hjd double, mag double, mag_err double, pscale double, quadrant int, filter string"


def quadrants(t: Tables):
    return t.phot.withColumn("quadrant", (F.col("star_id") % 4 + 1).cast("int"))


def stored_phot(t: Tables):
    path = scratch_path(t.spark, "phot")
    tables.write_timeseries(quadrants(t), path, 1, ["quadrant", "filter"])
    return tables.read_timeseries(t.spark, path, 1, STORED)


@query("scan_timeseries", with_views("phot") + f"SELECT CAST(star_id % 4 + 1 AS int) AS quadrant, filter, count(*) AS n, {r6('sum(mag)', 4)} AS sum_mag, count(DISTINCT star_id) AS n_stars FROM phot GROUP BY ALL")
def scan_timeseries(t: Tables):
    """All quadrants and filters of the stored table; one partition value is one predicate away."""
    per_star = stored_phot(t).groupBy("quadrant", "filter", "star_id").agg(F.count("*").alias("n"), F.sum("mag").alias("m"))
    return per_star.groupBy("quadrant", "filter").agg(F.sum("n").alias("n"), settled(F.sum("m"), 4).alias("sum_mag"), F.count("*").alias("n_stars"))


@query("scan_star_slice", with_views("phot") + f"SELECT star_id, image_id, seq, filter, {r6('hjd')} AS hjd, {r6('mag')} AS mag FROM phot WHERE star_id = 7")
def scan_star_slice(t: Tables):
    return rounded(tables.star_slice(stored_phot(t), 7), ["star_id", "image_id", "seq", "filter"], {"hjd": "hjd", "mag": "mag"})


@query("sink_timeseries", with_views("phot") + f"SELECT CAST(v AS int) AS version, filter, count(*) AS n, {r6('sum(CASE WHEN v = 2 THEN mag + 1e-1 ELSE mag END)', 4)} AS sum_mag FROM phot, range(1, 3) r(v) GROUP BY v, filter")
def sink_timeseries(t: Tables):
    """The revised table becomes version 2; version 1 stays."""
    path = scratch_path(t.spark, "phot")
    tables.write_timeseries(quadrants(t), path, 1, ["quadrant", "filter"])
    tables.write_timeseries(quadrants(t).withColumn("mag", F.col("mag") + 0.1), path, 2, ["quadrant", "filter"])
    both = tables.read_timeseries(t.spark, path, 1, STORED).withColumn("version", F.lit(1)).unionByName(tables.read_timeseries(t.spark, path, 2, STORED).withColumn("version", F.lit(2)))
    return both.groupBy("version", "filter").agg(F.count("*").alias("n"), settled(F.sum("mag"), 4).alias("sum_mag"))


def exported(t: Tables):
    """Light-curve columns of every usable measurement."""
    return t.dataset_phot.where(lc.usable(0.03, 0.8)).select(
        "star_id", "dataset", "filter", "hjd", F.col("mag").alias("inst_mag"), F.col("mag_err").alias("inst_mag_err"), (F.col("mag") + 0.1).alias("cal_mag"),
        F.col("mag_err").alias("cal_mag_err"), "pscale", num(0.01).alias("pscale_err"), F.lit(0).alias("qc_flag"),
    )


LC_SQL = with_views("dataset_phot") + f"SELECT star_id, dataset, count(*) AS n, {r6('min(hjd)')} AS first_hjd, {r6('max(hjd)')} AS last_hjd, {r6('sum(mag + 1e-1)', 4)} AS sum_cal FROM dataset_phot WHERE mag > 0 AND mag_err <= 3e-2 AND pscale >= 8e-1 GROUP BY ALL"


@query("sink_lightcurve", LC_SQL)
def sink_lightcurve(t: Tables):
    """Export as .dat folders, summarised from what was written."""
    path = textfiles.write_lightcurves(exported(t), scratch_path(t.spark, "lightcurves"))
    out = textfiles.read_lightcurves(t.spark, path)
    return out.groupBy("star_id", "dataset").agg(
        F.count("*").alias("n"), settled(F.min("hjd")).alias("first_hjd"), settled(F.max("hjd")).alias("last_hjd"), settled(F.sum("cal_mag"), 4).alias("sum_cal")
    )


@query("scan_lightcurve_text", with_views("dataset_phot") + f"SELECT star_id, dataset, {r6('hjd')} AS hjd, {r6('mag')} AS inst_mag, {r6('mag_err')} AS inst_mag_err, {r6('pscale')} AS pscale FROM dataset_phot WHERE mag > 0 AND mag_err <= 3e-2 AND pscale >= 8e-1")
def scan_lightcurve_text(t: Tables):
    path = textfiles.write_lightcurves(exported(t), scratch_path(t.spark, "lightcurves"))
    return rounded(textfiles.read_lightcurves(t.spark, path), ["star_id", "dataset"], {c: c for c in ("hjd", "inst_mag", "inst_mag_err", "pscale")})


@query("scan_source_catalog", with_views("stars", "star_mags") + f"SELECT star_id, {r6('ra')} AS ra, {r6('dec')} AS dec, {r6('g')} AS g FROM stars JOIN star_mags USING (star_id)")
def scan_source_catalog(t: Tables):
    """A whitespace table with a comment line per file region, picked by column position."""
    d = t.stars.join(t.star_mags, "star_id")
    line = F.concat_ws("   ", F.col("star_id").cast("string"), F.col("gaia_source_id"), F.col("ra").cast("string"), F.col("dec").cast("string"), F.col("g").cast("string"))
    noise = t.stars.select(F.concat(F.lit("# star "), F.col("star_id").cast("string")).alias("value"))
    path = scratch_path(t.spark, "catalog")
    d.select(F.concat(F.lit("  "), line).alias("value")).unionByName(noise).write.text(path)
    read = textfiles.read_whitespace_table(t.spark, path, {"star_id": (0, "bigint"), "ra": (2, "double"), "dec": (3, "double"), "g": (4, "double")})
    return rounded(read, ["star_id"], {"ra": "ra", "dec": "dec", "g": "g"})


REGION_SQL = with_views("sky_stars", extra=f"""b(field, a0, a1, d0, d1) AS (VALUES {BOX_ROWS}), c(field, ra0, dec0, radius) AS (VALUES {CONE_ROWS}),
    s AS (SELECT field, star_id, ra, dec, radius, {sep_sql('ra', 'dec', 'ra0', 'dec0')} AS sep FROM sky_stars, c)""") + f"""SELECT concat('box ', field) AS region, star_id, {r6('ra')} AS ra, {r6('dec')} AS dec FROM sky_stars, b
    WHERE CASE WHEN a0 <= a1 THEN ra BETWEEN a0 AND a1 ELSE ra >= a0 OR ra <= a1 END AND dec BETWEEN d0 AND d1 UNION ALL SELECT concat('cone ', field), star_id, {r6('ra')}, {r6('dec')} FROM s WHERE sep <= radius"""


@query("scan_catalog_region", REGION_SQL)
def scan_catalog_region(t: Tables):
    """Boxes and circles of a catalogue stored in zones, at RA 0 and at the pole too."""
    path = tables.write_catalogue(t.sky_stars, scratch_path(t.spark, "zones"), zone=0.25)
    stored = t.spark.read.schema("star_id bigint, ra double, dec double, zone int").parquet(path)
    boxes = [tables.read_catalogue_region(stored, *b, zone=0.25).withColumn("region", F.lit(f"box {n}")) for n, *b in BOXES]
    cones = [tables.read_catalogue_cone(stored, *c, zone=0.25).drop("sep").withColumn("region", F.lit(f"cone {n}")) for n, *c in CONES]
    return rounded(fields(boxes + cones), ["region", "star_id"], {"ra": "ra", "dec": "dec"})


@query("standardise_catalog", with_views("stars", "star_mags") + f"SELECT CAST(star_id AS varchar) AS source_id, {r6('ra')} AS ra, {r6('dec')} AS dec, {r6('g')} AS gmag, {r6('g_err')} AS gmag_err FROM stars JOIN star_mags USING (star_id) WHERE size <> 21")
def standardise_catalog(t: Tables):
    """Survey columns renamed; stars without a position (NaN) fall out."""
    d = t.stars.join(t.star_mags, "star_id")
    raw = d.select(
        F.col("star_id").cast("string").alias("sourceID"), F.when(F.col("size") == 21, num(float("nan"))).otherwise(F.col("ra")).alias("RAJ2000"), F.col("dec").alias("DEJ2000"),
        F.col("g").alias("gmag"), F.col("g_err").alias("e_gmag"),
    )
    return rounded(tables.standardise_catalogue(raw, "VPHAS+"), ["source_id"], {c: c for c in ("ra", "dec", "gmag", "gmag_err")})


@query("scan_json_config", "SELECT p_partkey AS star_id, 'max_sky' AS key, CAST(p_size*100 AS varchar) AS value, 'adu' AS unit, FALSE AS is_true FROM part UNION ALL SELECT p_partkey, 'plots', CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END, 'none', p_size % 2 = 0 FROM part")
def scan_json_config(t: Tables):
    """One configuration text per star, one row per key."""
    def entry(value, unit: str):
        return F.struct(value.alias("value"), F.lit("set by test").alias("comment"), F.lit("str").alias("format"), F.lit(unit).alias("unit"))

    size = F.col("p_size")
    texts = t.raw("part").select(
        F.col("p_partkey").alias("star_id"),
        F.to_json(F.struct(entry((size * 100).cast("string"), "adu").alias("max_sky"), entry(F.when(size % 2 == 0, "True").otherwise("False"), "none").alias("plots"))).alias("value"),
    )
    out = textfiles.parse_config(texts, keep=["star_id"])
    return out.select("star_id", "key", "value", "unit", textfiles.boolean_value().alias("is_true"))


@query("scan_dataset_list", with_views("dataset_phot") + "SELECT dataset, CAST(max(CASE WHEN site = 'lsc-doma' AND filter = 'ip' THEN 1 ELSE 0 END) AS int) AS primary_ref, count(*) AS n FROM dataset_phot GROUP BY dataset")
def scan_dataset_list(t: Tables):
    """Dataset list written as text, read and used to select the datasets."""
    d = t.dataset_phot.groupBy("dataset", "site", "filter").agg(F.count("*").alias("n"))
    path = scratch_path(t.spark, "datasets")
    flag = F.when((F.col("site") == "lsc-doma") & (F.col("filter") == "ip"), "primary_ref").otherwise("non_ref")
    d.select(F.concat_ws(" ", "dataset", flag).alias("value")).write.text(path)
    listed = textfiles.read_dataset_list(t.spark, path)
    chosen = textfiles.select_datasets(d, "LIST", listed)
    return chosen.join(listed, "dataset").select("dataset", "primary_ref", "n")


@query("scan_sql", with_views("valid", "stars") + f"SELECT star_id, count(*) AS n, {r6('avg(mag)')} AS mean_mag FROM valid JOIN stars USING (star_id) WHERE filter = 'ip' AND dec >= -29.9e0 GROUP BY star_id")
def scan_sql(t: Tables):
    """SQL text with bound arguments over registered tables."""
    return t.spark.sql(
        "SELECT star_id, count(*) AS n, round(avg(mag), 6) + 0e0 AS mean_mag FROM {valid} JOIN {stars} USING (star_id) WHERE filter = :band AND dec >= :dec_min GROUP BY star_id",
        args={"band": "ip", "dec_min": -29.9}, valid=t.valid, stars=t.stars,
    )


@query("table_bundle", with_views("stars", "dataset_phot", "images") + """SELECT 'stars' AS name, count(*) AS n FROM stars UNION ALL SELECT 'field_index', count(*) FROM (SELECT DISTINCT star_id, dataset FROM dataset_phot)
    UNION ALL SELECT 'datasets', count(*) FROM (SELECT DISTINCT dataset FROM dataset_phot) UNION ALL SELECT 'images', count(*) FROM images UNION ALL SELECT 'stamps', 4*count(*) FROM images""")
def table_bundle(t: Tables):
    """The five tables of a field crossmatch saved with their schemas and loaded again."""
    d = t.dataset_phot
    bundle = {
        "stars": t.stars.select(F.col("star_id").alias("field_id"), "ra", "dec", "gaia_source_id"),
        "field_index": d.select(F.col("star_id").alias("field_id"), "dataset", F.col("star_id").alias("dataset_star_id")).distinct(),
        "datasets": d.select("dataset", "site", "filter").distinct(),
        "images": t.images.select(F.col("image_id").alias("image_index"), F.col("image_id").cast("string").alias("filename"), "fwhm", "sky", "nstars"),
        "stamps": t.images.select(F.col("image_id").cast("string").alias("filename"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("stamp_id")),
    }
    path = scratch_path(t.spark, "bundle")
    tables.save_bundle(bundle, path, FIELD_BUNDLE)
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.load_bundle(t.spark, path, FIELD_BUNDLE).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("sink_append", with_views("images") + f"""SELECT image_id, {r6('CASE WHEN image_id % 3 = 0 THEN fwhm + 1e0 ELSE fwhm END')} AS fwhm, CASE WHEN image_id % 3 = 0 THEN -nstars ELSE nstars END AS nstars FROM images
    UNION ALL SELECT s_suppkey + 1000000000, {r6('s_acctbal')}, 0 FROM supplier""")
def sink_append(t: Tables):
    """Rows appended by batch; one batch replaces every third row by its key, and each batch is written twice to no effect."""
    table = TableSet(t.spark, scratch_path(t.spark, "append"), {"images": Spec("image_id bigint, fwhm double, nstars int", ("image_id",))})
    first = t.images.select("image_id", "fwhm", "nstars")
    more = t.raw("supplier").select((F.col("s_suppkey") + 1000000000).alias("image_id"), F.col("s_acctbal").alias("fwhm"), F.lit(0).alias("nstars"))
    third = first.where("image_id % 3 = 0").select("image_id", (F.col("fwhm") + 1).alias("fwhm"), (-F.col("nstars")).alias("nstars"))
    for batch, rows in (("images", first), ("suppliers", more), ("better", third)):
        for _ in range(2):
            table.commit(batch, {"images": rows})
    return rounded(table.read("images"), ["image_id", "nstars"], {"fwhm": "fwhm"})


SEARCH_SQL = f"""p AS (SELECT l.target_id, r.star_id, r.ra, r.dec, l.ra AS target_ra, {sep_sql('l.ra', 'l.dec', 'r.ra', 'r.dec')} AS sep FROM targets l, stars r WHERE abs(l.dec-r.dec) <= {TWO}),
    b AS (SELECT min(ra) + (max(ra)-min(ra))/2 AS mr, min(dec) + (max(dec)-min(dec))/2 AS md FROM stars)"""


@query("sink_search_results", with_views("targets", "stars", extra=SEARCH_SQL) + f"""SELECT target_id, star_id AS field_id, {r6('target_ra')} AS target_ra, {r6('ra')} AS ra, {r6('dec')} AS dec,
    CASE WHEN ra <= mr AND dec >= md THEN 4 WHEN ra >= mr AND dec >= md THEN 3 WHEN ra >= mr THEN 2 ELSE 1 END AS quadrant, {r6('sep*3600')} AS sep_arcsec, {r6('2e0')} AS radius_arcsec FROM p, b WHERE sep <= {TWO}""")
def sink_search_results(t: Tables):
    """JSON lines with the stars of each target, read back."""
    quadrants = crossmatch.assign_quadrants(t.stars.select(F.col("star_id").alias("field_id"), "ra", "dec")).select(F.col("field_id").alias("star_id"), "ra", "dec", "quadrant")
    hits = pairs_within(quadrants, t.targets, 2 * ARCSEC).select(F.col("r.target_id").alias("target_id"), "l.star_id", "l.ra", "l.dec", "l.quadrant", "sep")
    path = textfiles.write_search_results(hits, t.targets, "target_id", 2 * ARCSEC, scratch_path(t.spark, "search"))
    read = t.spark.read.schema(f"target_id bigint, target_data struct<ra:double,dec:double>, {textfiles.SEARCH_RESULT}").json(path)
    return rounded(read, ["target_id", "field_id", "quadrant"], {
        "target_ra": "target_data.ra", "ra": "ra", "dec": "dec", "sep_arcsec": F.col("separation_deg") * 3600, "radius_arcsec": F.col("search_radius_deg") * 3600})


@query("sink_star_tables", with_views("star_mags", "stars") + f"SELECT star_id, {r6('ra')} AS ra, {r6('dec')} AS dec, {r6('g')} AS g, {r6('i')} AS i, CAST(g > 0 AND g_err <= 2e-2 AND i > 0 AND i_err <= 1e-2 AS int) AS selected FROM stars JOIN star_mags USING (star_id)")
def sink_star_tables(t: Tables):
    """All stars with a 0/1 column for the selection, written as CSV and read back."""
    d = t.stars.join(t.star_mags, "star_id")
    marked = lc.mark_selected(d, lc.select_stars(d, {"g": 0.02, "i": 0.01}), "star_id")
    path = tables.star_table(marked, ["star_id", "ra", "dec", "g", "i", "selected"], scratch_path(t.spark, "stars"), "csv")
    read = t.spark.read.schema("star_id bigint, ra double, dec double, g double, i double, selected int").option("header", True).csv(path)
    return rounded(read, ["star_id", "selected"], {c: c for c in ("ra", "dec", "g", "i")})
