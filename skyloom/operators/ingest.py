"""Reference datasets stored in the photometric database: dimensions, stars, images, stamps, photometry and matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.operators.crossmatch import two_pass_match
from skyloom.operators.skew import pick_last
from skyloom.session import scratch_path
from skyloom.sources.versions import Spec, TableSet

# a name that is known keeps its id; a reference image replaces the one of the same facility and filter
DATABASE = {
    "facilities": Spec("facility_id bigint, facility_code string", ("facility_code",), number="facility_id"),
    "filters": Spec("filter_id bigint, filter_name string", ("filter_name",), number="filter_id"),
    "software": Spec("code_id bigint, code_name string, version string", ("code_name", "version"), number="code_id"),
    "images": Spec("image_number bigint, filename string, facility_id bigint, filter_id bigint", ("filename",), number="image_number"),
    "reference_images": Spec("refimg_id bigint, facility_id bigint, filter_id bigint, code_id bigint, filename string, is_primary boolean", ("facility_id", "filter_id"), number="refimg_id"),
    "reference_components": Spec("component_id bigint, image_number bigint, refimg_id bigint", number="component_id"),
    "stars": Spec("star_id bigint, star_index bigint, ra double, dec double, refimg_id bigint", number="star_id"),
    "stamps": Spec("refimg_id bigint, stamp_id int, x_min int, x_max int, y_min int, y_max int"),
    "phot": Spec("refimg_id bigint, star_id bigint, image_id bigint, mag double, mag_err double"),
    "matches": Spec("refimg_id bigint, dataset_star_id bigint, star_id bigint, separation double"),
}
DEPENDENT = ("reference_components", "stamps", "phot", "matches")


def open_database(spark: SparkSession, path: str | None = None) -> TableSet:
    return TableSet(spark, path or scratch_path(spark, "database"), DATABASE)


def live(db: TableSet, name: str) -> DataFrame:
    """Rows of a table that belong to a reference image which is still there.

    Replacing a reference image takes what depends on it out of sight without rewriting the
    photometry of others; :meth:`TableSet.commit` with ``instead`` removes it for good.
    """
    rows = db.read(name)
    return rows.join(db.read("reference_images").select("refimg_id"), "refimg_id", "left_semi") if name in DEPENDENT else rows


def _known(db: TableSet, name: str, row: dict) -> tuple[int, bool]:
    """Id of a dimension row and whether it is new; the table holds a row for each facility, filter, version or image name."""
    spec = db.specs[name]
    found = db.read(name)
    for key in spec.keys:
        found = found.where(F.col(key).eqNullSafe(F.lit(row[key])))
    old = found.agg(F.min(spec.number)).first()[0]
    return (old, False) if old is not None else (db.next_number(name), True)


def ingest_reference(
    db: TableSet, dataset: str, params: dict[str, str], stars: DataFrame, photometry: DataFrame, stamps: DataFrame, primary: bool, radius: float,
) -> bool:
    """One reference dataset into the database as one batch named ``dataset``; False if it is there already.

    ``params``: facility_code, filter_name, code_name, version, ref_filename, and the component's
    filename. ``stars``: star_id (the dataset's own number), ra, dec. ``photometry``: star_id,
    image_id, seq, mag, mag_err; of several versions of a measurement the last counts. ``stamps``: stamp_id and bounds.

    The primary dataset's stars become the field's stars and get new ids in the order of their
    numbers; all its photometry is stored. Another dataset is matched with those stars in two
    rounds, and only the photometry of matched stars is stored. A reference image of the same
    facility and filter is replaced, and with it everything that depends on it. Repeating an attempt,
    finished or not, changes nothing.
    """
    if db.done(dataset):
        return False
    spark = db.spark
    row = dict(params)
    new: dict[str, DataFrame] = {}

    def dimension(name: str, id_column: str, **values) -> int:
        number, fresh = _known(db, name, values)
        if fresh:
            spec = db.specs[name]
            cells = {id_column: number, **values}
            new[name] = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{c} {'bigint' if isinstance(v, int) else 'string'}" for c, v in cells.items()))
            assert id_column == spec.number
        return number

    facility = dimension("facilities", "facility_id", facility_code=row["facility_code"])
    band = dimension("filters", "filter_id", filter_name=row["filter_name"])
    code = dimension("software", "code_id", code_name=row["code_name"], version=row["version"])
    image = dimension("images", "image_number", filename=row["filename"], facility_id=facility, filter_id=band)
    refimg, component = db.next_number("reference_images"), db.next_number("reference_components")
    new["reference_images"] = spark.createDataFrame(
        [(refimg, facility, band, code, row["ref_filename"], primary)], "refimg_id bigint, facility_id bigint, filter_id bigint, code_id bigint, filename string, is_primary boolean")
    new["reference_components"] = spark.createDataFrame([(component, image, refimg)], "component_id bigint, image_number bigint, refimg_id bigint")
    new["stamps"] = stamps.withColumn("refimg_id", F.lit(refimg))
    if primary:
        numbered = db.numbered("stars", stars.select(F.col("star_id").alias("star_index"), "ra", "dec"), ["star_index"])
        new["stars"] = numbered.withColumn("refimg_id", F.lit(refimg))
        matches = numbered.select(F.col("star_index").alias("dataset_star_id"), "star_id", F.lit(0.0).alias("separation"))
    else:
        field = db.read("stars").select("star_id", "ra", "dec")
        pairs = two_pass_match(stars.select(F.col("star_id").alias("dataset_star_id"), "ra", "dec"), field, radius, "dataset_star_id", "star_id")
        matches = pairs.select(F.col("left_id").alias("dataset_star_id"), F.col("right_id").alias("star_id"), F.col("sep").alias("separation"))
    new["matches"] = matches.withColumn("refimg_id", F.lit(refimg))
    last = pick_last(photometry, ["star_id", "image_id"], [F.col("seq"), F.col("mag")], ["mag", "mag_err"]).withColumnRenamed("star_id", "dataset_star_id")
    new["phot"] = last.join(matches, "dataset_star_id").select("star_id", "image_id", "mag", "mag_err", F.lit(refimg).alias("refimg_id"))
    return db.commit(dataset, new)
