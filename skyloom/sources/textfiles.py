"""Whitespace tables, light-curve files, dataset lists, configuration and search results as text or JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyloom.operators.skew import by_shuffle
from skyloom.session import scratch_path

# stands for null in written tables, so that every field keeps its place
NULL_TOKEN = "None"
TRUE_WORDS = ["true", "1", "yes"]


def split_fields(line: str = "value") -> Column:
    return F.split(F.trim(F.col(line)), r"\s+")


def joined_fields(columns: list[Column]) -> Column:
    """One line of text with a token for nulls."""
    return F.concat_ws(" ", *[F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns])


def _word(n: Column) -> Column:
    return F.when(n != NULL_TOKEN, n)


def read_whitespace_table(spark: SparkSession, path: str, columns: dict[str, tuple[int, str]], comment: str = "#") -> DataFrame:
    """Named and typed columns by position; comment and empty lines fall out, bad numbers are null."""
    lines = spark.read.text(path).where(~F.trim("value").startswith(comment) & (F.trim("value") != ""))
    fields = split_fields()
    return lines.select(*[_word(F.get(fields, F.lit(n))).try_cast(kind).alias(name) for name, (n, kind) in columns.items()])


# fixed values: columns of an exported light curve file
LIGHTCURVE_FIELDS = {
    "hjd": (0, "double"), "inst_mag": (1, "double"), "inst_mag_err": (2, "double"), "cal_mag": (3, "double"), "cal_mag_err": (4, "double"),
    "pscale": (5, "double"), "pscale_err": (6, "double"), "qc_flag": (7, "int"),
}


def read_lightcurves(spark: SparkSession, path: str, skip_empty_time: bool = True, per_star: bool = False) -> DataFrame:
    """Light-curve files of many stars.

    Star and dataset are the first two fields of a line or, in the layout of one folder per star,
    part of the folder names.
    """
    fields = split_fields()
    lines = spark.read.option("recursiveFileLookup", "true").text(path).withColumn("_file", F.col("_metadata.file_path"))
    if per_star:
        shift = 0
        star = F.regexp_extract("_file", r"star_id=(\d+)", 1).try_cast("bigint")
        dataset = F.regexp_extract("_file", r"dataset=([^/]+)", 1)
    else:
        shift, star, dataset = 2, F.get(fields, F.lit(0)).try_cast("bigint"), _word(F.get(fields, F.lit(1)))
    rows = lines.where(~F.trim("value").startswith("#") & (F.trim("value") != "")).select(
        star.alias("star_id"), dataset.alias("dataset"),
        *[F.get(fields, F.lit(n + shift)).try_cast(kind).alias(name) for name, (n, kind) in LIGHTCURVE_FIELDS.items()],
    )
    return rows.where("hjd > 0") if skip_empty_time else rows


def write_lightcurves(rows: DataFrame, path: str, fmt: str = "dat", per_star: bool = False) -> str:
    """Light curves in time order as ``.dat`` text or CSV.

    Rows are ranged by star, dataset and time, so a star with very many points is written by
    several tasks. ``per_star`` writes one folder per star and dataset, for a selection of stars;
    a whole survey goes into few large files with the ids on every line.
    """
    ids = ["star_id", "dataset"]
    placed = rows.repartitionByRange(*ids, "hjd").sortWithinPartitions(*ids, "hjd")
    if fmt == "csv":
        out = placed.select(*ids, F.col("hjd").alias("time"), "filter", F.col("cal_mag").alias("magnitude"), F.col("cal_mag_err").alias("error"))
    else:
        names = [*([] if per_star else ids), *LIGHTCURVE_FIELDS]
        out = placed.select(*(ids if per_star else []), joined_fields([F.col(c) for c in names]).alias("value"))
    writer = out.write.partitionBy(*ids) if per_star else out.write
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.text(path))
    return path


def read_dataset_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``dataset flag``; the flag is primary_ref or non_ref."""
    d = read_whitespace_table(spark, path, {"dataset": (0, "string"), "flag": (1, "string")})
    return d.select("dataset", F.when(F.col("flag") == "primary_ref", 1).otherwise(0).alias("primary_ref"))


def select_datasets(datasets: DataFrame, mode: str, listed: DataFrame | None = None, recent_after: Column | None = None) -> DataFrame:
    """Selection modes ALL, LIST (an @file) and RECENT (newest image after a time)."""
    if mode == "ALL":
        return datasets
    if mode == "LIST":
        return datasets.join(listed.select("dataset"), "dataset", "left_semi")
    if mode == "RECENT":
        return datasets.where(F.col("latest") > recent_after)
    raise ValueError(f"unknown selection mode {mode}")


CONFIG_ENTRY = T.MapType(
    T.StringType(), T.StructType([T.StructField(n, T.StringType()) for n in ("value", "comment", "format", "unit")])
)


def parse_config(texts: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON of the form key → {value, comment, format, unit} as one row per key."""
    return texts.select(*(keep or []), F.explode(F.from_json(column, CONFIG_ENTRY)).alias("key", "entry")).select(
        *(keep or []), "key", "entry.value", "entry.comment", "entry.format", "entry.unit"
    )


def read_config(spark: SparkSession, path: str) -> DataFrame:
    return parse_config(spark.read.text(path, wholetext=True))


def boolean_value(column: str = "value") -> Column:
    return F.lower(F.trim(F.col(column))).isin(*TRUE_WORDS)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Target list: name → {RA, Dec, radius}."""
    entry = T.MapType(T.StringType(), T.StructType([T.StructField("ra", T.DoubleType()), T.StructField("dec", T.DoubleType()), T.StructField("radius", T.DoubleType())]))
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", entry)).alias("name", "t")).select("name", "t.ra", "t.dec", "t.radius")


def write_calibrations(coefficients: DataFrame) -> str:
    """Coefficients and covariance of every dataset as a text table."""
    path = scratch_path(coefficients.sparkSession, "calibrations")
    coefficients.select(joined_fields([F.col(c) for c in ("dataset", "a", "b", "c00", "c01", "c11")]).alias("value")).write.text(path)
    return path


def read_calibrations(spark: SparkSession, path: str) -> DataFrame:
    names = ["a", "b", "c00", "c01", "c11"]
    return read_whitespace_table(spark, path, {"dataset": (0, "string")} | {n: (k + 1, "double") for k, n in enumerate(names)})


SEARCH_RESULT = "separation_deg double, field_id bigint, ra double, dec double, quadrant int, search_radius_deg double"


def write_search_results(hits: DataFrame, targets: DataFrame, target_id: str, radius_deg: float, path: str) -> str:
    """Search results of all targets as JSON lines, one for each target and star, in order of target and distance.

    ``hits``: the target's id, star_id, ra, dec, quadrant and sep in degrees. A line has the same form however many
    stars a target has, so nothing is gathered: target, target_data, search_radius_deg and the star's
    field_id, ra, dec, quadrant and separation_deg.
    """
    about = targets.select(target_id, F.struct(*[c for c in targets.columns if c != target_id]).alias("target_data"))
    lines = hits.join(by_shuffle(about), target_id).select(
        target_id, "target_data", F.lit(float(radius_deg)).alias("search_radius_deg"), F.col("star_id").alias("field_id"), "ra", "dec", "quadrant", F.col("sep").alias("separation_deg"))
    order = [target_id, "separation_deg", "field_id"]
    lines.repartitionByRange(*order).sortWithinPartitions(*order).write.json(path)
    return path

