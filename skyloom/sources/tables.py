"""Parquet tables of photometry, bundles of related tables and catalogue scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.functions import sky
from skyloom.operators.match import box, cone
from skyloom.schemas import CATALOGUE_COLUMNS, struct
from skyloom.session import scratch_path

CATALOGUE_ZONE = 0.5


def write_timeseries(phot: DataFrame, path: str, version: int, parts: list[str], files: int | None = None) -> str:
    """A new version of a photometry table; older versions stay where they are.

    Rows are range-partitioned on the partition columns and the star, so one hot partition value
    is split over files, and sorted by star, so row-group statistics prune a one-star scan.
    """
    target = f"{path}/version={version}"
    order = [*parts, "star_id"]
    ranged = phot.repartitionByRange(files, *order, "hjd") if files else phot.repartitionByRange(*order, "hjd")
    ranged.sortWithinPartitions(*order, "hjd").write.mode("errorifexists").partitionBy(*parts).parquet(target)
    return target


def read_timeseries(spark: SparkSession, path: str, version: int, schema: str | None = None) -> DataFrame:
    """All quadrants and filters of a version; leave partition predicates out to read several."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/version={version}")


def star_slice(phot: DataFrame, star_id: int) -> DataFrame:
    """Rows of one star: the predicate reaches the scan."""
    return phot.where(F.col("star_id") == star_id)


def save_bundle(tables: dict[str, DataFrame], path: str, schemas: dict[str, str]) -> None:
    """A named set of tables, each with exactly the columns of its schema."""
    for name, df in tables.items():
        schema = struct(schemas[name])
        cells = [F.col(f.name) if f.name in df.columns else F.lit(None) for f in schema]
        df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cells, schema)]).write.mode("overwrite").parquet(f"{path}/{name}")


def load_bundle(spark: SparkSession, path: str, schemas: dict[str, str], names: list[str] | None = None) -> dict[str, DataFrame]:
    return {n: spark.read.schema(schemas[n]).parquet(f"{path}/{n}") for n in names or schemas}


def ensure_tables(spark: SparkSession, database: str, schemas: dict[str, str]) -> None:
    """Create the tables of a database that do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schema}) USING parquet")


def write_normalizations(offsets: DataFrame) -> str:
    path = scratch_path(offsets.sparkSession, "normalizations")
    offsets.write.partitionBy("reference").parquet(path)
    return path


def read_normalizations_wide(spark: SparkSession, path: str, datasets: list[str]) -> DataFrame:
    """One column per dataset and row per reference, star and filter."""
    schema = "star_id bigint, filter string, site string, n_bins bigint, delta_mag double, delta_mag_err double, reference string"
    return spark.read.schema(schema).parquet(path).groupBy("reference", "star_id", "filter").pivot("site", datasets).agg(F.first("delta_mag"))


def write_catalogue(catalogue: DataFrame, path: str, zone: float = CATALOGUE_ZONE) -> str:
    """Catalogue partitioned by declination zone."""
    zoned = catalogue.withColumn("zone", F.floor((F.col("dec") + 90.0) / zone).cast("int"))
    zoned.repartitionByRange("zone", "ra").sortWithinPartitions("zone", "ra").write.partitionBy("zone").parquet(path)
    return path


def read_catalogue_region(catalogue: DataFrame, ra_min: float, ra_max: float, dec_min: float, dec_max: float, zone: float = CATALOGUE_ZONE) -> DataFrame:
    """Stars in a box, also across RA 0: zones that overlap it are the partitions read, the box is a pushed filter."""
    return box(catalogue, ra_min, ra_max, dec_min, dec_max, zone).drop("zone")


def read_catalogue_cone(catalogue: DataFrame, ra: float, dec: float, radius: float, zone: float = CATALOGUE_ZONE) -> DataFrame:
    """Stars within ``radius`` degrees of a position with their ``sep``: only the zones of the circle are read."""
    return cone(catalogue, ra, dec, radius, zone_height=zone).drop("zone")


def overlapping_tables(extents: DataFrame, ra_min: float, ra_max: float, dec_min: float, dec_max: float) -> DataFrame:
    """Catalogue tables whose header extents overlap a box in both axes; the box may lie across RA 0."""
    wanted = sky.box_cover(ra_min, ra_max, dec_min, dec_max)
    meets = F.lit(False)
    for low, high in wanted.parts:
        meets = meets | ((F.col("ra_min") <= high) & (F.col("ra_max") >= low))
    return extents.where(meets & (F.col("dec_min") <= wanted.dec_max) & (F.col("dec_max") >= wanted.dec_min))


def standardise_catalogue(raw: DataFrame, release: str) -> DataFrame:
    """Survey columns under their common names; rows without a position fall out."""
    renamed = raw.select(*[F.col(f"`{a}`").alias(b) for a, b in CATALOGUE_COLUMNS[release].items() if a in raw.columns])
    return renamed.where(F.col("ra").isNotNull() & F.col("dec").isNotNull() & ~F.isnan("ra") & ~F.isnan("dec"))


def star_table(stars: DataFrame, columns: list[str], path: str, fmt: str = "parquet") -> str:
    """Result table with a fixed order of columns."""
    writer = stars.select(*columns).write
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path))
    return path
