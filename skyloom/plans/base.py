"""Registry of queries, the views they read and SQL text helpers."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FIELD_PREFIX = "FIELD-01_"
TELESCOPE_SUFFIX = "-1m0-05-fa15_"


class Tables:
    """Views on the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def phot(self) -> DataFrame:
        """One row per measurement."""
        day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("star_id"),
            F.col("l_orderkey").alias("image_id"),
            F.col("l_linenumber").alias("seq"),
            F.when(F.col("l_returnflag") == "A", "gp").when(F.col("l_returnflag") == "N", "rp").otherwise("ip").alias("filter"),
            F.when(F.col("l_linenumber") % 3 == 0, "lsc-doma").when(F.col("l_linenumber") % 3 == 1, "cpt-doma")
            .otherwise("coj-doma").alias("site"),
            (day + F.lit(2440587.5) + F.col("l_linenumber") / F.lit(10.0)).alias("hjd"),
            F.when(F.col("l_tax") == 0, F.lit(0.0))
            .otherwise(F.lit(27.4) - F.lit(2.5) * F.log10("l_extendedprice")).alias("mag"),
            (F.lit(1e-3) + F.col("l_discount") / F.lit(2.0)).alias("mag_err"),
            (F.lit(0.4) + F.col("l_quantity") / F.lit(50.0)).alias("pscale"),
        )

    @cached_property
    def valid(self) -> DataFrame:
        return self.phot.where((F.col("mag") > 0) & (F.col("mag_err") > 0))

    @cached_property
    def dataset_phot(self) -> DataFrame:
        return self.phot.withColumn(
            "dataset", F.concat(F.lit(FIELD_PREFIX), "site", F.lit(TELESCOPE_SUFFIX), "filter")
        )

    @cached_property
    def stars(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(
            k.alias("star_id"),
            (F.lit(267.0) + ((k * 7919) % 100003) / F.lit(100003.0)).alias("ra"),
            (F.lit(-30.0) + ((k * 104729) % 99991) / F.lit(99991.0)).alias("dec"),
            F.when(k % 4 == 0, "None").otherwise(F.concat(F.lit("G"), k.cast("string"))).alias("gaia_source_id"),
        )

    @cached_property
    def sky_stars(self) -> DataFrame:
        """The stars in three fields: as they are, around RA 0, and around the north pole."""
        k, s = F.col("star_id"), self.stars
        zero = s.select((k + 1_000_000).alias("star_id"), F.pmod(F.col("ra") - 267.5, F.lit(360.0)).alias("ra"), (F.col("dec") + 29.5).alias("dec"))
        pole = s.select((k + 2_000_000).alias("star_id"), ((F.col("ra") - 267.0) * 360.0).alias("ra"), (F.lit(90.0) - (F.col("dec") + 30.0) / 2.0).alias("dec"))
        return s.select("star_id", "ra", "dec").unionByName(zero).unionByName(pole)

    @cached_property
    def star_mags(self) -> DataFrame:
        """Catalogue stars with three reference magnitudes and errors (some bands not measured: 0)."""
        k, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
        g = F.lit(14.0) + (price % 800) / F.lit(100.0)
        zero = F.lit(0.0)
        return self.raw("part").select(
            k.alias("star_id"),
            F.when(size == 7, zero).otherwise(g).alias("g"),
            (F.lit(0.005) + (k % 13) / F.lit(400.0)).alias("g_err"),
            F.when(size == 11, zero).otherwise(g - F.lit(0.3) - (k % 17) / F.lit(20.0)).alias("r"),
            (F.lit(0.004) + (k % 11) / F.lit(500.0)).alias("r_err"),
            F.when(size == 13, zero).otherwise(g - F.lit(0.5) - (k % 23) / F.lit(20.0)).alias("i"),
            (F.lit(0.003) + (k % 7) / F.lit(600.0)).alias("i_err"),
            size.alias("size"),
        )

    @cached_property
    def catalog2(self) -> DataFrame:
        """Every star seen a second time, twice: once displaced by up to 0.6 arcsec (one in five by
        6 arcsec, so that it has no partner), once as a wider double."""
        s = self.stars
        k = F.col("star_id")
        near = F.when(k % 5 == 0, F.lit(6.0)).otherwise(((k * 31) % 7 - 3) * F.lit(0.2))
        wide = F.lit(0.5) + (k % 11) * F.lit(0.3)
        one = s.select((k + 10_000_000_000).alias("star_id"), (F.col("ra") + near / 3600.0).alias("ra"), "dec")
        two = s.select((k + 20_000_000_000).alias("star_id"), (F.col("ra") + wide / 3600.0).alias("ra"), "dec")
        return one.unionByName(two)

    @cached_property
    def targets(self) -> DataFrame:
        """Target list for many cone searches."""
        k = F.col("c_custkey")
        return self.raw("customer").select(
            k.alias("target_id"),
            (F.lit(267.0) + ((k * 7919) % 100003) / F.lit(100003.0) + (k % 9) / F.lit(7200.0)).alias("ra"),
            (F.lit(-30.0) + ((k * 104729) % 99991) / F.lit(99991.0)).alias("dec"),
        )

    @cached_property
    def star_pixels(self) -> DataFrame:
        """Catalogue stars on a 4096 pixel detector with a flux."""
        k = F.col("p_partkey")
        return self.raw("part").select(
            k.alias("star_id"),
            ((k * 7919) % 40960 / F.lit(10.0)).alias("x"),
            ((k * 104729) % 40961 / F.lit(10.0)).alias("y"),
            (F.col("p_retailprice") * (1 + F.col("p_size"))).alias("flux"),
        )

    @cached_property
    def detections(self) -> DataFrame:
        """The stars of ``star_pixels`` as detections on four images, with the size of the image."""
        image = self.raw("part").select(F.col("p_partkey").alias("star_id"), (F.col("p_size") % 4).alias("image_id"))
        sized = image.withColumn("width", (3600 + F.col("image_id") * 300).cast("int")).withColumn("height", (4500 - F.col("image_id") * 400).cast("int"))
        return self.star_pixels.join(sized, "star_id").select("image_id", "star_id", "x", "y", "flux", "width", "height")

    @cached_property
    def images(self) -> DataFrame:
        o, c = F.col("o_orderkey"), F.col("o_custkey")
        return self.raw("orders").select(
            o.alias("image_id"),
            (F.lit(1.0) + (c % 30) / F.lit(10.0)).alias("fwhm"),
            (F.col("o_totalprice") / F.lit(20.0)).alias("sky"),
            (c % 200).cast("int").alias("nstars"),
            ((o % 100) / F.lit(100.0)).alias("moon_fraction"),
            ((o % 180) * F.lit(1.0)).alias("moon_distance"),
        )

    @cached_property
    def pixels(self) -> DataFrame:
        """8 × 8 images."""
        e = self.raw("embeddings").select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("pos", "v"))
        return e.select(
            "image_id", (F.col("pos") % 8).cast("int").alias("x"), F.floor(F.col("pos") / 8).cast("int").alias("y"),
            (F.col("v").cast("double") * 1000).alias("v"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").select(
            "event_id", "ts", F.col("user_id").alias("star_id"), F.col("event_type").alias("filter"),
            F.col("value").alias("flux"), "props",
        )


def query(name: str, sql: str | None = None):
    """Register a query under its operator name."""

    def wrap(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


# --- SQL text -----------------------------------------------------------------------------

VIEWS = {
    "phot": f"""SELECT l_suppkey AS star_id, l_orderkey AS image_id, l_linenumber AS seq,
        CASE l_returnflag WHEN 'A' THEN 'gp' WHEN 'N' THEN 'rp' ELSE 'ip' END AS filter,
        CASE l_linenumber % 3 WHEN 0 THEN 'lsc-doma' WHEN 1 THEN 'cpt-doma' ELSE 'coj-doma' END AS site,
        date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS date)) + 2440587.5e0 + l_linenumber/1e1 AS hjd,
        CASE WHEN l_tax = 0 THEN 0e0 ELSE 27.4e0 - 2.5e0*log10(l_extendedprice) END AS mag,
        1e-3 + l_discount/2e0 AS mag_err, 4e-1 + l_quantity/5e1 AS pscale FROM lineitem""",
    "valid": "SELECT * FROM phot WHERE mag > 0 AND mag_err > 0",
    "dataset_phot": f"SELECT *, concat('{FIELD_PREFIX}', site, '{TELESCOPE_SUFFIX}', filter) AS dataset FROM phot",
    "stars": """SELECT p_partkey AS star_id, 267e0 + ((p_partkey*7919) % 100003)/100003e0 AS ra,
        -30e0 + ((p_partkey*104729) % 99991)/99991e0 AS dec,
        CASE WHEN p_partkey % 4 = 0 THEN 'None' ELSE concat('G', CAST(p_partkey AS varchar)) END AS gaia_source_id FROM part""",
    "sky_stars": """SELECT star_id, ra, dec FROM stars UNION ALL SELECT star_id + 1000000, CASE WHEN ra < 267.5e0 THEN ra - 267.5e0 + 360e0 ELSE ra - 267.5e0 END, dec + 29.5e0 FROM stars
        UNION ALL SELECT star_id + 2000000, (ra - 267e0)*360e0, 90e0 - (dec + 30e0)/2e0 FROM stars""",
    "star_mags": """SELECT star_id, CASE WHEN size = 7 THEN 0e0 ELSE g0 END AS g, 5e-3 + (star_id % 13)/4e2 AS g_err,
        CASE WHEN size = 11 THEN 0e0 ELSE g0 - 3e-1 - (star_id % 17)/2e1 END AS r, 4e-3 + (star_id % 11)/5e2 AS r_err,
        CASE WHEN size = 13 THEN 0e0 ELSE g0 - 5e-1 - (star_id % 23)/2e1 END AS i, 3e-3 + (star_id % 7)/6e2 AS i_err, size
        FROM (SELECT p_partkey AS star_id, p_size AS size, 14e0 + (p_retailprice % 800)/1e2 AS g0 FROM part)""",
    "catalog2": """SELECT star_id + 10000000000 AS star_id,
        ra + (CASE WHEN star_id % 5 = 0 THEN 6e0 ELSE ((star_id*31) % 7 - 3)*2e-1 END)/3600e0 AS ra, dec FROM stars
        UNION ALL SELECT star_id + 20000000000, ra + (5e-1 + (star_id % 11)*3e-1)/3600e0, dec FROM stars""",
    "targets": """SELECT c_custkey AS target_id, 267e0 + ((c_custkey*7919) % 100003)/100003e0 + (c_custkey % 9)/7200e0 AS ra,
        -30e0 + ((c_custkey*104729) % 99991)/99991e0 AS dec FROM customer""",
    "star_pixels": """SELECT p_partkey AS star_id, ((p_partkey*7919) % 40960)/1e1 AS x, ((p_partkey*104729) % 40961)/1e1 AS y,
        p_retailprice * (1 + p_size) AS flux FROM part""",
    "detections": """SELECT CAST(p_size % 4 AS int) AS image_id, star_id, x, y, flux, CAST(3600 + (p_size % 4)*300 AS int) AS width, CAST(4500 - (p_size % 4)*400 AS int) AS height
        FROM star_pixels JOIN part ON p_partkey = star_id""",
    "images": """SELECT o_orderkey AS image_id, 1e0 + (o_custkey % 30)/1e1 AS fwhm, o_totalprice/2e1 AS sky,
        CAST(o_custkey % 200 AS int) AS nstars, (o_orderkey % 100)/1e2 AS moon_fraction,
        (o_orderkey % 180)*1e0 AS moon_distance FROM orders""",
    "pixels": """SELECT vec_id AS image_id, CAST((i-1) % 8 AS int) AS x, CAST(floor((i-1)/8) AS int) AS y,
        CAST(embedding[i] AS double)*1000 AS v FROM embeddings, range(1, 65) t(i)""",
    "ev": """SELECT event_id, ts, user_id AS star_id, event_type AS filter, value AS flux, props FROM events""",
}
NEEDS = {"valid": ["phot"], "dataset_phot": ["phot"], "catalog2": ["stars"], "detections": ["star_pixels"], "sky_stars": ["stars"]}


def with_views(*names: str, extra: str = "") -> str:
    """``WITH`` clause for the named views and what they need."""
    order: list[str] = []

    def add(n: str) -> None:
        for need in NEEDS.get(n, []):
            add(need)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    text = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    return f"WITH {text}{(', ' + extra) if extra else ''}\n"


def r6(expr: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"(round({expr}, {digits}) + 0e0)"


def sep_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Haversine distance in degrees."""
    return (
        f"degrees(2*asin(least(1e0, sqrt(pow(sin(radians({dec2}-({dec1}))/2), 2) + "
        f"cos(radians({dec1}))*cos(radians({dec2}))*pow(sin(radians({ra2}-({ra1}))/2), 2)))))"
    )
