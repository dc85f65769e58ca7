"""Dimension tables, dataset bookkeeping and image status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from skyloom.operators.ordering import with_row_index
from skyloom.operators.skew import join_groups, pick_first, pick_last
from skyloom.session import stored

# fixed values: order of preference for the primary reference dataset
APERTURE_ORDER = ["1m0", "2m0", "0m4"]
FILTER_ORDER = ["ip", "rp", "gp"]
SITE_ORDER = ["lsc", "ogg", "cpt", "elp", "tfn", "coj"]

STAGES = list(range(8))


def insert_if_absent(existing: DataFrame, new: DataFrame, search_key: str, arrival: str) -> DataFrame:
    """Rows of ``new`` whose key is unknown, the first arrival per key, appended to ``existing``."""
    fresh = pick_first(new.join(existing.select(search_key), search_key, "left_anti"), [search_key], [F.col(arrival)])
    return existing.unionByName(fresh.select(*existing.columns))


def upsert_last_wins(existing: DataFrame, new: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """INSERT OR REPLACE: the row with the highest arrival number per key, as a combinable aggregate."""
    return pick_last(existing.unionByName(new), keys, [F.col(arrival)])


def update_cells(base: DataFrame, patch: DataFrame, key: list[str], columns: list[str], order: list[str] | None = None, set_null: bool = False) -> DataFrame:
    """Base table with the cells of a patch table put over it.

    Of several patches of a row the last by ``order`` counts, whole: cells of different patches are
    never mixed (without an order the largest by its columns is the last). A null cell of the patch leaves
    the old value, or with ``set_null`` takes its place.
    """
    last = pick_last(patch, key, [F.col(c) for c in order or columns], columns)
    renamed = last.select(*key, F.struct(*columns).alias("_new"))
    joined = join_groups(base, renamed, key, "left")
    there = F.col("_new").isNotNull()

    def cell(c: str) -> Column:
        new = F.col(f"_new.{c}")
        return (F.when(there, new).otherwise(F.col(c)) if set_null else F.coalesce(new, F.col(c))).alias(c)

    return joined.select(*[cell(c) if c in columns else F.col(c) for c in base.columns])


def wide_to_pairs(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Parameter columns as (name, value) rows of text."""
    return df.select(*key, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(key, columns, "name", "value")


def pairs_to_wide(df: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    return df.groupBy(*key).pivot("name", names).agg(F.first("value"))


def pairs_to_map(df: DataFrame, key: list[str]) -> DataFrame:
    """One map per key; its size is the number of parameters."""
    return df.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("parameters"))


def cascade_delete(tables: dict[str, tuple[DataFrame, str]], deleted: DataFrame, id_column: str) -> dict[str, DataFrame]:
    """Every child table without the rows that refer to a deleted id."""
    return {
        name: df.join(deleted.select(F.col(id_column).alias(ref)), ref, "left_anti") for name, (df, ref) in tables.items()
    }


def resolve_names(facts: DataFrame, dimensions: dict[str, DataFrame], strict: bool = True) -> DataFrame:
    """Names replaced by ids: column ``x`` becomes ``x_id`` from a dimension table (x, x_id), for all dimensions in one pass.

    Of several rows of a name the last one, with the highest id, counts. Rows without a name keep a
    null id. ``strict`` raises if a name is unknown, as the lookup does, and the error names the first
    unknown name of each dimension; the misses are counted while the resolved rows are written, so the facts
    are read once. Otherwise unknown names get null ids.
    """
    out, misses = facts, []
    for name, dim in dimensions.items():
        last = dim.groupBy(name).agg(F.max(f"{name}_id").alias(f"{name}_id"))
        out = out.join(last, name, "left")
        missing = F.col(name).isNotNull() & F.col(f"{name}_id").isNull()
        misses += [F.count_if(missing).alias(f"{name}_n"), F.min(F.when(missing, F.col(name).cast("string"))).alias(f"{name}_first")]
    if not strict or not dimensions:
        return out.drop(*dimensions)
    seen = Observation()
    resolved = stored(out.observe(seen, *misses).drop(*dimensions))
    unknown = [f"{name} {seen.get[f'{name}_first']!r} ({seen.get[f'{name}_n']} rows)" for name in dimensions if seen.get[f"{name}_n"]]
    if unknown:
        raise ValueError(f"unknown names in the facts: {', '.join(unknown)}")
    return resolved


def preference_rank(value, order: list[str]) -> Column:
    """Position in a preference list, its length if absent."""
    out = F.lit(len(order))
    for n, item in reversed(list(enumerate(order))):
        out = F.when(F.col(value).contains(item), n).otherwise(out)
    return out


def choose_by_preference(datasets: DataFrame, group: list[str], aperture: str, filter_: str, site: str, code: str) -> DataFrame:
    """One dataset per group by aperture, filter, site; ``n_best`` above 1 means the choice is not unique."""
    ranked = datasets.select(
        *group, code,
        F.struct(
            preference_rank(aperture, APERTURE_ORDER).alias("a"), preference_rank(filter_, FILTER_ORDER).alias("f"),
            preference_rank(site, SITE_ORDER).alias("s"),
        ).alias("rank"),
    )
    per_rank = ranked.groupBy(*group, "rank").agg(F.min(code).alias(code), F.count("*").alias("n_best"))
    return pick_first(per_rank, group, [F.col("rank")], [code, "n_best"])


def cascade_status(status: DataFrame, image: str = "image_id") -> DataFrame:
    """Status with −1 carried to every later stage. An image has one row per stage, eight at most."""
    upto = Window.partitionBy(image).orderBy("stage").rowsBetween(Window.unboundedPreceding, 0)
    return status.withColumn("status", F.when(F.min("status").over(upto) == -1, -1).otherwise(F.col("status")))


def set_status(status: DataFrame, updates: DataFrame, image: str = "image_id", refuse_unknown: bool = False, order: list[str] | None = None) -> DataFrame:
    """Status after an update table (image, stage, status), cascaded.

    Unknown images are added with zeros, or refused: then the error names the first of them. Of several
    updates of a stage the last by ``order`` counts.
    """
    unknown = updates.select(image).distinct().join(status.select(image).distinct(), image, "left_anti")
    if refuse_unknown:
        first = unknown.agg(F.min(image).alias("first"), F.count("*").alias("n")).first()
        if first["n"]:
            raise ValueError(f"status of {first['n']} unknown images, the first is {first['first']!r}")
        return cascade_status(update_cells(status, updates, [image, "stage"], ["status"], order), image)
    added = unknown.select(image, F.explode(F.array(*[F.lit(s) for s in STAGES])).alias("stage"), F.lit(0).alias("status"))
    return cascade_status(update_cells(status.unionByName(added), updates, [image, "stage"], ["status"], order), image)


def pending_images(images: DataFrame, status: DataFrame, stage: int, process_missing: bool = True, rerun_all: bool = False) -> DataFrame:
    """Images not done at a stage, with those absent from the status table if wanted."""
    here = status.where(F.col("stage") == stage)
    known = images.select("image_id").join(here.select("image_id", "status"), "image_id")
    todo = known if rerun_all else known.where(F.col("status") == 0)
    out = todo.select("image_id")
    if process_missing:
        out = out.unionByName(images.select("image_id").join(here.select("image_id"), "image_id", "left_anti"))
    return out


def header_fields(df: DataFrame, json_column: str, fields: dict[str, str], keep: list[str]) -> DataFrame:
    """Configured header fields out of a JSON header, null where missing."""
    return df.select(*keep, *[F.get_json_object(json_column, f"$.{path}").alias(name) for name, path in fields.items()])


def dominant_filter(*columns: str) -> Column:
    """First filter wheel entry that is neither air nor None."""
    return F.coalesce(*[F.when(~F.lower(F.col(c)).contains("air") & ~F.col(c).contains("None"), F.col(c)) for c in columns])


def route_images(headers: DataFrame, separate_instruments: bool = True) -> DataFrame:
    """Dataset code of every image from its header columns."""
    target = F.replace(F.replace(F.col("object"), F.lit("/"), F.lit("")), F.lit(" "), F.lit("-"))
    instrument = F.lower(F.replace(F.replace(F.col("instrument"), F.lit("/"), F.lit("")), F.lit("fl"), F.lit("fa")))
    filt = F.coalesce(F.col("filter"), dominant_filter("filter1", "filter2", "filter3"))
    if separate_instruments:
        place = F.concat_ws("-", F.lower("site"), F.lower("enclosure"), F.lower("telescope"), instrument)
        code = F.concat_ws("_", target, place, filt)
    else:
        code = F.when(instrument.contains("fa"), F.concat_ws("_", target, filt)).otherwise(F.concat_ws("_", target, instrument, filt))
    return headers.withColumn("dataset", code)


def image_table(headers: DataFrame, image_stats: DataFrame, status: DataFrame) -> DataFrame:
    """Headers, statistics and quality flag (−1 if a stage 0..6 failed) under one running index."""
    failed = status.where("stage <= 6").groupBy("image_id").agg(F.min("status").alias("_worst"))
    joined = headers.join(image_stats, "image_id", "left").join(failed, "image_id", "left")
    flagged = joined.withColumn("qc_flag", F.when(F.col("_worst") == -1, -1).otherwise(0)).drop("_worst")
    return with_row_index(flagged, ["dataset", "image_id"], "image_index")


def stage_durations(lines: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """First and last time stamp of each log file and the seconds between them."""
    stamp = F.try_to_timestamp(F.regexp_extract(line, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})", 1), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    # the zone cancels in the difference; text keeps the result independent of it
    spans = lines.select(file, stamp.cast("timestamp_ntz").alias("t")).where("t is not null").groupBy(file).agg(
        F.min("t").alias("first"), F.max("t").alias("last")
    )
    return spans.withColumn("seconds", F.timestamp_diff("SECOND", F.col("first"), F.col("last")))
