"""Streams over the event table, replayed in time order from files, and the UDF surface."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from skyloom.functions import timing, weights as w
from skyloom.functions.common import num, settled
from skyloom.operators import calibrate as cal, udfs
from skyloom.plans.base import Tables, query, r6, with_views
from skyloom.session import scratch_path
from skyloom.streaming import runs, transforms as st

DAY = "strftime(date_trunc('day', ts), '%Y-%m-%d')"
ERR = "(sqrt(flux)/1e1 + 1e-2)"
SHOW = "yyyy-MM-dd"


def instants(t: Tables) -> DataFrame:
    """Events with their time as an instant, as a stream needs it."""
    return t.events.withColumn("ts", timing.as_instant("ts"))


def shown(ts: str, pattern: str):
    return F.date_format(timing.as_utc_clock(ts), pattern)


def replay(t: Tables, run: Callable[[str, str], None], extra: DataFrame | None = None, delayed: bool = False, closing: bool = False) -> None:
    """Drops files of events in time order and runs the stream after each drop, always with one checkpoint.

    ``run`` gets the folder and the checkpoint. ``delayed`` keeps one event in twenty for the last
    drop; ``closing`` ends with a row far in the future that moves the watermark past all windows.
    """
    folder, state = scratch_path(t.spark, "events"), scratch_path(t.spark, "state")
    day = F.dayofmonth(timing.as_utc_clock("ts"))
    drop = F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2)
    if delayed:
        drop = F.when(F.col("event_id") % 20 == 0, 3).otherwise(drop)
    tagged = instants(t).withColumn("_drop", drop)
    drops = [tagged.where(F.col("_drop") == n).drop("_drop") for n in range(4 if delayed else 3)]
    if extra is not None:
        drops.append(extra)
    if closing:
        drops.append(
            instants(t).agg(F.max("ts").alias("ts")).select(
                F.lit(-1).cast("bigint").alias("event_id"), F.expr("ts + INTERVAL 3 YEARS").alias("ts"), F.lit(-1).cast("bigint").alias("star_id"),
                F.lit("closing").alias("filter"), F.lit(1.0).alias("flux"), F.lit(None).cast("string").alias("props"),
            )
        )
    for rows in drops:
        rows.write.mode("append").parquet(folder)
        run(folder, state)


def appended(t: Tables, build: Callable[[DataFrame], DataFrame], schema: str, **how) -> DataFrame:
    """Result table of an append-mode stream over the replayed events."""
    out = scratch_path(t.spark, "result")
    replay(t, lambda folder, state: runs.run_append(build(runs.file_stream(t.spark, folder)), out, state), **how)
    return t.spark.read.schema(schema).parquet(out)


def updated(t: Tables, build: Callable[[DataFrame], DataFrame], schema: str, keys: list[str], mode: str, order: list | None = None, **how) -> DataFrame:
    """Current state of the updates of a stream over the replayed events."""
    table = runs.update_table(t.spark, scratch_path(t.spark, "updates"), schema, keys, order)
    replay(t, lambda folder, state: runs.run_batches(build(runs.file_stream(t.spark, folder)), runs.batch_writer(table), mode, state), **how)
    return runs.latest(table)


@query("stream_new_images", with_views("ev") + f"SELECT event_id, star_id, {r6('flux')} AS flux FROM ev")
def stream_new_images(t: Tables):
    """The folder is read, gets more files and is read again with the same checkpoint: every row once."""
    done = appended(t, lambda d: d.select("event_id", "star_id", "flux"), "event_id bigint, star_id bigint, flux double")
    return done.select("event_id", "star_id", settled("flux").alias("flux"))


@query("stream_dedupe", with_views("ev") + f"SELECT event_id, star_id, filter, {r6('flux')} AS flux FROM ev")
def stream_dedupe(t: Tables):
    """A second delivery of the last twenty days is recognised."""
    again = instants(t).where(F.dayofmonth(timing.as_utc_clock("ts")) > 10)
    got = appended(t, lambda d: st.dedupe(d, ["event_id", "star_id"], "40 days"), runs.EVENTS, extra=again)
    return got.select("event_id", "star_id", "filter", settled("flux").alias("flux"))


@query("stream_upsert", with_views("ev") + f"SELECT star_id, filter, {DAY} AS day, arg_max(event_id, (ts, event_id)) AS event_id, {r6('arg_max(flux, (ts, event_id))')} AS flux FROM ev GROUP BY ALL")
def stream_upsert(t: Tables):
    """The last measurement per star, filter and day, by batches that may be repeated."""
    schema = "star_id bigint, filter string, day string, event_id bigint, flux double, ts timestamp"

    def keyed(d: DataFrame) -> DataFrame:
        return d.select("star_id", "filter", shown("ts", SHOW).alias("day"), "event_id", "flux", "ts")

    now = updated(t, keyed, schema, ["star_id", "filter", "day"], "append", ["ts", "event_id"])
    return now.select("star_id", "filter", "day", "event_id", settled("flux").alias("flux"))


@query("stream_tumbling_bins", with_views("ev") + f"SELECT {DAY} AS day, star_id, filter, count(*) AS n, {r6(f'sum(flux/({ERR}*{ERR}))/sum(1/({ERR}*{ERR}))')} AS mean_flux, {r6(f'sqrt(1/sum(1/({ERR}*{ERR})))')} AS mean_err FROM ev GROUP BY ALL")
def stream_tumbling_bins(t: Tables):
    """Updates of day bins; the last update of a bin is its value."""
    schema = "day string, star_id bigint, filter string, n bigint, mean_flux double, mean_err double"

    def bins(d: DataFrame) -> DataFrame:
        binned = st.tumbling_bins(st.with_error(d), ["star_id", "filter"], "1 day", "2 days")
        return binned.select(shown("window.start", SHOW).alias("day"), "star_id", "filter", "n", "mean_flux", "mean_err")

    now = updated(t, bins, schema, ["day", "star_id", "filter"], "update")
    return now.select("day", "star_id", "filter", "n", settled("mean_flux").alias("mean_flux"), settled("mean_err").alias("mean_err"))


@query("stream_sliding_lookback", with_views("ev", extra="d AS (SELECT filter, date_trunc('day', ts) AS day, count(*) AS n, sum(flux) AS f FROM ev GROUP BY ALL)")
    + f"SELECT filter, strftime(day + to_days(CAST(1 - k AS int)), '%Y-%m-%d') AS first_day, CAST(sum(n) AS bigint) AS n, {r6('sum(f)', 4)} AS total FROM d, range(1, 31) r(k) GROUP BY ALL")
def stream_sliding_lookback(t: Tables):
    """Counts in windows of thirty days that move by one day."""
    def lookback(d: DataFrame) -> DataFrame:
        wide = st.sliding_lookback(d, ["filter"], "30 days", "1 day", "1 day")
        return wide.select("filter", shown("window.start", SHOW).alias("first_day"), "n", "total")

    got = appended(t, lookback, "filter string, first_day string, n bigint, total double", closing=True)
    return got.where("filter != 'closing'").select("filter", "first_day", "n", settled("total", 4).alias("total"))


@query("stream_session_visits", with_views("ev", extra="""g AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 60 MINUTE THEN 0 ELSE 1 END AS b FROM ev WINDOW w AS (PARTITION BY star_id ORDER BY ts)),
    s AS (SELECT *, sum(b) OVER (PARTITION BY star_id ORDER BY ts, event_id) AS visit FROM g)""")
    + "SELECT star_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, count(*) AS n, array_to_string(list_sort(list_distinct(list(filter))), ',') AS filters FROM s GROUP BY star_id, visit")
def stream_session_visits(t: Tables):
    """Visits of a star: measurements less than an hour apart."""
    clock = "yyyy-MM-dd HH:mm:ss"

    def visits(d: DataFrame) -> DataFrame:
        v = st.session_visits(d, ["star_id"], "60 minutes", "1 day")
        v = v.select("star_id", "n", F.array_join("filters", ",").alias("filters"), F.col("session_window.start").alias("a"), F.expr("session_window.end - INTERVAL 60 MINUTES").alias("b"))
        return v.select("star_id", shown("a", clock).alias("first"), shown("b", clock).alias("last"), "n", "filters")

    return appended(t, visits, "star_id bigint, first string, last string, n bigint, filters string", closing=True).where("star_id >= 0")


@query("stream_late_data", with_views("ev") + "SELECT event_id, CASE WHEN event_id % 20 = 0 AND ts < (SELECT max(ts) FROM ev WHERE event_id % 20 <> 0) - INTERVAL 2 DAY THEN 'late' ELSE 'on_time' END AS route FROM ev")
def stream_late_data(t: Tables):
    """One event in twenty arrives after all others; those more than two days behind are routed aside."""
    path = scratch_path(t.spark, "late")
    replay(t, lambda folder, state: runs.run_batches(runs.file_stream(t.spark, folder), st.split_late(path, "2 DAYS"), "append", state), delayed=True)
    parts = [t.spark.read.schema(runs.EVENTS).parquet(f"{path}/{r}").select("event_id", F.lit(r).alias("route")) for r in ("on_time", "late")]
    return parts[0].unionByName(parts[1])


@query("stream_running_stats", with_views("ev", extra=f"m AS (SELECT star_id, sum(flux/({ERR}*{ERR}))/sum(1/({ERR}*{ERR})) AS wm FROM ev GROUP BY star_id)")
    + f"SELECT star_id, count(*) AS n, {r6('any_value(wm)')} AS wmean, {r6(f'sqrt(1/sum(1/({ERR}*{ERR})))')} AS werror, {r6(f'sqrt(sum((flux-wm)*(flux-wm)/({ERR}*{ERR}))/sum(1/({ERR}*{ERR})))', 5)} AS wrms FROM ev JOIN m USING (star_id) GROUP BY star_id")
def stream_running_stats(t: Tables):
    """Weighted statistics per star, updated with every batch."""
    schema = "star_id bigint, n bigint, wmean double, werror double, wrms double"
    now = updated(t, lambda d: st.running_sums(st.with_error(d), ["star_id"], 20.0), schema, ["star_id"], "update")
    return now.select("star_id", "n", settled("wmean").alias("wmean"), settled("werror").alias("werror"), settled("wrms", 5).alias("wrms"))


@query("stream_static_enrich", with_views("ev", "stars") + f"SELECT event_id, star_id, {r6('ra')} AS ra, {r6('dec')} AS dec, {r6('flux')} AS flux FROM ev JOIN stars USING (star_id)")
def stream_static_enrich(t: Tables):
    positions = t.stars.select("star_id", "ra", "dec")
    got = appended(
        t, lambda d: st.enrich(d, positions, "star_id").select("event_id", "star_id", "ra", "dec", "flux"),
        "event_id bigint, star_id bigint, ra double, dec double, flux double",
    )
    return got.select("event_id", "star_id", *[settled(c).alias(c) for c in ("ra", "dec", "flux")])


@query("stream_interval_join", with_views("ev") + f"SELECT a.event_id AS event1, b.event_id AS event2, a.star_id, {r6('-25e-1*log10(a.flux/b.flux)')} AS colour FROM ev a JOIN ev b ON a.star_id = b.star_id AND a.filter = 'click' AND b.filter = 'purchase' AND b.ts BETWEEN a.ts - INTERVAL 60 MINUTE AND a.ts + INTERVAL 60 MINUTE")
def stream_interval_join(t: Tables):
    """Measurements of one star in two filters within an hour, as a colour."""
    columns = ["event_id", "ts", "star_id", "flux"]
    out = scratch_path(t.spark, "pairs")

    def run(folder: str, state: str) -> None:
        one = runs.file_stream(t.spark, folder).where("filter = 'click'").select(*columns)
        two = runs.file_stream(t.spark, folder).where("filter = 'purchase'").select(*columns)
        pairs = st.interval_pairs(one, two, "star_id", 60, "2 days")
        # a flux of 0 in the second filter gives the quotient of floating-point numbers, as in SQL, not an error under ANSI rules
        quotient = F.when(F.col("flux2") == 0, F.col("flux1") * num(float("inf"))).otherwise(F.col("flux1") / F.col("flux2"))
        colour = -2.5 * F.log10(quotient)
        runs.run_append(pairs.select(F.col("event_id1").alias("event1"), F.col("event_id2").alias("event2"), F.col("star_id1").alias("star_id"), colour.alias("colour")), out, state)

    replay(t, run)
    got = t.spark.read.schema("event1 bigint, event2 bigint, star_id bigint, colour double").parquet(out)
    return got.select("event1", "event2", "star_id", settled("colour").alias("colour"))


@query("udaf_weighted", with_views("valid") + f"SELECT coalesce(site, 'all') AS site, coalesce(filter, 'all') AS filter, count(*) AS n, {r6('sum(mag/(mag_err*mag_err))/sum(1/(mag_err*mag_err))')} AS wmean, {r6('sqrt(1/sum(1/(mag_err*mag_err)))', 8)} AS werror FROM valid GROUP BY CUBE (site, filter)")
def udaf_weighted(t: Tables):
    """The weighted aggregates as named helpers, here over a cube."""
    out = t.valid.cube("site", "filter").agg(F.count("*").alias("n"), w.weighted_mean("mag", "mag_err").alias("wmean"), w.weighted_error("mag_err").alias("werror"))
    return out.select(F.coalesce("site", F.lit("all")).alias("site"), F.coalesce("filter", F.lit("all")).alias("filter"), "n", settled("wmean").alias("wmean"), settled("werror", 8).alias("werror"))


@query("udf_grouped_fit", with_views("valid") + f"SELECT star_id, filter, count(*) AS n, {r6('regr_intercept(mag, hjd-2451000e0)', 5)} AS level, {r6('regr_slope(mag, hjd-2451000e0)', 7)} AS slope FROM valid GROUP BY ALL")
def udf_grouped_fit(t: Tables):
    """A trend per light curve: sums in Spark, the small solves batched in a Pandas UDF."""
    out = cal.polynomial_fit(t.valid, ["star_id", "filter"], "hjd", "mag", 1, 2451000.0)
    return out.select("star_id", "filter", "n", settled(F.col("coefficients")[0], 5).alias("level"), settled(F.col("coefficients")[1], 7).alias("slope"))


@query("udtf_grid", "WITH g AS (SELECT s_suppkey AS dataset_id, -1e0 + i*5e-1 AS dx, -1e0 + j*5e-1 AS dy FROM supplier, range(0, 5) a(i), range(0, 5) b(j) WHERE s_suppkey IS NOT NULL) SELECT dataset_id, dx, dy FROM g")
def udtf_grid(t: Tables):
    """Grid of trial shifts per dataset by a table function in SQL."""
    udfs.register_table_functions(t.spark)
    d = t.raw("supplier").select(F.col("s_suppkey").alias("dataset_id"))
    return t.spark.sql("SELECT dataset_id, g.dx, g.dy FROM {d}, LATERAL shift_grid(-1e0, 1e0, 5e-1) g", d=d)
