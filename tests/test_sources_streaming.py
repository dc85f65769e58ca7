"""Reading, writing and streams."""

import json
import os

from pyspark.sql import functions as F

from skyloom.schemas import DATABASE, FIELD_BUNDLE
from skyloom.session import scratch_path
from skyloom.sources import tables, textfiles
from skyloom.streaming import runs, transforms as st


def phot(spark, n=400):
    return spark.range(n).select(
        (F.col("id") % 20).alias("star_id"), F.col("id").alias("image_id"), (F.lit(2455555.0) + F.col("id")).alias("hjd"), F.lit(17.0).alias("mag"),
        (F.col("id") % 4 + 1).cast("int").alias("quadrant"), F.when(F.col("id") % 2 == 0, "gp").otherwise("rp").alias("filter"),
    )


def test_versions_stay_and_predicates_prune(spark):
    path = scratch_path(spark, "t")
    tables.write_timeseries(phot(spark), path, 1, ["quadrant", "filter"])
    tables.write_timeseries(phot(spark).withColumn("mag", F.lit(18.0)), path, 2, ["quadrant", "filter"])
    one = tables.read_timeseries(spark, path, 1)
    assert one.count() == 400 and one.agg(F.max("mag")).first()[0] == 17.0
    assert tables.read_timeseries(spark, path, 2).agg(F.min("mag")).first()[0] == 18.0
    plan = tables.star_slice(one.where("quadrant = 1"), 8)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(quadrant" in plan and "EqualTo(star_id,8)" in plan


def test_one_hot_partition_is_written_by_several_files(spark):
    import glob

    path = scratch_path(spark, "t")
    same = phot(spark, 4000).withColumn("quadrant", F.lit(1)).withColumn("filter", F.lit("gp"))
    tables.write_timeseries(same, path, 1, ["quadrant", "filter"], files=4)
    assert len(glob.glob(f"{path}/version=1/quadrant=1/filter=gp/*.parquet")) >= 3


def test_bundle_fills_missing_columns(spark):
    path = scratch_path(spark, "b")
    tables.save_bundle({"stars": spark.createDataFrame([(1, 2.0, 3.0)], "field_id int, ra double, dec double")}, path, FIELD_BUNDLE)
    row = tables.load_bundle(spark, path, FIELD_BUNDLE, ["stars"])["stars"].first()
    assert row["field_id"] == 1 and row["quadrant"] is None and row["gaia_source_id"] is None


def test_database_tables_are_created_once(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS skyloom_test LOCATION '{tmp_path}/db'")
    tables.ensure_tables(spark, "skyloom_test", DATABASE)
    tables.ensure_tables(spark, "skyloom_test", DATABASE)
    assert {r["tableName"] for r in spark.sql("SHOW TABLES IN skyloom_test").collect()} == set(DATABASE)
    spark.sql("DROP DATABASE skyloom_test CASCADE")


def test_region_overlap_and_box(spark):
    extents = spark.createDataFrame([("a", 10.0, 12.0, 0.0, 2.0), ("b", 20.0, 22.0, 0.0, 2.0), ("c", 10.0, 12.0, 5.0, 7.0)], "name string, ra_min double, ra_max double, dec_min double, dec_max double")
    assert {r["name"] for r in tables.overlapping_tables(extents, 11.0, 30.0, 1.0, 1.5).collect()} == {"a", "b"}


def test_lightcurve_layouts(spark):
    rows = phot(spark, 60).select(
        "star_id", F.lit("lsc_ip").alias("dataset"), "filter", "hjd", F.col("mag").alias("inst_mag"), F.lit(0.01).alias("inst_mag_err"), F.col("mag").alias("cal_mag"),
        F.lit(0.02).alias("cal_mag_err"), F.lit(1.0).alias("pscale"), F.lit(0.1).alias("pscale_err"), F.lit(0).alias("qc_flag"),
    )
    want = {(r["star_id"], r["hjd"]) for r in rows.collect()}
    for per_star in (False, True):
        path = textfiles.write_lightcurves(rows, scratch_path(spark, "lc"), per_star=per_star)
        got = textfiles.read_lightcurves(spark, path, per_star=per_star).collect()
        assert {(r["star_id"], r["hjd"]) for r in got} == want and {r["dataset"] for r in got} == {"lsc_ip"}
    csv = textfiles.write_lightcurves(rows, scratch_path(spark, "lc"), "csv")
    assert spark.read.option("header", True).csv(csv).columns == ["star_id", "dataset", "time", "filter", "magnitude", "error"]


def test_text_tables_and_configuration(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# head\n 1  2.5 x\n\n 2 bad y\n")
    rows = textfiles.read_whitespace_table(spark, str(tmp_path / "t.txt"), {"a": (0, "int"), "b": (1, "double"), "c": (2, "string"), "d": (3, "int")}).collect()
    assert [tuple(r) for r in rows] == [(1, 2.5, "x", None), (2, None, "y", None)]
    (tmp_path / "c.json").write_text(json.dumps({"plots": {"value": "True", "comment": "c", "format": "bool", "unit": ""}}, indent=2))
    assert textfiles.read_config(spark, str(tmp_path / "c.json")).select("key", textfiles.boolean_value().alias("b")).first() == ("plots", True)
    (tmp_path / "targets.json").write_text(json.dumps({"ev1": {"ra": 1.0, "dec": 2.0, "radius": 0.1}}))
    assert tuple(textfiles.read_targets(spark, str(tmp_path / "targets.json")).first()) == ("ev1", 1.0, 2.0, 0.1)
    (tmp_path / "list.txt").write_text("d1 primary_ref\nd2 non_ref\n")
    assert {tuple(r) for r in textfiles.read_dataset_list(spark, str(tmp_path / "list.txt")).collect()} == {("d1", 1), ("d2", 0)}


def test_search_results_have_one_form(spark, tmp_path):
    hits = spark.range(25_000).select(F.when(F.col("id") < 3, 2).otherwise(1).cast("bigint").alias("target_id"), F.col("id").alias("star_id"), F.lit(10.0).alias("ra"), F.lit(20.0).alias("dec"), F.lit(3).alias("quadrant"), (F.col("id") / 1e6).alias("sep"))
    targets = spark.createDataFrame([(1, 10.0, 20.0, "x"), (2, 11.0, 21.0, None)], "target_id long, ra double, dec double, comment string")
    path = textfiles.write_search_results(hits, targets, "target_id", 0.5, str(tmp_path / "out"))
    back = spark.read.json(path)
    assert back.count() == 25_000 and back.select("search_radius_deg", "quadrant").distinct().collect() == [(0.5, 3)]
    few = back.where("target_id = 2").orderBy("field_id").collect()
    assert [(r["field_id"], r["target_data"]["ra"], r["separation_deg"]) for r in few] == [(0, 11.0, 0.0), (1, 11.0, 1e-6), (2, 11.0, 2e-6)]


def test_repeated_batch_changes_nothing(spark):
    table = runs.update_table(spark, scratch_path(spark, "u"), "k int, v double, at int", ["k"], ["at"])
    write = runs.batch_writer(table)
    first = spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 1)], "k int, v double, at int")
    second = spark.createDataFrame([(2, 9.0, 1), (2, 5.0, 2)], "k int, v double, at int")
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        write(batch, number)
    assert {(r["k"], r["v"]) for r in runs.latest(table).collect()} == {(1, 1.0), (2, 5.0)}
    assert len(table.folders("updates")) == 2


def test_fifty_batches_leave_few_folders(spark):
    table = runs.update_table(spark, scratch_path(spark, "u"), "k int, v int", ["k"])
    write, most = runs.batch_writer(table, every=4), 0
    for n in range(50):
        write(spark.createDataFrame([(n % 7, n), (100 + n, n)], "k int, v int").coalesce(1), n)
        most = max(most, len(table.folders("updates")))
        if n == 20:
            # a retry of an old batch, and a new session that goes on
            write(spark.createDataFrame([(0, -1)], "k int, v int"), 11)
            table = runs.update_table(spark, table.path, "k int, v int", ["k"])
            write = runs.batch_writer(table, every=4)
    # three or fewer of each of the levels 0, 1, 2
    assert most <= 9 and len(table.folders("updates")) == 5
    got = {r["k"]: r["v"] for r in runs.latest(table).collect()}
    assert got == {n % 7: n for n in range(50)} | {100 + n: n for n in range(50)}
    on_disk = [f for f in os.listdir(os.path.join(table.path, "updates")) if f.startswith("commit=")]
    assert len(on_disk) <= 15


def test_stream_restart_reads_only_new_files(spark):
    folder, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    row = "SELECT CAST({} AS bigint) AS event_id, TIMESTAMP'2024-01-01 00:00:00' AS ts, CAST(1 AS bigint) AS star_id, 'g' AS filter, 1e0 AS flux, '' AS props"
    for n in (1, 2):
        spark.sql(row.format(n)).write.mode("append").parquet(folder)
        runs.run_append(runs.file_stream(spark, folder), out, state)
    runs.run_append(runs.file_stream(spark, folder), out, state)
    assert sorted(r["event_id"] for r in spark.read.schema(runs.EVENTS).parquet(out).collect()) == [1, 2]


def test_late_rows_are_routed(spark):
    folder, path, state = (scratch_path(spark, n) for n in ("in", "late", "state"))
    for n, day in ((1, 10), (2, 20), (3, 5), (4, 19)):
        spark.sql(f"SELECT CAST({n} AS bigint) AS event_id, TIMESTAMP'2024-01-{day:02d} 00:00:00' AS ts, CAST(1 AS bigint) AS star_id, 'g' AS filter, 1e0 AS flux, '' AS props").write.mode("append").parquet(folder)
        runs.run_batches(runs.file_stream(spark, folder), st.split_late(path, "2 DAYS"), checkpoint=state)
    ids = {r: sorted(x["event_id"] for x in spark.read.parquet(f"{path}/{r}").collect()) for r in ("on_time", "late")}
    assert ids == {"on_time": [1, 2, 4], "late": [3]}
