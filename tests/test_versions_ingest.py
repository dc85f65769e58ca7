"""Tables under one manifest, the field index that only grows, and the ingest that stores."""

import os

import pytest
from pyspark.sql import functions as F

from skyloom.operators import crossmatch, ingest
from skyloom.sources.versions import Spec, TableSet

SPECS = {"a": Spec("k bigint, v string", ("k",)), "b": Spec("id bigint, w double", number="id")}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, values, schema="k bigint, v string"):
    return spark.createDataFrame(values, schema)


def test_batches_replace_by_key_and_repeat_without_effect(spark, tmp_path):
    t = TableSet(spark, str(tmp_path), SPECS)
    assert rows(t.read("a")) == [] and t.next_number("b") == 1
    numbered = t.numbered("b", frame(spark, [(2.5,), (1.5,)], "w double"), ["w"])
    assert t.commit("one", {"a": frame(spark, [(1, "x"), (2, "y"), (None, "n")]), "b": numbered})
    assert t.commit("two", {"a": frame(spark, [(2, "z"), (None, None), (3, "p"), (3, "q")])})
    files = sorted(os.listdir(tmp_path / "a"))
    again = TableSet(spark, str(tmp_path), SPECS)
    assert not again.commit("one", {"a": frame(spark, [(1, "lost")])}) and sorted(os.listdir(tmp_path / "a")) == files
    want = [(1, "x"), (2, "z"), (3, "q")]
    assert sorted(r for r in rows(again.read("a").where("k is not null"))) == want and again.read("a").where("k is null").collect()[0]["v"] is None
    assert rows(again.read("b")) == [(1, 1.5), (2, 2.5)] and again.next_number("b") == 3
    assert again.compacted("a") and len(again.folders("a")) == 1 and rows(again.read("a").where("k is not null")) == want
    assert not again.compacted("a")


def test_a_failed_batch_and_a_second_writer_leave_no_trace(spark, tmp_path):
    one, two = (TableSet(spark, str(tmp_path), SPECS) for _ in range(2))
    bad = frame(spark, [(1, "x")]).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        one.commit("first", {"b": frame(spark, [(7, 1.0)], "id bigint, w double"), "a": bad})
    assert rows(one.refresh().read("b")) == [] and not one.done("first")
    assert one.commit("first", {"b": frame(spark, [(7, 1.0)], "id bigint, w double")})
    with pytest.raises(Exception, match="exist"):
        two.commit("second", {"b": frame(spark, [(1, 2.0)], "id bigint, w double")})
    assert rows(two.refresh().read("b")) == [(7, 1.0)] and two.next_number("b") == 8
    assert two.commit("second", {"b": frame(spark, [(8, 2.0)], "id bigint, w double")})


def test_field_index_writes_only_what_a_dataset_adds(spark, tmp_path):
    stars = "star_id long, ra double, dec double"
    primary = frame(spark, [(k, k / 100.0, d) for k, d in enumerate([-89.9, -30.0, 0.0, 0.0, 45.0, 89.9])], stars)
    field = crossmatch.FieldIndex.start(primary, "p", str(tmp_path))
    for n in range(3):
        # one star meets field star 3, one is new
        field.add_dataset(frame(spark, [(10 + n, 0.03 + 1e-5, 0.0), (20 + n, 200.0 + n, 10.0)], stars), f"d{n}", 1e-3)
    field.add_dataset(frame(spark, [(99, 5.0, 5.0)], stars), "d1", 1e-3)
    assert rows(field.members.where("dataset != 'p'").select("field_id", "dataset", "dataset_star_id")) == [
        (3, "d0", 10), (3, "d1", 11), (3, "d2", 12), (6, "d0", 20), (7, "d1", 21), (8, "d2", 22)]
    assert field.stars.count() == 9 and rows(field.stars.where("field_id > 5").select("field_id", "ra")) == [(6, 200.0), (7, 201.0), (8, 202.0)]
    added = [spark.read.parquet(f).count() for f in field.tables.folders("stars")]
    assert added == [6, 1, 1, 1] and [spark.read.parquet(f).count() for f in field.tables.folders("members")] == [6, 2, 2, 2]
    # a dataset without new stars and an empty one
    field.add_dataset(frame(spark, [(1, 0.03, 0.0)], stars), "d3", 1e-3).add_dataset(frame(spark, [], stars), "d4", 1e-3)
    assert field.stars.count() == 9 and crossmatch.FieldIndex.open(spark, str(tmp_path)).members.count() == 13


def test_field_stars_of_untouched_zones_are_not_read(spark, tmp_path):
    stars = "star_id long, ra double, dec double"
    field = crossmatch.FieldIndex.start(frame(spark, [(k, 10.0, -80.0 + 10 * k) for k in range(16)], stars), "p", str(tmp_path))
    df = field.tables.read("stars").where(F.col("zone").isin([180, 181]))
    assert "PartitionFilters: [zone#" in df._jdf.queryExecution().toString().replace("cast(", "") and df.count() == 1


def test_ingest_stores_everything_once(spark, tmp_path):
    db = ingest.open_database(spark, str(tmp_path))
    stars = frame(spark, [(5, 10.0, 0.0), (3, 11.0, 0.0)], "star_id long, ra double, dec double")
    phot = frame(spark, [(5, 1, 1, 15.0, 0.1), (5, 1, 2, 15.5, 0.1), (3, 1, 1, 16.0, 0.1), (4, 1, 1, 17.0, 0.1)], "star_id long, image_id long, seq int, mag double, mag_err double")
    stamps = frame(spark, [(0, 0, 9, 0, 9)], "stamp_id int, x_min int, x_max int, y_min int, y_max int")
    params = {"facility_code": "lsc", "filter_name": "gp", "code_name": "stage3", "version": "1", "ref_filename": "r.fits", "filename": "i.fits"}
    for _ in range(2):
        ingest.ingest_reference(db, "one", params, stars, phot, stamps, True, 1e-3)
    assert rows(db.read("stars").select("star_id", "star_index", "refimg_id")) == [(1, 3, 1), (2, 5, 1)]
    assert rows(ingest.live(db, "phot").select("refimg_id", "star_id", "mag")) == [(1, 1, 16.0), (1, 2, 15.5)]
    other = frame(spark, [(70, 10.0, 1e-4), (71, 50.0, 0.0)], "star_id long, ra double, dec double")
    seen = frame(spark, [(70, 2, 1, 15.1, 0.1), (71, 2, 1, 18.0, 0.1)], "star_id long, image_id long, seq int, mag double, mag_err double")
    for name, file in (("two", "s.fits"), ("three", "t.fits")):
        ingest.ingest_reference(db, name, params | {"filter_name": "rp", "ref_filename": file}, other, seen, stamps, False, 1e-3)
    db = ingest.open_database(spark, str(tmp_path))
    # the later reference image of the filter takes the place of the earlier one, with all that hangs on it
    assert rows(ingest.live(db, "phot").select("refimg_id", "star_id", "image_id", "mag")) == [(1, 1, 1, 16.0), (1, 2, 1, 15.5), (3, 2, 2, 15.1)]
    assert rows(db.read("reference_images").select("refimg_id", "filename", "is_primary")) == [(1, "r.fits", True), (3, "t.fits", False)]
    assert rows(ingest.live(db, "stamps").select("refimg_id")) == [(1,), (3,)] and rows(ingest.live(db, "reference_components").select("component_id", "refimg_id")) == [(1, 1), (3, 3)]
    assert db.read("facilities").count() == 1 and db.read("filters").count() == 2 and db.read("software").count() == 1 and db.read("images").count() == 1
    assert rows(ingest.live(db, "matches").where("refimg_id = 3").select("dataset_star_id", "star_id")) == [(70, 2)]
