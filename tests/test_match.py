"""Proximity joins against brute force, also at the RA wrap, near a pole and in crowded cells."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.operators import crossmatch
from skyloom.operators.match import PIXEL, SKY, cone, match_one_to_one, nearest_within, pairs_within


def sep_deg(a1, d1, a2, d2):
    a1, d1, a2, d2 = (np.radians(x) for x in (a1, d1, a2, d2))
    h = np.sin((d2 - d1) / 2) ** 2 + np.cos(d1) * np.cos(d2) * np.sin((a2 - a1) / 2) ** 2
    return np.degrees(2 * np.arcsin(np.minimum(1, np.sqrt(h))))


def sky_lists(kind, seed=0, n=300):
    rng = np.random.default_rng(seed)
    if kind == "field":
        ra, dec = rng.uniform(267, 267.2, n), rng.uniform(-30, -29.8, n)
    elif kind == "wrap":
        ra, dec = (rng.uniform(-0.1, 0.1, n)) % 360, rng.uniform(-0.1, 0.1, n)
    else:
        ra, dec = rng.uniform(0, 360, n), rng.uniform(89.9, 90, n)
    left = pd.DataFrame({"lid": np.arange(n), "ra": ra, "dec": dec})
    right = pd.DataFrame({"rid": np.arange(n), "ra": (ra + rng.normal(0, 0.003, n) / np.maximum(np.cos(np.radians(dec)), 1e-3)) % 360, "dec": np.clip(dec + rng.normal(0, 0.003, n), -90, 90)})
    return left, right


@pytest.mark.parametrize("kind", ["field", "wrap", "pole"])
@pytest.mark.parametrize("limit", [5, 10_000_000])
def test_pairs_match_brute_force(spark, hot, kind, limit):
    left, right = sky_lists(kind)
    radius = 0.01
    sep = sep_deg(left.ra.values[:, None], left.dec.values[:, None], right.ra.values[None], right.dec.values[None])
    want = {(i, j) for i, j in zip(*np.where(sep <= radius))}
    with hot(limit):
        got = pairs_within(spark.createDataFrame(left), spark.createDataFrame(right), radius).select("l.lid", "r.rid").collect()
    assert len(got) == len(want)
    assert {(r["lid"], r["rid"]) for r in got} == want


@pytest.mark.parametrize("limit", [4, 10_000_000])
def test_nearest_and_one_to_one_match_greedy_rule(spark, hot, limit):
    left, right = sky_lists("field", 5, 400)
    right = pd.concat([right, right.iloc[:60].assign(rid=lambda d: d.rid + 1000)])  # copies at the same place
    radius = 0.01
    sep = sep_deg(left.ra.values[:, None], left.dec.values[:, None], right.ra.values[None], right.dec.values[None])
    order = np.argsort(right.rid.values)
    nearest = {}
    for i in range(len(left)):
        j = order[np.argmin(sep[i][order])]
        if sep[i, j] < radius:
            nearest[i] = (int(right.rid.values[j]), sep[i, j])
    keep = {}
    for i, (rid, s) in nearest.items():
        if rid not in keep or s < keep[rid][1]:
            keep[rid] = (i, s)
    ls, rs = spark.createDataFrame(left), spark.createDataFrame(right)
    with hot(limit):
        got = {r["lid"]: r["rid"] for r in nearest_within(ls, rs, radius, "lid", "rid").select("l.lid", "r.rid").collect()}
        one = {r["rid"]: r["lid"] for r in match_one_to_one(ls, rs, radius, "lid", "rid").select("l.lid", "r.rid").collect()}
    assert got == {i: rid for i, (rid, _) in nearest.items()}
    assert one == {rid: i for rid, (i, _) in keep.items()}


def test_a_third_of_all_stars_at_one_place(spark, hot):
    """Copies at one position neither multiply nor get lost."""
    n = 600
    left = pd.DataFrame({"lid": np.arange(n), "ra": np.where(np.arange(n) % 3 == 0, 267.0, 267.1 + np.arange(n) * 1e-3), "dec": -29.0})
    right = left.rename(columns={"lid": "rid"})
    with hot(10):
        got = nearest_within(spark.createDataFrame(left), spark.createDataFrame(right), 1e-4, "lid", "rid").select("l.lid", "r.rid").collect()
    assert len(got) == n
    assert all(r["rid"] == (0 if r["lid"] % 3 == 0 else r["lid"]) for r in got)


def test_pixel_pairs(spark, hot):
    rng = np.random.default_rng(3)
    a = pd.DataFrame({"lid": np.arange(200), "x": rng.uniform(-50, 50, 200), "y": rng.uniform(-50, 50, 200)})
    b = pd.DataFrame({"rid": np.arange(200), "x": rng.uniform(-50, 50, 200), "y": rng.uniform(-50, 50, 200)})
    d = np.hypot(a.x.values[:, None] - b.x.values[None], a.y.values[:, None] - b.y.values[None])
    with hot(3):
        got = pairs_within(spark.createDataFrame(a), spark.createDataFrame(b), 4.0, PIXEL).count()
    assert got == int((d <= 4.0).sum())


def test_zone_join_has_no_cartesian_product(spark):
    left, right = sky_lists("field")
    plan = pairs_within(spark.createDataFrame(left), spark.createDataFrame(right), 0.01)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_cone_strictness(spark):
    df = spark.createDataFrame([(1, 10.0, 0.0), (2, 10.0, 1.0), (3, 10.0, 1.1)], "star_id int, ra double, dec double")
    assert {r["star_id"] for r in cone(df, 10.0, 0.0, 1.0).collect()} == {1, 2}
    assert {r["star_id"] for r in cone(df, 10.0, 0.0, 1.05, strict=True).collect()} == {1, 2}


def test_field_fold_gives_ids_in_order(spark):
    primary = spark.createDataFrame([(1, 10.0, 0.0), (2, 10.1, 0.0)], "star_id long, ra double, dec double")
    second = spark.createDataFrame([(7, 10.0 + 1e-4, 0.0), (9, 10.5, 0.0), (8, 10.4, 0.0)], "star_id long, ra double, dec double")
    third = spark.createDataFrame([(1, 10.5, 0.0), (2, 11.0, 0.0)], "star_id long, ra double, dec double")
    field = crossmatch.FieldIndex.start(primary, "a").add_dataset(second, "b", 1e-3).add_dataset(third, "c", 1e-3)
    got = {(r["dataset"], r["dataset_star_id"]): r["field_id"] for r in field.members.collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, ("b", 7): 1, ("b", 8): 3, ("b", 9): 4, ("c", 1): 4, ("c", 2): 5}


def test_closer_match_replaces_and_tie_keeps_first(spark):
    field = spark.createDataFrame([(1, 10.0, 0.0)], "field_id long, ra double, dec double")
    stars = spark.createDataFrame([(5, 10.0002, 0.0), (6, 10.0001, 0.0), (7, 9.9999, 0.0)], "star_id long, ra double, dec double")
    got = match_one_to_one(stars, field, 1e-3, "star_id", "field_id").select("l.star_id").collect()
    assert [r["star_id"] for r in got] in ([6], [7])  # equal distance up to rounding; never the wider one


def test_second_pass_finds_partner_for_the_loser(spark):
    left = spark.createDataFrame([(1, 10.0, 0.0), (2, 10.0001, 0.0)], "star_id long, ra double, dec double")
    right = spark.createDataFrame([(11, 10.00001, 0.0), (12, 9.9995, 0.0)], "cat_id long, ra double, dec double")
    got = {(r["left_id"], r["right_id"], r["round"]) for r in crossmatch.two_pass_match(left, right, 1e-3, "star_id", "cat_id").collect()}
    assert got == {(1, 11, 1), (2, 12, 2)}


def test_identifier_used_once_only(spark):
    d = spark.createDataFrame([(1, 0.0, 0.0, "G1"), (2, 0.0, 0.0, "G2"), (3, 0.0, 0.0, "G2"), (4, 0.0, 0.0, "None")], "star_id long, ra double, dec double, gid string")
    p = spark.createDataFrame([(10, 0.0, 0.0, "G1"), (20, 0.0, 0.0, "G2"), (30, 0.0, 0.0, "None")], "star_id long, ra double, dec double, gid string")
    assert [(r["l"]["star_id"], r["r"]["star_id"]) for r in crossmatch.match_by_identifier(d, p, "gid").collect()] == [(1, 10)]


def test_stamps_cover_the_image_and_last_stamp_wins(spark):
    size = spark.createDataFrame([(4096, 4096)], "w int, h int")
    stamps = size.select(F.inline(crossmatch.stamp_array("w", "h", 1010, 1010, 10)))
    rows = stamps.collect()
    assert len(rows) == 16 and max(r["x_max"] for r in rows) == 4096 and min(r["x_min"] for r in rows) == 0
    stars = spark.createDataFrame([(1, 5.0, 5.0), (2, 1010.0, 5.0), (3, 4095.5, 4095.5)], "star_id long, x double, y double")
    got = {r["star_id"]: r["stamp_id"] for r in crossmatch.assign_stamps(stars, stamps).collect()}
    assert got == {1: 0, 2: 1, 3: 15}
    small = spark.createDataFrame([(500, 300)], "w int, h int").select(F.inline(crossmatch.stamp_array("w", "h", 400, 400, 20))).collect()
    assert [tuple(r) for r in small] == [(0, 0, 500, 0, 300)]


def test_quadrant_border_goes_to_the_later_one(spark):
    field = spark.createDataFrame([(1, 0.0, 0.0), (2, 2.0, 0.0), (3, 2.0, 2.0), (4, 0.0, 2.0), (5, 1.0, 1.0), (6, 1.0, 0.0)], "field_id long, ra double, dec double")
    got = {r["field_id"]: (r["quadrant"], r["quadrant_id"]) for r in crossmatch.assign_quadrants(field).collect()}
    assert got == {1: (1, 1), 2: (2, 1), 3: (3, 1), 4: (4, 1), 5: (4, 2), 6: (2, 2)}


def test_brightest_neighbour_is_used_once(spark):
    det = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 100.0, 0.0)], "star_id long, x double, y double")
    ref = spark.createDataFrame([(10, 0.5, 0.0, 5.0), (11, 2.0, 0.0, 50.0)], "star_id long, x double, y double, flux double")
    got = {(r["det_id"], r["ref_id"]) for r in crossmatch.brightest_within(det, ref, 8.0, "star_id", "star_id").collect()}
    assert got == {(1, 11)}


def test_crowding_ratio_is_star_over_neighbour(spark):
    stars = spark.createDataFrame([(1, 50.0, 50.0, 10.0), (2, 51.0, 50.0, 1.0), (3, 90.0, 90.0, 5.0), (4, 0.0, 0.0, 1.0), (5, 100.0, 100.0, 1.0)], "star_id long, x double, y double, flux double")
    got = {r["star_id"] for r in crossmatch.crowding_filter(stars, "star_id", 3.0, 0.5).collect()}
    assert got == {2, 3}


def test_translate_ids(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "a long")
    mapping = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "a long, b long")
    assert {r["a"]: r["b"] for r in crossmatch.translate_ids(rows, mapping, "a", "b").collect()} == {1: 10, 2: 20, 3: -1}
    assert [r["a"] for r in crossmatch.repeated_ids(mapping, "a").collect()] == [2]


def test_copies_in_cells_meet_by_shuffle(spark, tmp_path):
    """The files of a catalogue say nothing of its copies in cells: no side may be broadcast for its small files."""
    spark.range(2000).selectExpr("id AS star_id", "267 + id % 50 / 1e3 AS ra", "-30 + id / 4e4 AS dec").write.parquet(str(tmp_path / "stars"))
    stars = spark.read.parquet(str(tmp_path / "stars"))
    pairs = pairs_within(stars, stars, 1e-4)
    found = crossmatch.attach_catalogue(stars, stars.select(F.col("star_id").alias("source_id"), "ra", "dec"), [], 1e-4, "star_id", "source_id")
    ids = crossmatch.translate_ids(stars, stars.select("star_id", F.col("star_id").alias("other_id")), "star_id", "other_id")
    for df in (pairs, found, ids):
        assert df.count() == 2000
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_rows_left_over_from_a_match_are_not_found_by_broadcast(spark, tmp_path, monkeypatch):
    plans, keep = [], crossmatch.stored
    monkeypatch.setattr(crossmatch, "stored", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1])
    spark.range(300).selectExpr("id AS star_id", "267 + id / 1e3 AS ra", "-30D AS dec").write.parquet(str(tmp_path / "stars"))
    stars = spark.read.parquet(str(tmp_path / "stars"))
    assert crossmatch.two_pass_match(stars, stars, 1e-4, "star_id", "star_id").count() == 300
    assert len(plans) == 3 and not any("BroadcastHashJoin" in p for p in plans)
