"""Joins that keep images apart, stamps and boxes per image, and covers of the sky across RA 0 and at the poles."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators import crossmatch, sequences as seq, stats
from skyloom.operators.match import box, cone, match_one_to_one, nearest_within, pairs_within, pixels_of
from skyloom.sources import tables
from tests.test_match import sep_deg

STARS = "image_id string, star_id long, x double, y double, flux double"


def frames(seed=3, n=400):
    rng = np.random.default_rng(seed)
    image = rng.choice(["a", "b", "c", None], n)
    left = pd.DataFrame({"image_id": image, "star_id": np.arange(n) % 120, "x": rng.uniform(0, 60, n), "y": rng.uniform(0, 60, n), "flux": rng.uniform(0, 9, n)})
    right = left.assign(x=left.x + rng.normal(0, 1, n), y=left.y + rng.normal(0, 1, n))
    return left.drop_duplicates(["image_id", "star_id"]), right.drop_duplicates(["image_id", "star_id"])


def same(a, b):
    return a == b or (a is None and b is None)


@pytest.mark.parametrize("limit", [4, 10_000_000])
def test_pairs_stay_within_their_image(spark, hot, limit):
    left, right = frames()
    want = {
        (i, a, b) for i, a, x, y, _ in left.itertuples(index=False) for j, b, u, v, _ in right.itertuples(index=False)
        if same(i, j) and (x - u) ** 2 + (y - v) ** 2 <= 9
    }
    metric = pixels_of("image_id")
    ls, rs = spark.createDataFrame(left, STARS), spark.createDataFrame(right, STARS)
    with hot(limit):
        got = pairs_within(ls, rs, 3.0, metric).select("l.image_id", "l.star_id", "r.star_id").collect()
        near = nearest_within(ls, rs, 3.0, "star_id", "star_id", metric, strict=False).select("l.image_id", "l.star_id", "r.star_id", "sep").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    # ids repeat between images, and every star of every image has its own nearest partner
    assert {(r[0], r[1]) for r in near} == {(i, a) for i, a, _ in want}
    place = {(i, s): (x, y) for i, s, x, y, _ in right.itertuples(index=False)}
    for i, a, b, sep in near:
        x, y = left[(left.star_id == a) & (left.image_id.isna() if i is None else left.image_id == i)][["x", "y"]].values[0]
        assert sep == pytest.approx(min(np.hypot(x - u, y - v) for (j, _), (u, v) in place.items() if same(i, j)))


def test_one_to_one_per_image(spark):
    rows = [("a", 1, 5.0, 5.0, 1.0), ("b", 1, 5.0, 5.0, 1.0), (None, 1, 5.0, 5.0, 1.0)]
    d = spark.createDataFrame(rows, STARS)
    got = match_one_to_one(d, d, 1.0, "star_id", "star_id", pixels_of("image_id"))
    assert {(r[0], r[1]) for r in got.select("l.image_id", "r.image_id").collect()} == {("a", "a"), ("b", "b"), (None, None)}


def test_stamps_keep_equal_detections_and_stars_outside(spark):
    stamps = spark.createDataFrame([("a", 5000, 5000), ("b", 900, 900)], "image_id string, w int, h int").select("image_id", F.inline(crossmatch.stamp_array("w", "h", 1010, 1010, 10)))
    rows = [("a", 1, 4500.0, 4500.0, 1.0), ("a", 1, 4500.0, 4500.0, 1.0), ("a", 2, 4999.5, 1.0, 1.0), ("b", 1, 899.0, 1.0, 1.0), ("b", 2, 900.0, 1.0, 1.0), ("b", 3, -1.0, 5.0, 1.0), ("c", 1, 1.0, 1.0, 1.0), ("a", 4, None, 1.0, 1.0)]
    got = crossmatch.assign_stamps(spark.createDataFrame(rows, STARS), stamps, keys=("image_id",))
    assert sorted((r["image_id"], r["star_id"], -1 if r["stamp_id"] is None else r["stamp_id"]) for r in got.collect()) == [
        ("a", 1, 24), ("a", 1, 24), ("a", 2, 4), ("a", 4, -1), ("b", 1, 0), ("b", 2, -1), ("b", 3, -1), ("c", 1, -1)]


def test_crowding_brightest_and_nearest_per_image(spark):
    # the companion of star 1 is on another image, and a companion without flux disturbs nobody
    grid = [(i, 100 + k, float(k % 5) * 20, float(k // 5) * 20, 1.0) for i in "ab" for k in range(25)]
    rows = [*grid, ("a", 1, 45.0, 45.0, 10.0), ("b", 2, 46.0, 45.0, 1.0), ("a", 3, 32.0, 32.0, 5.0), ("a", 4, 33.0, 32.0, 0.0)]
    d = spark.createDataFrame(rows, STARS)
    got = {(r["image_id"], r["star_id"]) for r in crossmatch.crowding_filter(d, "star_id", 3.0, 0.5, keys=("image_id",)).collect()}
    assert {("a", 1), ("b", 2), ("a", 3), ("a", 4)} <= got
    faint = crossmatch.crowding_filter(d, "star_id", 3.0, 0.5, max_stars=1, keys=("image_id",)).collect()
    assert {(r["image_id"], r["star_id"]) for r in faint} == {("a", 4), ("b", 2)}
    bright = crossmatch.brightest_within(d.where("star_id in (1, 2)"), d, 20.0, "star_id", "star_id", keys=("image_id",)).collect()
    assert {(r["image_id"], r["det_id"], r["ref_id"]) for r in bright} == {("a", 1, 1), ("b", 2, 2)}
    places = spark.createDataFrame([("a", 44.0, 44.0), ("b", 44.0, 44.0)], "image_id string, x0 double, y0 double")
    assert {(r["image_id"], r["star_id"]) for r in crossmatch.nearest_to(d, places, ["image_id"], "star_id").collect()} == {("a", 1), ("b", 2)}


def test_central_box_and_offset_per_image(spark):
    rng = np.random.default_rng(1)
    rows = [("a", k, float(x), float(y), 1.0) for k, (x, y) in enumerate(rng.uniform(-100, 100, (300, 2)))] + [("b", 0, 0.0, 0.0, 1.0), ("b", 1, 60.0, 0.0, 1.0)]
    out = seq.central_region(spark.createDataFrame(rows, STARS), [20.0, 50.0, 100.0], 50, 150, ("image_id",)).collect()
    assert {r["box"] for r in out if r["image_id"] == "a"} == {2}
    # no box of b holds 50 stars: the one that misses by least, here the middle one with both
    assert {(r["star_id"], r["box"]) for r in out if r["image_id"] == "b"} == {(0, 2), (1, 2)}
    pairs = spark.createDataFrame([("a", 1.2, 0.1), ("a", 1.3, 0.2), ("a", -3.0, 0.0), ("b", -2.2, 4.1)], "image_id string, dx double, dy double")
    got = {r["image_id"]: (r["offset_x"], r["offset_y"], r["votes"]) for r in stats.offset_peak(pairs, "dx", "dy", 5.0, 0.5, ("image_id",)).collect()}
    assert got == {"a": (1.25, 0.25, 2), "b": (-2.25, 4.25, 1)}


FIELDS = [(0.02, 0.01, 0.3), (359.99, -0.2, 0.3), (180.0, 89.95, 0.3), (75.0, 89.0, 0.9), (12.0, -90.0, 0.5), (200.0, 10.0, 100.0), (0.0, 60.0, 1.0)]


def whole_sky():
    rng = np.random.default_rng(8)
    ra = np.concatenate([rng.uniform(0, 360, 1500), rng.uniform(-1, 1, 1500) % 360, rng.uniform(0, 360, 1500), [0.0, 360.0, 0.0]])
    dec = np.concatenate([np.degrees(np.arcsin(rng.uniform(-1, 1, 1500))), rng.uniform(-1, 1, 1500), rng.choice([-1, 1], 1500) * (90 - rng.uniform(0, 2, 1500)), [0.0, 0.0, 90.0]])
    return pd.DataFrame({"star_id": np.arange(len(ra)), "ra": ra, "dec": dec})


def test_cones_and_boxes_anywhere_match_brute_force(spark):
    stars = whole_sky()
    df = spark.createDataFrame(stars).cache()
    for ra, dec, radius in FIELDS:
        want = set(stars.star_id[sep_deg(stars.ra, stars.dec, ra, dec) <= radius])
        assert {r["star_id"] for r in cone(df, ra, dec, radius).collect()} == want
    for a, b, c, d in [(359.5, 0.5, -0.5, 0.5), (-0.5, 0.5, -1.0, 0.0), (10.0, 20.0, 89.0, 90.0), (350.0, 370.0, -95.0, 95.0), (0.0, 360.0, 88.0, 90.0)]:
        inside = (stars.ra - a) % 360 <= (b - a if b >= a else b - a + 360)
        want = set(stars.star_id[(inside | (b - a >= 360)) & stars.dec.between(c, d)])
        assert {r["star_id"] for r in box(df, a, b, c, d).collect()} == want
    df.unpersist()


def test_zones_of_a_cone_reach_the_scan(spark, tmp_path):
    stars = whole_sky()
    path = tables.write_catalogue(spark.createDataFrame(stars), str(tmp_path / "zones"), zone=1.0)
    stored = spark.read.schema("star_id bigint, ra double, dec double, zone int").parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for ra, dec, radius in FIELDS[:5]:
        out = tables.read_catalogue_cone(stored, ra, dec, radius, zone=1.0)
        assert {r["star_id"] for r in out.collect()} == set(stars.star_id[sep_deg(stars.ra, stars.dec, ra, dec) <= radius])
        low, high = sky.cone_cover(ra, dec, radius).zones(1.0)
        plan = out._jdf.queryExecution().toString()
        assert re.search(rf"PartitionFilters: \[.*zone#\d+ >= {low}\), \(zone#\d+ <= {high}\)", plan)
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
        assert "GreaterThanOrEqual(dec," in pushed
        # two parts of the RA range across 0, none where the circle holds a pole
        assert ("Or(" in pushed) == (radius > abs(ra - 360 * round(ra / 360)) and abs(dec) < 89) and ("(ra," in pushed) == (abs(dec) + radius < 90)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_tables_that_overlap_a_box_across_zero(spark):
    extents = spark.createDataFrame([("west", 350.0, 360.0, -5.0, 5.0), ("east", 0.0, 10.0, -5.0, 5.0), ("far", 100.0, 110.0, -5.0, 5.0)], "name string, ra_min double, ra_max double, dec_min double, dec_max double")
    assert {r["name"] for r in tables.overlapping_tables(extents, 355.0, 2.0, 0.0, 1.0).collect()} == {"west", "east"}
