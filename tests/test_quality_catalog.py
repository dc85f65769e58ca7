"""Quality rules and bookkeeping, one small frame per rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import catalog, pixels as px, quality, sequences as seq, stats


def test_reasons_are_all_listed(spark):
    d = spark.createDataFrame([(1, 0, 3.0, 1.0, 13000.0, False), (2, 50, 1.0, 1.0, 6000.0, True), (3, 50, 1.0, 1.0, 100.0, True)], "image_id int, nstars int, sigma_x double, sigma_y double, sky double, pointing_ok boolean")
    out = {r["image_id"]: r for r in quality.assess_images(d).collect()}
    assert (out[1]["use_phot"], out[1]["use_ref"], out[1]["use_image"]) == (0, 0, 0) and out[1]["report"].count(",") == 4
    assert (out[2]["use_phot"], out[2]["use_ref"], out[2]["use_image"]) == (1, 0, 1)
    assert out[3]["report"] == "OK"


def test_pointing(spark):
    d = spark.createDataFrame([("17:45:00", "-00:00:30", "17:45:00", "00:04:00"), ("17:45:00", "-00:02:00", "17:45:00", "00:04:00"), ("N/A", "N/A", "1:0:0", "1:0:0")], "a string, b string, c string, d string")
    got = [r["ok"] for r in d.select(quality.pointing_ok("a", "b", "c", "d", 5 / 60).alias("ok")).collect()]
    assert got == [True, False, True]


def test_shift_limits(spark):
    d = spark.createDataFrame([(1.0, 99.9), (100.0, 0.0), (None, 1.0), (-120.0, 0.0)], "dx double, dy double")
    assert [r["s"] for r in d.select(quality.shift_status("dx", "dy").alias("s")).collect()] == [0, -1, -1, -1]


def test_moon(spark):
    d = spark.createDataFrame([(0.3, 10.0), (0.5, 61.0), (0.5, 60.0), (0.4, 90.0), (0.9, 170.0)], "f double, d double")
    assert [r["m"] for r in d.select(quality.moon_class("f", "d").alias("m")).collect()] == ["dark", "gray", "bright", "bright", "bright"]


def test_reference_rank_prefers_candidates_and_falls_back(spark):
    rows = [("a", 1, 100, 2.0, 500.0, 1, 0.1, 90.0, 60.0), ("a", 2, 100, 4.9, 500.0, 1, 0.1, 90.0, 60.0), ("a", 3, 100, 1.5, 100.0, 1, 0.1, 90.0, 60.0), ("b", 4, 30, 2.0, 500.0, 1, 0.1, 90.0, 60.0), ("b", 5, 20, 2.0, 100.0, 1, 0.1, 90.0, 60.0)]
    d = spark.createDataFrame(rows, "dataset string, image_id int, nstars int, fwhm double, sky double, use_ref int, moon_fraction double, moon_distance double, exposure double")
    got = {(r["dataset"], r["image_id"], r["rank"]) for r in quality.reference_rank(d, ["dataset"], "image_id", 2, 0.8, 1.0, 10.0).collect()}
    assert got == {("a", 3, 1), ("a", 1, 2), ("b", 5, 1)}


def test_bitmask_adds_codes(spark):
    p = spark.createDataFrame(
        [(1, 10, 1, 17.0, 0.01, 1.0), (1, 11, 1, 0.0, 0.01, 1.0), (1, 12, 1, 17.0, 0.01, 0.1), (2, 13, 2, 17.0, 0.01, 1.0), (2, 14, 2, 17.0, 0.01, 1.0)], "star_id int, image_id int, night int, mag double, mag_err double, pscale double"
    )
    images = spark.createDataFrame([(i, 100.0, [1.0, 200.0] if i == 13 else [1.0]) for i in range(10, 15)], "image_id int, exposure double, warp array<double>")
    bad = spark.createDataFrame([(14, 3)], "image_id int, stamp_id int")
    stamps = spark.createDataFrame([(1, 2), (2, 3)], "star_id int, stamp_id int")
    got = {r["image_id"]: r["qc_flag"] for r in quality.qc_bitmask(p, images, bad, stamps, star=["star_id"], residual_image=["night"], reference_exposure=100.0).collect()}
    assert got == {10: 0, 11: 1, 12: 4, 13: 8, 14: 16}


def test_image_with_large_mean_residual_is_flagged(spark):
    rows = [(s, n, n, 17.0 + (1.0 if n == 9 else 0.0), 0.01, 1.0) for s in (1, 2, 3) for n in range(10)]
    p = spark.createDataFrame(rows, "star_id int, image_id int, night int, mag double, mag_err double, pscale double")
    assert [r["night"] for r in quality.bad_images_by_residual(p, ["star_id"], ["night"], 0.15).collect()] == [9]


def test_masks_split_again(spark):
    d = spark.range(32).select([F.getbit("id", F.lit(4 - n)).cast("boolean").alias(f"m{n}") for n in range(5)])
    code = d.withColumn("code", quality.combine_masks([F.col(f"m{n}") for n in range(5)]))
    back = code.select("*", *[c.alias(f"b{n}") for n, c in enumerate(quality.split_masks("code", 5))]).collect()
    assert len({r["code"] for r in back}) == 32 and all(r[f"m{n}"] == bool(r[f"b{n}"]) for r in back for n in range(5))


def test_insert_if_absent_keeps_first_of_new(spark):
    old = spark.createDataFrame([("a", 1, 0)], "k string, v int, n int")
    new = spark.createDataFrame([("a", 9, 1), ("b", 5, 2), ("b", 6, 3)], "k string, v int, n int")
    assert {(r["k"], r["v"]) for r in catalog.insert_if_absent(old, new, "k", "n").collect()} == {("a", 1), ("b", 5)}


def test_upsert_keeps_the_last(spark):
    old = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "k int, v string, n int")
    new = spark.createDataFrame([(2, "z", 2), (2, None, 3)], "k int, v string, n int")
    assert {(r["k"], r["v"]) for r in catalog.upsert_last_wins(old, new, ["k"], "n").collect()} == {(1, "x"), (2, None)}


def test_failed_stage_spreads_and_unknown_image_is_added(spark):
    status = spark.createDataFrame([(1, s, 1) for s in range(8)], "image_id int, stage int, status int")
    updates = spark.createDataFrame([(1, 5, -1), (2, 0, 1)], "image_id int, stage int, status int")
    got = {(r["image_id"], r["stage"]): r["status"] for r in catalog.set_status(status, updates).collect()}
    assert [got[1, s] for s in range(8)] == [1, 1, 1, 1, 1, -1, -1, -1]
    assert [got[2, s] for s in range(8)] == [1, 0, 0, 0, 0, 0, 0, 0]


def test_pending_modes(spark):
    images = spark.createDataFrame([(1,), (2,), (3,)], "image_id int")
    status = spark.createDataFrame([(1, 4, 0), (2, 4, 1)], "image_id int, stage int, status int")
    ids = lambda d: sorted(r["image_id"] for r in d.collect())
    assert ids(catalog.pending_images(images, status, 4)) == [1, 3]
    assert ids(catalog.pending_images(images, status, 4, process_missing=False)) == [1]
    assert ids(catalog.pending_images(images, status, 4, rerun_all=True)) == [1, 2, 3]


def test_preferences_and_ties(spark):
    d = spark.createDataFrame([("f", "1m0", "ip", "coj", "c1"), ("f", "1m0", "ip", "lsc", "c2"), ("f", "2m0", "ip", "lsc", "c3"), ("g", "0m4", "gp", "cpt", "c4"), ("g", "0m4", "gp", "cpt", "c5")], "field string, ap string, fi string, site string, code string")
    got = {r["field"]: (r["code"], r["n_best"]) for r in catalog.choose_by_preference(d, ["field"], "ap", "fi", "site", "code").collect()}
    assert got == {"f": ("c2", 1), "g": ("c4", 2)}


def test_unknown_name_raises_and_is_named(spark):
    facts = spark.createDataFrame([("lsc", "gp"), ("xyz", "gp"), ("abc", None), (None, "gp")], "site string, band string")
    site = spark.createDataFrame([("lsc", 1), ("lsc", 4)], "site string, site_id int")
    band = spark.createDataFrame([("gp", 7)], "band string, band_id int")
    with pytest.raises(ValueError, match=r"site 'abc' \(2 rows\)") as error:
        catalog.resolve_names(facts, {"site": site, "band": band})
    assert "band" not in str(error.value)
    # the last row of a name counts; without names there is nothing to miss
    got = catalog.resolve_names(facts.where("site = 'lsc' or site is null"), {"site": site, "band": band}).collect()
    assert sorted((r["site_id"] or 0, r["band_id"]) for r in got) == [(0, 7), (4, 7)]
    loose = catalog.resolve_names(facts, {"site": site, "band": band}, strict=False).collect()
    assert sorted((r["site_id"] or 0, r["band_id"] or 0) for r in loose) == [(0, 0), (0, 7), (0, 7), (4, 7)]


def test_names_are_resolved_in_one_scan(spark, tmp_path):
    spark.range(100).select((F.col("id") % 3).cast("string").alias("site"), (F.col("id") % 5).cast("string").alias("band")).write.parquet(str(tmp_path / "facts"))
    dims = {n: spark.range(m).select(F.col("id").cast("string").alias(n), F.col("id").alias(f"{n}_id")) for n, m in (("site", 3), ("band", 5))}
    facts = spark.read.parquet(str(tmp_path / "facts"))
    loose = catalog.resolve_names(facts, dims, strict=False)
    assert loose._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert not any("/facts/" in f for f in catalog.resolve_names(facts, dims).inputFiles())


def test_patches_count_whole_and_may_set_null(spark):
    base = spark.createDataFrame([(1, 1, 1), (2, 2, 2), (None, 3, 3), (1, 4, 4)], "k int, v int, w int")
    patch = spark.createDataFrame([(1, 1, 9, 5), (1, 2, 3, None), (None, 1, 7, 7)], "k int, turn int, v int, w int")
    key = lambda r: [x if x is not None else -1 for x in r]
    kept = catalog.update_cells(base, patch, ["k"], ["v", "w"], ["turn"])
    assert sorted(map(tuple, kept.collect()), key=key) == [(None, 7, 7), (1, 3, 1), (1, 3, 4), (2, 2, 2)]
    nulled = catalog.update_cells(base, patch, ["k"], ["v", "w"], ["turn"], set_null=True)
    assert sorted(map(tuple, nulled.collect()), key=key) == [(None, 7, 7), (1, 3, None), (1, 3, None), (2, 2, 2)]


def test_status_of_unknown_images_is_refused(spark):
    status = spark.createDataFrame([("a", s, 0) for s in range(8)], "image_id string, stage int, status int")
    updates = spark.createDataFrame([("a", 2, 1), ("zz", 1, 1), ("b", 1, 1)], "image_id string, stage int, status int")
    with pytest.raises(ValueError, match="2 unknown images, the first is 'b'"):
        catalog.set_status(status, updates, refuse_unknown=True)
    got = {(r["image_id"], r["stage"]): r["status"] for r in catalog.set_status(status, updates.where("image_id = 'a'"), refuse_unknown=True).collect()}
    assert got["a", 2] == 1 and len(got) == 8 and catalog.set_status(status, updates).count() == 24


@pytest.mark.parametrize("lost", [None, 3])
def test_quadrants_with_known_gains_are_levelled(spark, lost):
    rng = np.random.default_rng(3)
    gains = {(0, 0): 1.0, (1, 0): 1.4, (1, 1): 0.7, (0, 1): 1.2}
    rows = []
    for image, scale in (("a", 1.0), (None, 3.0)):
        for x in range(20):
            for y in range(20):
                right, upper = int(x >= 10), int(y >= 10)
                v = scale * 1000 * gains[right, upper] * (1 + rng.normal(0, 0.01)) + (90_000 if (x, y) == (3, 3) else 0)
                rows.append((image, x, y, -1.0 if lost and right and upper else float(v)))
    out = quality.level_quadrants(spark.createDataFrame(rows, "image string, x int, y int, v double"), ["image"], "v", 10, 10, margin=1).collect()
    assert len(out) == len(rows)
    level = {(i, r, u): np.median([p["v"] for p in out if p["image"] == i and (p["x"] >= 10) == r and (p["y"] >= 10) == u]) for i in ("a", None) for r in (0, 1) for u in (0, 1)}
    for (i, r, u), v in level.items():
        if not (lost and r and u):
            assert v == pytest.approx(1000 if i else 3000, rel=0.01), (i, r, u)


def test_cascade_delete(spark):
    parents = spark.createDataFrame([(1,), (2,)], "refimg_id int")
    phot = spark.createDataFrame([(1, 10), (3, 11)], "reference_image int, phot_id int")
    left = catalog.cascade_delete({"phot": (phot, "reference_image")}, parents, "refimg_id")
    assert [r["phot_id"] for r in left["phot"].collect()] == [11]


def test_durations_skip_lines_without_a_stamp(spark):
    lines = spark.createDataFrame([("s0", "2024-01-01T00:00:00 start"), ("s0", ""), ("s0", "no stamp"), ("s0", "2024-01-01T01:00:05 end")], "file string, line string")
    assert catalog.stage_durations(lines).first()["seconds"] == 3605


def test_image_routing(spark):
    h = spark.createDataFrame([("FIELD 01", "LSC", "DOMA", "1m0a", "fl15", None, "air", "gp", "None")], "object string, site string, enclosure string, telescope string, instrument string, filter string, filter1 string, filter2 string, filter3 string")
    assert catalog.route_images(h).first()["dataset"] == "FIELD-01_lsc-doma-1m0a-fa15_gp"
    assert catalog.route_images(h, separate_instruments=False).first()["dataset"] == "FIELD-01_gp"


def test_trios_need_consecutive_numbers_and_three_filters(spark):
    rows = [(f"t-c-20240101-{n:04d}-e", f, 1.0, 1.0, 100.0) for n, f in ((1, "g"), (2, "r"), (3, "i"), (5, "g"), (6, "g"), (7, "r"))]
    d = spark.createDataFrame(rows, "name string, filter string, fwhm_x double, fwhm_y double, sky double")
    got = seq.image_trios(d, 2.0, 5000.0).collect()
    assert [(r["g_image"][-6:-2], r["r_image"][-6:-2], r["i_image"][-6:-2]) for r in got] == [("0001", "0002", "0003")]


def test_labels_of_pixels_are_never_broadcast(spark, monkeypatch):
    plans, keep = [], px.stored
    monkeypatch.setattr(px, "stored", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1])
    rows = [(i, x, y) for i in range(3) for x, y in ((0, 0), (1, 1), (2, 2), (6, 6))]
    got = px.connected_pixels(spark.createDataFrame(rows, "image_id int, x int, y int")).collect()
    assert sorted((r.image_id, r.n_pixels) for r in got) == [(i, n) for i in range(3) for n in (1, 3)]
    assert len(plans) > 2 and not any("BroadcastHashJoin" in p for p in plans)


def test_connected_pixels_follow_a_long_snake(spark):
    snake = [(1, x, 0) for x in range(40)] + [(1, 40, y) for y in range(1, 30)] + [(1, x, 30) for x in range(39, 0, -1)] + [(1, 5, 15), (2, 0, 0)]
    got = sorted((r["image_id"], r["n_pixels"]) for r in px.connected_pixels(spark.createDataFrame(snake, "image_id int, x int, y int")).collect())
    assert got == [(1, 1), (1, 108), (2, 1)]


def test_missing_stamp_gets_the_default(spark):
    p = spark.createDataFrame([(1, 0, 0, 5.0), (1, 1, 0, 7.0)], "image_id int, x int, y int, v double")
    images = spark.createDataFrame([(1,)], "image_id int")
    got = {r["stamp_id"]: (r["median"], r["std"]) for r in px.stamp_statistics(p, images, 2, F.lit(0), 1500.0).collect()}
    assert got == {0: (6.0, 1.0), 1: (-99.0, 15000.0)}


def test_background_peak(spark):
    p = spark.createDataFrame([(1, float(v)) for v in [10] * 50 + [11] * 20 + [500] * 3], "k int, v double")
    assert stats.background_peak(p, ["k"], "v").first()["background"] == pytest.approx(10.0)


def test_hot_groups_do_not_change_statistics(spark, hot):
    d = spark.range(3000).select((F.col("id") % 3).alias("star_id"), (F.lit(17.0) + (F.col("id") * 7 % 101) / 100.0).alias("mag"), F.lit(0.02).alias("mag_err"))
    plain = sorted(stats.star_statistics(d, ["star_id"]).collect())
    with hot(100):
        split = sorted(stats.star_statistics(d, ["star_id"]).collect())
    for a, b in zip(plain, split):
        assert a["n"] == b["n"] and a["prms"] == pytest.approx(b["prms"]) and a["wrms"] == pytest.approx(b["wrms"])


def test_stretches_buffers_and_distances_of_light_curves(spark):
    # two bright stretches of three and four points, one at the very start; the gap of two does not count
    shape = [-5, -5, -5, 0, 0, -5, -5, 0, 0, 0, -5, -5, -5, -5] + [0.001 * (i % 3) for i in range(400)]
    rows = [(None, float(i), 15.0 + 0.1 * v, 0.01) for i, v in enumerate(shape)] + [("b", 0.0, 15.0, 0.1), ("b", 1.0, 15.3, 0.1), ("b", 3.0, 15.3, 0.1)]
    got = {r["k"]: r for r in stats.star_features(spark.createDataFrame(rows, "k string, hjd double, mag double, mag_err double"), ["k"]).collect()}
    assert got[None]["con"] == 2 and got[None]["con2"] == 2 and got[None]["n"] == len(shape) and got[None]["longest_strike_below"] == 4
    mags = np.array([r[2] for r in rows if r[0] is None])
    near = np.abs(mags - np.median(mags)) < np.ptp(mags) / 10
    assert got[None]["median_buffer_range"] == pytest.approx(near.mean()) and got[None]["median_buffer_range2"] == pytest.approx(9 / len(shape))
    assert got["b"]["median_distance"] == pytest.approx((np.hypot(1, 0.3) + 2) / 2) and got["b"]["con"] == 0
    odd = spark.createDataFrame(rows + [("b", 4.0, None, 0.1), ("b", 5.0, float("nan"), 0.1), ("b", 6.0, 15.0, 0.0), ("b", None, 15.0, 0.1), ("b", 7.0, float("inf"), 0.1)], "k string, hjd double, mag double, mag_err double")
    assert stats.remove_all_bad(odd).count() == len(rows)
    put = {(r["k"], r["hjd"]): (r["mag"], r["mag_err"]) for r in stats.normalized(spark.createDataFrame(rows + [("c", 0.0, 9.0, 0.1)], "k string, hjd double, mag double, mag_err double"), ["k"]).collect()}
    assert put["b", 0.0] == (0.0, pytest.approx(1 / 3)) and put["b", 3.0][0] == pytest.approx(1.0) and put["c", 0.0] == (0.0, None)
