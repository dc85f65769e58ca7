"""Values that real tables hold and clean ones do not: zeros, NaN, nulls, malformed codes."""

import math

import pytest
from pyspark.sql import functions as F

from skyloom.functions import phot as p, stellar, text, transforms, weights
from skyloom.operators import calibrate, catalog, match, quality, sequences, stats
from skyloom.operators.quantiles import aggregate_with_quantiles, grouped_quantiles
from skyloom.plans import base, streams  # noqa: F401
from skyloom.sources import textfiles


@pytest.mark.parametrize("limit", [1, 3, 10_000_000])
def test_quantiles_mean_the_same_on_both_sides_of_the_limit(spark, hot, limit):
    rows = [(1, float(v)) for v in (1, 2, 4)] + [(1, math.nan), (1, None)] + [(None, float(v)) for v in (5, 7, 9, 11)] + [(2, math.nan)]
    df = spark.createDataFrame(rows, "k long, v double")
    with hot(limit):
        got = {r.k: list(r.q) if r.q is not None else None for r in grouped_quantiles(df, ["k"], "v", [0.5, 1.0]).collect()}
        counted = {r.k: r.n for r in aggregate_with_quantiles(df, ["k"], [F.count("*").alias("n")], {"q": ("v", [0.5])}).collect()}
    assert got == {1: [2.0, 4.0], None: [8.0, 11.0], 2: None} and counted == {1: 5, None: 4, 2: 1}


def test_quantiles_beside_far_outliers(spark, hot, monkeypatch):
    monkeypatch.setattr("skyloom.operators.quantiles.FINAL_ROWS", 50)
    values = [17 + i / 1e4 for i in range(4_000)] + [5e3, 1e6, 1e12]
    df = spark.createDataFrame([(1, v) for v in values], "k long, v double")
    with hot(10):
        got = grouped_quantiles(df, ["k"], "v", [0.0, 0.25, 0.5, 1.0]).first().q
    assert got == pytest.approx([17.0, 17.10005, 17.2001, 1e12], rel=1e-12)


def test_cells_have_a_limit_of_their_own(spark, hot):
    from skyloom.operators.skew import HOT_CONF

    spark.conf.set(HOT_CONF, "4000000")
    assert match._cell_limit(spark.range(1)) == match.HOT_CELL_ROWS
    spark.conf.unset(HOT_CONF)


def test_zero_divisors_give_null(spark):
    one = spark.range(1)
    zero, number = F.lit(0.0), F.lit(2.0)
    sdss = transforms.johnson_to_sdss({"bv": zero, "bv_err": number, "v": number, "v_err": number})
    row = one.select(
        stellar.band_reddening(zero, number, F.lit(3.1), next(iter(stellar.RV_TABLE)))[1].alias("a"), *[c.alias(k) for k, c in sdss.items()],
        p.flux_to_mag(zero, number)[0].alias("mag"), p.flux_to_mag(number, number, exposure=zero)[0].alias("no_exposure"),
    ).first()
    assert row.a is None and row.mag == 0.0 and row.no_exposure == 0.0
    scaled = spark.createDataFrame([(1.0, 0.0), (0.0, 2.0), (3.0, 2.0)], "scale double, exposure double")
    assert [r[0] for r in scaled.select(quality.scale_per_exposure("scale", "exposure", 4.0)).collect()] == [None, None, 6.0]
    weightless = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "x double, w double")
    assert weightless.agg(weights.centroid("x", "w")).first()[0] is None


def test_constant_stars_single_points_and_collinear_pairs(spark):
    flat = spark.createDataFrame([(1, float(t), 15.0, 0.1) for t in range(5)] + [(2, 1.0, 14.0, 0.1)], "star_id long, hjd double, mag double, mag_err double")
    feats = {r.star_id: r for r in stats.star_features(flat, ["star_id"], "hjd", "mag", "mag_err").collect()}
    assert set(feats) == {1, 2} and feats[1].skewness is None and feats[1].amplitude == 0
    points = spark.createDataFrame([("a", 1.0, 2.0), ("b", 0.0, 1.0), ("b", 1.0, 3.0), ("b", 2.0, 5.0), (None, 0.0, 0.0), (None, 1.0, 1.0)], "d string, x double, y double")
    fits = {r.d: r for r in calibrate.fit_line(points, ["d"], "x", "y").collect()}
    assert fits["a"].a is None and fits["b"].a == pytest.approx(2.0)
    line = spark.createDataFrame([("d", float(i), float(i), float(i), float(i)) for i in range(4)], "d string, x double, y double, u double, v double")
    assert [r.a11 for r in calibrate.affine_fit(line, ["d"], 1.0).collect()] in ([], [None])


def test_groups_without_a_key_are_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    assert {r.k: (r.median, r.mad) for r in stats.median_mad(df, ["k"], "v").collect()} == {None: (2.0, 1.0), "a": (5.0, 0.0)}


def test_malformed_codes_and_names(spark):
    df = spark.createDataFrame([("FIELD_lsc-doma-1m0-05-fa15_ip",), ("odd",), ("",), (None,), ("a_b",)], "code string")
    rows = df.select(*[c.alias(k) for k, c in text.dataset_parts("code").items()]).collect()
    assert rows[0].telescope == "1m0" and rows[1].site is None and rows[3].field is None and rows[4].enclosure is None
    images = spark.createDataFrame([("odd", "ip", 1.0, 1.0, 1.0), ("a-b-c-d", "gp", 1.0, 1.0, 1.0)], "name string, filter string, fwhm_x double, fwhm_y double, sky double")
    assert sequences.image_trios(images, 5.0, 5.0).count() == 0


def test_isochrones_of_targets_without_colour(spark):
    rows = spark.createDataFrame([(0.5, 0.2, 1.0, 3.7, 4.4, 5.0)], "gr double, ri double, mass double, log_teff double, logg double, age double")
    targets = spark.createDataFrame([(1, 0.5, 0.2), (2, None, 0.2), (3, math.nan, 0.2)], "target long, gr double, ri double")
    got = {r.target: r.mass for r in sequences.nearest_isochrone(targets, rows, "target", 0.1).collect()}
    assert got == {1: 1.0, 2: None, 3: None}


def test_nulls_keep_their_place_in_written_light_curves(spark, tmp_path):
    names = list(textfiles.LIGHTCURVE_FIELDS)
    rows = spark.createDataFrame(
        [(1, "d", 2450000.5, 15.0, 0.1, None, None, 1.0, 0.1, 0), (1, None, 2450001.5, None, 0.1, 14.0, 0.2, None, 0.1, None)],
        "star_id long, dataset string, hjd double, inst_mag double, inst_mag_err double, cal_mag double, cal_mag_err double, pscale double, pscale_err double, qc_flag int",
    )
    path = textfiles.write_lightcurves(rows, str(tmp_path / "curves"))
    back = textfiles.read_lightcurves(spark, path).select("star_id", "dataset", *names)
    assert sorted(back.collect(), key=repr) == sorted(rows.select("star_id", "dataset", *names).collect(), key=repr)


def test_several_patches_for_a_cell(spark):
    base = spark.createDataFrame([(1, 5), (2, 6)], "k long, v long")
    patch = spark.createDataFrame([(1, 7), (1, 9), (1, None)], "k long, v long")
    assert sorted(catalog.update_cells(base, patch, ["k"], ["v"]).collect()) == [(1, 9), (2, 6)]


def test_the_id_of_one_star_reaches_the_scan(spark, tmp_path):
    rows = [(s, float(t), 15.0, 0.01, 1.0) for s in range(50) for t in range(4)]
    spark.createDataFrame(rows, "star_id long, hjd double, mag double, mag_err double, pscale double").write.parquet(str(tmp_path / "phot"))
    spark.createDataFrame([(s, 267.0 + s / 100, -30.0) for s in range(50)], "star_id long, ra double, dec double").write.parquet(str(tmp_path / "stars"))
    phot, stars = spark.read.parquet(str(tmp_path / "phot")), spark.read.parquet(str(tmp_path / "stars"))
    from skyloom.operators.lightcurves import extract_lightcurve

    out = extract_lightcurve(phot, stars, 267.1, -30.0, 0.004)
    assert {r.star_id for r in out.collect()} == {10} and out.count() == 4
    assert "ubquery" in out._jdf.queryExecution().toString()
    assert extract_lightcurve(phot, stars, 10.0, 10.0, 0.004).count() == 0


@pytest.fixture
def no_small_tables(spark):
    """Catalyst and AQE broadcast nothing by themselves."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def joins(df, kind):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if kind in line]


def test_rows_of_few_groups_are_not_shuffled_by_their_group(spark, no_small_tables):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 9.0), (None, 4.0), ("b", 5.0)], "k string, v double")
    clipped = stats.sigma_clip(df, ["k"], "v", 3.0, 1)
    peak = stats.background_peak(df, ["k"], "v")
    assert not joins(clipped, "SortMergeJoin") and not joins(peak, "SortMergeJoin")
    assert {r.k: r.n_peak for r in peak.collect()} == {"a": 1, None: 1, "b": 1}
    assert {r.k: (r.median, r.mad) for r in stats.median_mad(df, ["k"], "v").collect()} == {"a": (2.0, 1.0), None: (4.0, 0.0), "b": (5.0, 0.0)}


def test_hot_groups_are_found_without_a_shuffle_of_their_rows(spark, hot, no_small_tables):
    df = spark.range(300).selectExpr("IF(id % 10 = 0, 'rare', 'hot') AS k", "CAST(id AS double) AS v")
    with hot(100):
        out = stats.grouped_quantiles(df, ["k"], "v", [0.5])
        assert not [line for line in joins(out, "SortMergeJoin") if "LeftAnti" in line or "LeftSemi" in line]
        assert {r.k: r.q[0] for r in out.collect()} == {"rare": 145.0, "hot": 150.0}


def test_one_row_of_a_colour_stands_for_all_in_the_search(spark, monkeypatch):
    seen, search = [], sequences.nearest_within
    monkeypatch.setattr(sequences, "nearest_within", lambda left, right, *a, **k: (seen.append(right.count()), search(left, right, *a, **k))[1])
    rows = spark.range(60).selectExpr("2e8 AS age", "1D + id AS mass", "3.5D AS log_teff", "4D AS logg", "id % 2 / 1e1 AS gr", "0D AS ri")
    targets = spark.createDataFrame([(1, 0.01, 0.0), (2, 0.09, 0.0)], "target long, gr double, ri double")
    got = {r.target: (r.n, r.mass) for r in sequences.nearest_isochrone(targets, rows, "target", 0.01).collect()}
    assert got == {1: (30, 30.0), 2: (30, 31.0)} and seen == [2]


def test_colours_of_a_stream_with_a_flux_of_zero(spark, tmp_path):
    rows = [(1, "10:00", 7, "click", 5.0), (2, "10:30", 7, "purchase", 0.0), (3, "10:40", 7, "purchase", 50.0), (4, "10:50", 7, "purchase", None)]
    events = spark.createDataFrame([(e, f"2024-01-02 {at}:00", s, f, v) for e, at, s, f, v in rows], "event_id long, at string, user_id long, event_type string, value double")
    events.selectExpr("event_id", "CAST(at AS timestamp_ntz) AS ts", "user_id", "event_type", "value", "'' AS props").write.parquet(str(tmp_path / "events.parquet"))
    got = {(r.event1, r.event2): r.colour for r in base.QUERIES["stream_interval_join"](spark, str(tmp_path)).collect()}
    assert got == {(1, 2): float("-inf"), (1, 3): 2.5, (1, 4): None}
