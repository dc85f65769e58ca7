"""Fits, offsets and normalization on planted truth."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.operators import calibrate as cal, stats


def test_line_fit_equals_svd_and_scatter(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(15, 21, 400)
    y = 1.03 * x - 0.4 + rng.normal(0, 0.05, 400)
    fit = cal.fit_line(spark.createDataFrame(pd.DataFrame({"x": x, "y": y})), [], "x", "y").first()
    v = np.linalg.svd(np.c_[x - x.mean(), y - y.mean()])[2][0]
    assert fit["a"] == pytest.approx(v[1] / v[0], rel=1e-10)
    assert fit["b"] == pytest.approx(y.mean() - v[1] / v[0] * x.mean(), rel=1e-9)
    r = y - fit["a"] * x - fit["b"]
    cov = np.sum(r**2) / (len(x) - 2) * np.linalg.inv(np.array([[np.sum(x * x), np.sum(x)], [np.sum(x), len(x)]]))
    np.testing.assert_allclose([fit["c00"], fit["c01"], fit["c11"]], [cov[0, 0], cov[0, 1], cov[1, 1]], rtol=1e-6)


def test_flat_line_has_no_slope(spark):
    fit = cal.fit_line(spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "x double, y double"), [], "x", "y").first()
    assert fit["a"] is None


def test_weights_count_like_repeated_points(spark):
    d = spark.createDataFrame([(1.0, 1.1, 3), (2.0, 2.3, 1), (3.0, 2.8, 2)], "x double, y double, w int")
    rep = d.select("x", "y", F.explode(F.sequence(F.lit(1), F.col("w"))))
    a, b = cal.fit_line(d, [], "x", "y", "w").first(), cal.fit_line(rep, [], "x", "y").first()
    assert a["a"] == pytest.approx(b["a"]) and a["c11"] == pytest.approx(b["c11"]) and a["n_points"] == 6


def test_calibration_error_is_the_full_covariance(spark):
    c = spark.createDataFrame([("d", 1.02, -0.3, 1e-4, -2e-5, 4e-4)], "dataset string, a double, b double, c00 double, c01 double, c11 double")
    p = spark.createDataFrame([("d", 18.0, 0.02), ("d", 6.5, 0.02)], "dataset string, mag double, mag_err double")
    out = cal.apply_calibration(p, c, ["dataset"]).orderBy(F.desc("mag")).collect()
    j = np.array([18.0, 1.0])
    want = j @ np.array([[1e-4, -2e-5], [-2e-5, 4e-4]]) @ j + 1.02**2 * 0.02**2
    assert out[0]["cal_mag"] == pytest.approx(18.06) and out[0]["cal_mag_err"] == pytest.approx(np.sqrt(want))
    assert out[1]["cal_mag"] == 0.0 and out[1]["cal_mag_err"] == 0.0


def york(x, y, sx, sy, rounds=200):
    b = np.polyfit(x, y, 1)[0]
    for _ in range(rounds):
        w = 1 / (sy**2 + b**2 * sx**2)
        mx, my = np.sum(w * x) / np.sum(w), np.sum(w * y) / np.sum(w)
        u, v = x - mx, y - my
        beta = w * (u * sy**2 + b * v * sx**2)
        b = np.sum(w * beta * v) / np.sum(w * beta * u)
    return b, my - b * mx


def test_two_error_line(spark):
    rng = np.random.default_rng(8)
    frames, want = [], {}
    for k, slope in ((1, 0.7), (2, 2.5)):
        t = rng.uniform(100, 1000, 200)
        sx, sy = rng.uniform(1, 8, 200), rng.uniform(1, 8, 200)
        x, y = t + rng.normal(0, sx), 30 + slope * t + rng.normal(0, sy)
        frames.append(pd.DataFrame({"k": k, "x": x, "y": y, "sx": sx, "sy": sy}))
        want[k] = york(x, y, sx, sy)
    out = {r["k"]: r for r in cal.source_colour(cal.line_with_two_errors(spark.createDataFrame(pd.concat(frames)), ["k"], "x", "y", "sx", "sy")).collect()}
    for k, (b, a) in want.items():
        assert out[k]["slope"] == pytest.approx(b, rel=1e-6) and out[k]["intercept"] == pytest.approx(a, rel=1e-4)
        assert out[k]["colour"] == pytest.approx(-2.5 * np.log10(b), rel=1e-5) and abs(out[k]["slope"] - (0.7, 2.5)[k - 1]) < 5 * out[k]["slope_err"]


def bins(rows):
    return pd.DataFrame(rows, columns=["star_id", "filter", "site", "bin", "mag", "mag_err"])


def test_planted_offset_is_recovered_in_spite_of_outliers(spark):
    rng = np.random.default_rng(2)
    rows = []
    for star in range(1, 6):
        for b in range(40):
            m = 17 + 0.1 * star
            rows.append((star, "ip", "lsc-doma", b, m + rng.normal(0, 0.005), 0.01))
            rows.append((star, "ip", "coj-doma", b, m - 0.25 + rng.normal(0, 0.005) + (2.0 if b % 10 == 0 else 0.0), 0.01))
    res = cal.dataset_residuals(spark.createDataFrame(bins(rows)), ["lsc-doma", "cpt-doma"])
    out = cal.star_offsets(res, ["reference", "star_id", "filter", "site"]).collect()
    assert len(out) == 5
    for r in out:
        assert r["delta_mag"] == pytest.approx(0.25, abs=0.005) and 0 < r["delta_mag_err"] < 0.02 and r["n_bins"] == 40


def test_fallback_reference_only_where_the_first_is_missing(spark):
    rows = [(1, "ip", s, b, 17.0, 0.01) for s in ("lsc-doma", "cpt-doma", "coj-doma") for b in range(3)]
    rows += [(2, "ip", s, b, 17.0, 0.01) for s in ("cpt-doma", "coj-doma") for b in range(3)]
    out = cal.dataset_residuals(spark.createDataFrame(bins(rows)), ["lsc-doma", "cpt-doma", "coj-doma"])
    got = {(r["reference"], r["star_id"], r["site"]) for r in out.collect()}
    assert got == {("lsc-doma", 1, "cpt-doma"), ("lsc-doma", 1, "coj-doma"), ("cpt-doma", 2, "coj-doma")}


def test_few_bins_give_zero(spark):
    res = spark.createDataFrame([(1, 0.3, 0.01), (1, 0.3, 0.01)], "star_id int, delta double, delta_err double")
    out = cal.star_offsets(res, ["star_id"]).first()
    assert out["delta_mag"] == 0.0 and out["delta_mag_err"] == 0.0


def test_time_bins_are_half_open_days(spark):
    p = spark.createDataFrame([(1, 2455555.0, 17.0, 0.1), (1, 2455555.999, 19.0, 0.1), (1, 2455556.0, 18.0, 0.1), (1, 2455557.5, 0.0, 0.1)], "star_id int, hjd double, mag double, mag_err double")
    got = {r["bin"]: (r["centre"], r["mag"]) for r in cal.time_bins(p, ["star_id"]).collect()}
    assert got == {0: (2455555.5, pytest.approx(18.0)), 1: (2455556.5, pytest.approx(18.0))}


def test_dataset_normalization_recovers_the_line(spark):
    rng = np.random.default_rng(9)
    rows = []
    for star in range(1, 60):
        m = 15 + star * 0.05
        for _ in range(5):
            rows.append((star, "f_lsc", "ip", "lsc-doma", m + rng.normal(0, 0.002), 0.004))
            rows.append((star, "f_coj", "ip", "coj-doma", (m - 0.2) / 1.01 + rng.normal(0, 0.002), 0.004))
    p = spark.createDataFrame(pd.DataFrame(rows, columns=["star_id", "dataset", "filter", "site", "mag", "mag_err"]))
    fits = cal.normalization_fits(cal.dataset_means(p), p.select("star_id").distinct(), "lsc-doma")
    f = fits.first()
    assert f["dataset"] == "f_coj" and f["a"] == pytest.approx(1.01, abs=2e-3) and f["b"] == pytest.approx(0.2, abs=0.05)
    means = cal.normalize(p, fits, "lsc-doma").groupBy("star_id").pivot("site", ["lsc-doma", "coj-doma"]).agg(F.avg("norm_mag"))
    gap = means.select(F.max(F.abs(F.col("lsc-doma") - F.col("coj-doma"))).alias("g")).first()["g"]
    assert gap < 0.01


def test_affine_fit_ignores_outliers(spark):
    rng = np.random.default_rng(1)
    x, y = rng.uniform(0, 4000, 500), rng.uniform(0, 4000, 500)
    u, v = 0.999 * x + 0.01 * y + 12, -0.01 * x + 1.002 * y - 7
    u[:20] += 5.0
    d = spark.createDataFrame(pd.DataFrame({"d": 1, "x": x, "y": y, "u": u, "v": v}))
    f = cal.affine_fit(d, ["d"], 2.0).first()
    np.testing.assert_allclose([f["a11"], f["a12"], f["a13"], f["a21"], f["a22"], f["a23"]], [0.999, 0.01, 12, -0.01, 1.002, -7], atol=1e-6)
    assert f["n_pairs"] == 480


def test_polynomial_fit_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 10, 300)
    y = 3 - 0.5 * x + 0.2 * x**2 + rng.normal(0, 0.1, 300)
    d = spark.createDataFrame(pd.DataFrame({"k": np.arange(300) % 3, "x": x, "y": y}))
    for r in cal.polynomial_fit(d, ["k"], "x", "y", 2, 5.0).collect():
        m = np.arange(300) % 3 == r["k"]
        np.testing.assert_allclose(r["coefficients"], np.polyfit(x[m] - 5, y[m], 2)[::-1], rtol=1e-6)


def test_merge_offset_refines_the_median(spark):
    rng = np.random.default_rng(3)
    d = np.concatenate([rng.normal(0.1, 0.005, 300), rng.uniform(-2, 2, 200)])
    out = cal.merge_offset(spark.createDataFrame(pd.DataFrame({"k": 1, "delta": d})), ["k"]).first()
    med, width = np.median(d), (d.max() - d.min()) / 100
    for _ in range(3):
        med = np.median(d[np.abs(d - med) <= 5 * width])
    assert out["delta_mag"] == pytest.approx(med) and out["delta_mag_err"] == pytest.approx(1 / 500)


def test_sigma_clip_matches_numpy(spark):
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.normal(10, 1, 500), [50.0, -40.0]])
    out = stats.sigma_clip(spark.createDataFrame(pd.DataFrame({"k": 1, "v": v})), ["k"], "v", 3.0, 4).first()
    keep = np.ones(len(v), bool)
    for _ in range(4):
        mu, sd = v[keep].mean(), v[keep].std()
        keep = np.abs(v - mu) <= 3 * sd
    assert out["mean"] == pytest.approx(v[keep].mean()) and out["std"] == pytest.approx(v[keep].std())


def test_star_statistics_of_known_rows(spark):
    p = spark.createDataFrame([(1, 17.0, 0.1, 0), (1, 18.0, 0.2, 0), (1, 0.0, 0.1, 0), (1, 16.0, -1.0, 0), (1, 10.0, 0.1, 4)], "star_id int, mag double, mag_err double, qc int")
    r = stats.star_statistics(p, ["star_id"], qc="qc").first()
    w = np.array([100.0, 25.0])
    mean = (17 * 100 + 18 * 25) / 125
    assert r["n"] == 2 and r["wmean"] == pytest.approx(mean) and r["werror"] == pytest.approx(1 / np.sqrt(125))
    assert r["wrms"] == pytest.approx(np.sqrt(np.sum(w * (np.array([17, 18]) - mean) ** 2) / 125)) and r["prms"] == pytest.approx(0.34)


def test_limits():
    assert cal.calibration_limits("ip", True) == {"det_mags_min": 15.0, "det_mags_max": 21.0, "cat_merr_max": 0.11}
    assert cal.calibration_limits("ip", False, cat_merr_max=0.5)["cat_merr_max"] == 0.5


def test_calibration_star_limits(spark):
    d = spark.createDataFrame(
        [(1, 18.0, 0.01, "G1"), (2, 18.0, 0.02, "G2"), (3, 18.0, 0.05, "G3"), (4, 18.0, 0.0, "G4"), (5, 22.5, 0.01, "G5"), (6, 18.0, 0.01, "None")],
        "star_id int, g double, g_err double, gid string",
    ).withColumn("mag", F.lit(18.0)).withColumn("mag_err", F.lit(0.01))
    assert {r["star_id"] for r in cal.select_calibration_stars(d, ["g"], "gid").collect()} == {1, 2}


def test_every_star_has_one_reference_and_the_photometry_is_not_read_again(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for star in range(12):
        sites = ["lsc-doma", "cpt-doma", "coj-doma"][star % 3:]
        for site in sites:
            rows += [(star if star else None, "gp", site, 2450000.2 + day, 15.0 + float(rng.normal(0, 0.1)), 0.02) for day in range(6) if rng.random() < 0.8]
    spark.createDataFrame(rows, "star_id long, filter string, site string, hjd double, mag double, mag_err double").write.parquet(str(tmp_path / "phot"))
    phot = spark.read.parquet(str(tmp_path / "phot"))
    refs = ["lsc-doma", "cpt-doma", "coj-doma"]
    res = cal.dataset_residuals(cal.time_bins(phot, ["star_id", "filter", "site"]), refs)
    # what comes after the stored bins reads those alone
    assert res.inputFiles() and not any("/phot/" in f for f in res.inputFiles())
    mags = {(r[0], r[2], int(r[3] - 2450000.0)): r[4] for r in rows}
    seen = {(star, site) for star, site, _ in mags}
    want = {}
    for (star, site, day), mag in mags.items():
        ref = next((s for s in refs if (star, s) in seen), None)
        if ref != site and (star, ref, day) in mags:
            want[ref, star, site, day] = mags[star, ref, day] - mag
    got = {(r["reference"], r["star_id"], r["site"], r["bin"]): r["delta"] for r in res.collect()}
    assert got.keys() == want.keys() and {k[0] for k in got} > {"lsc-doma"} and any(k[1] is None for k in got)
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
    offsets = cal.star_offsets(res, ["reference", "star_id", "filter", "site"])
    assert not any("/phot/" in f for f in offsets.inputFiles()) and offsets.count() == len({k[:3] for k in want})


def test_normalization_reads_the_photometry_once_for_means_and_once_for_the_result(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(s, f"d{site}", "gp", site, 15 + s / 10 + shift + float(rng.normal(0, 0.001)), 0.01) for s in range(30) for site, shift in (("lsc", 0.0), ("cpt", 0.2)) for _ in range(5)]
    spark.createDataFrame(rows, "star_id long, dataset string, filter string, site string, mag double, mag_err double").write.parquet(str(tmp_path / "phot"))
    phot = spark.read.parquet(str(tmp_path / "phot"))
    means = cal.stored(cal.dataset_means(phot))
    fits = cal.normalization_fits(means, cal.constant_among(means, "lsc", "gp", 1.0), "lsc")
    assert not any("/phot/" in f for f in fits.inputFiles())
    out = cal.normalize(phot, fits, "lsc")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("star_id#") and plan.count("mag_err#") and str(out._jdf.queryExecution().executedPlan()).count("/phot]") == 1
    assert all(abs(r["norm_mag"] - 15 - r["star_id"] / 10) < 0.02 for r in out.collect())


def test_polynomial_of_degree_four_over_years_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x = np.sort(rng.uniform(2457000, 2460000, 400))
    y = 17 + 1e-3 * (x - 2458000) - 3e-7 * (x - 2458000) ** 2 + rng.normal(0, 0.05, 400)
    rows = [("long", float(a), float(b)) for a, b in zip(x, y)] + [("short", 1.0, 2.0), ("short", 1.0, 3.0), ("long", None, 1.0), (None, 1.0, 1.0)]
    out = {r["k"]: r for r in cal.polynomial_fit(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y", 4, 2458500.0).collect()}
    fit = np.polynomial.Polynomial.fit(x - 2458500.0, y, 4)
    got = np.polynomial.Polynomial(out["long"]["coefficients"])
    grid = np.linspace(-1500, 1500, 50)
    assert np.abs(got(grid) - fit(grid)).max() < 1e-9 and out["long"]["n"] == 400
    for k in ("short", None):
        assert all(c is None or np.isnan(c) for c in out[k]["coefficients"])


def test_two_error_fit_says_whether_it_came_to_rest(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(4):
        x = rng.uniform(0, 10, 40)
        rows += [(k if k else None, float(a + rng.normal(0, 0.2)), float(2 * a + 1 + rng.normal(0, 0.3)), 0.2, 0.3) for a in x]
    rows += [(1, None, 1.0, 0.1, 0.1), (2, 1.0, 1.0, None, 0.1)]
    d = spark.createDataFrame(rows, "k long, x double, y double, xe double, ye double")
    full = {r["k"]: r for r in cal.line_with_two_errors(d, ["k"], "x", "y", "xe", "ye").collect()}
    cut = {r["k"]: r for r in cal.line_with_two_errors(d, ["k"], "x", "y", "xe", "ye", rounds=1).collect()}
    assert all(r["converged"] for r in full.values()) and not any(r["converged"] for r in cut.values()) and set(full) == {None, 1, 2, 3}
    for k, r in full.items():
        own = np.array([p[1:] for p in rows if p[0] == k and None not in p[1:]], float)
        assert r["n"] == len(own)
        # at the solution the sum of squares over both errors is least
        def chi(b, a):
            return (((own[:, 1] - b * own[:, 0] - a) ** 2) / (own[:, 3] ** 2 + b * b * own[:, 2] ** 2)).sum()
        best = chi(r["slope"], r["intercept"])
        assert all(best <= chi(r["slope"] + e, r["intercept"] + f) + 1e-9 for e in (-1e-3, 0, 1e-3) for f in (-1e-3, 0, 1e-3))
