"""Column expressions against hand calculations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import lens, phot, sky, stellar, text, timing, transforms
from skyloom.operators import models


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_flux_and_magnitude_are_inverse(spark):
    mag, err = phot.flux_to_mag(1000.0, 10.0)
    assert value(spark, mag) == pytest.approx(17.5)
    assert value(spark, err) == pytest.approx(2.5 / math.log(10) * 0.01)
    flux, ferr = phot.mag_to_flux(17.5, 2.5 / math.log(10) * 0.01)
    assert value(spark, flux) == pytest.approx(1000.0) and value(spark, ferr) == pytest.approx(10.0)
    assert value(spark, phot.flux_to_mag(-1.0, 1.0)[0]) == 0.0 and value(spark, phot.flux_to_mag(-1.0, 1.0)[1]) == 0.0
    assert value(spark, phot.flux_to_mag(6000.0, 1.0, phot.MODEL_ZP, 60.0)[0]) == pytest.approx(27.4 - 5.0)


def test_colour_needs_both_bands(spark):
    c, e = phot.colour(18.0, 0.03, 17.0, 0.04)
    assert value(spark, c) == pytest.approx(1.0) and value(spark, e) == pytest.approx(0.05)
    c, _ = phot.colour(0.0, 0.03, 17.0, 0.04)
    assert value(spark, c) is None and value(spark, phot.with_sentinel(c)) == -99.999


def test_separation_forms_agree(spark):
    assert value(spark, sky.separation_deg(10.0, 20.0, 50.0, -30.0)) == pytest.approx(value(spark, sky.separation_arccos_deg(10.0, 20.0, 50.0, -30.0)))
    assert value(spark, sky.separation_deg(359.9999, 0.0, 0.0001, 0.0)) == pytest.approx(0.0002, rel=1e-6)
    assert value(spark, sky.residual_spherical_arcsec(10.0, 60.0, 10.001, 60.0)) == pytest.approx(1.8)
    assert value(spark, sky.residual_flat_arcsec(10.0, 60.0, 10.001, 60.0)) == pytest.approx(3.6)


def test_sexagesimal_keeps_the_sign_of_minus_zero(spark):
    assert value(spark, sky.sexagesimal_to_deg(F.lit("-00:30:00"))) == pytest.approx(-0.5)
    assert value(spark, sky.sexagesimal_to_deg(F.lit("17:45:36.0"), True)) == pytest.approx(266.4)
    assert value(spark, sky.sexagesimal_to_deg(F.lit("N/A"))) is None


def test_galactic_centre(spark):
    lon, lat = sky.galactic_longitude_latitude(266.40499, -28.93617)
    assert (value(spark, lon) + 180) % 360 - 180 == pytest.approx(0.0, abs=0.01) and value(spark, lat) == pytest.approx(0.0, abs=0.01)
    assert value(spark, stellar.red_clump_distance_kpc(266.40499, -28.93617)) == pytest.approx(8.16, rel=1e-3)


def test_spline_reproduces_a_cubic(spark):
    knots = [0.0, 0.7, 1.0, 2.2, 3.0]
    cubic = lambda x: 1 - 2 * x + 0.5 * x**2 + 0.3 * x**3
    ys = [cubic(k) for k in knots]
    for x in (0.0, 0.35, 0.99, 1.7, 3.0):
        assert value(spark, stellar.interpolate_spline(F.lit(x), knots, ys)) == pytest.approx(cubic(x))
    assert value(spark, stellar.interpolate_spline(F.lit(3.1), knots, ys)) is None
    assert value(spark, stellar.interpolate_linear(F.lit(0.35), knots, ys)) == pytest.approx((ys[0] + ys[1]) / 2)


def test_adams_relation_and_range_flag(spark):
    v, s, ok = stellar.log_angular_diameter(stellar.ADAMS[("dwarfs", "V-I")], 14.0, 0.001, F.lit(0.702), 0.010)
    assert value(spark, v) == pytest.approx(0.542 + 0.378 * 0.702 - 2.8)
    assert value(spark, s) == pytest.approx(math.sqrt(0.01**2 + 0.007**2 + 0.011**2 + 0.001**2))
    assert value(spark, ok) is True
    assert value(spark, stellar.log_angular_diameter(stellar.ADAMS[("dwarfs", "V-I")], 14.0, 0.001, F.lit(1.2), 0.01)[2]) is False


def test_luminosity_class_thresholds(spark):
    assert value(spark, stellar.luminosity_class(6000.0, 3.6)) == "dwarf"
    assert value(spark, stellar.luminosity_class(4250.0, 4.0)) == "giant"
    assert value(spark, stellar.luminosity_class(5000.0, 3.7)) == "giant"
    assert value(spark, stellar.luminosity_class(5000.0, 3.9)) == "dwarf"


def test_johnson_round_trip_shape(spark):
    j = transforms.sdss_to_johnson({"g": 18.0, "g_err": 0.01, "gr": 0.5, "gr_err": 0.02, "ri": 0.2, "ri_err": 0.02})
    assert value(spark, j["v"]) == pytest.approx(18.0 - 0.295 - 0.01) and "ub" not in j
    back = transforms.johnson_to_sdss(j)
    assert value(spark, back["gr"]) == pytest.approx(1.02 * (0.98 * 0.5 + 0.22) - 0.22)
    d = transforms.johnson_derived(j)
    assert value(spark, d["vi"]) == pytest.approx(value(spark, j["vr"]) + value(spark, j["rcic"]))


@pytest.mark.parametrize("mh,g", [(0.0, 1.991), (-0.4, 1.217), (-1.2, 1.422), (-5.0, 1.951)])
def test_metallicity_limits(spark, mh, g):
    assert value(spark, transforms.twomass_to_sdss(1.0, 0.0, mh)["gr"]) == pytest.approx(g + {1.991: -0.247, 1.217: 0.05, 1.422: -0.003, 1.951: -0.23}[g])


def test_lens_mass(spark):
    row = dict(tE=50.0, rho=1e-3, piEN=0.1, piEE=0.1, thetaS=1.0, DS=8.0, s=1.0, q=0.1, dsdt=1e-3, dalphadt=1e-3)
    row |= {"sig_" + k: 0.01 * v for k, v in row.items() if k != "q"}
    out = lens.lens_parameters(spark.createDataFrame([row])).first()
    assert out["thetaE"] == pytest.approx(1000.0)
    assert out["ML"] == pytest.approx(1.0 / (8.144 * math.hypot(0.1, 0.1)), rel=2e-3)  # M = θE/(κ π), κ = 8.144 mas per solar mass
    assert out["M1"] + out["M2"] == pytest.approx(out["ML"]) and out["M2"] / out["M1"] == pytest.approx(0.1)
    assert out["sig_thetaE"] / out["thetaE"] == pytest.approx(math.sqrt(2) * 0.01)


def test_heliocentric_correction_is_within_light_time(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2000-01-01 12:00:00' AS ts")
    jd = df.select(timing.julian_date("ts").alias("v")).first()["v"]
    assert jd == pytest.approx(2451545.0)
    # the Sun stood near RA 281.3, Dec −23.03: light reaches the Earth after the Sun, 0.9833 au away
    h = df.select(timing.heliocentric_jd("ts", 0.0, 281.3, -23.03).alias("v")).first()["v"]
    assert (h - jd) * 86400 == pytest.approx(-0.9833 * 499.0, abs=2.0)


def test_instants_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS ts").select(timing.as_utc_clock(timing.as_instant("ts")).cast("string").alias("v"))
        assert df.first()["v"] == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_texts(spark):
    code = F.lit("FIELD-01_lsc-doma-1m0-05-fa15_ip")
    assert value(spark, text.short_code(code)) == "lsc-doma_ip"
    assert value(spark, text.sloan_filter(F.lit("gp"))) == "g" and value(spark, text.sloan_filter(F.lit("V"))) == "V"
    assert value(spark, text.instrument_class(F.lit("fl12"))) == "sinistro" and value(spark, text.instrument_class(F.lit("kb42"))) == "kb42"
    assert value(spark, text.fixed_decimals(F.lit(1.5), 3)) == "1.500" and value(spark, text.fixed_decimals(F.lit(None).cast("double"), 3)) == "None"
    assert value(spark, text.value_and_error(F.lit(0.0), F.lit(0.0))) == "0.0 +/- 0.0"
    assert value(spark, text.value_and_error(F.lit(12.3456), F.lit(0.0123))) == "12.346 +/- 0.012"


def test_limb_and_rescaling(spark):
    assert value(spark, phot.limb_coefficient(F.lit("event_rp.dat"))) == 0.6445 and value(spark, phot.limb_coefficient(F.lit("event.dat"))) is None
    assert value(spark, phot.rescale_error(0.02, 0.03, 2.0)) == pytest.approx(0.05)
    null = F.lit(None).cast("double")
    assert value(spark, phot.rescale_error(F.lit(0.02), null, null)) == 0.02


def test_noise_model_against_numpy(spark):
    rng = np.random.default_rng(0)
    sky_, air, exp = rng.uniform(100, 500, 50), rng.uniform(1, 2, 50), rng.uniform(30, 300, 50)
    frames = spark.createDataFrame([tuple(map(float, r)) for r in zip(sky_, air, exp)], "sky double, airmass double, exposure double")
    out = models.noise_model(frames, 15.0, 0.5, 5, zero_point=25.0, gain=1.5, read_noise=9.0, aperture_diameter=10.0, telescope_diameter_m=1.0, height_m=2200.0).orderBy("mag").collect()
    flux = 10 ** ((15.0 - 25.0) / -2.5) * 1.5
    lf = 2.5 / flux * math.log10(math.e)
    npix = math.pi * 25
    assert out[0]["read_noise"] == pytest.approx(1 / math.sqrt(50 / (81 * npix * lf**2)))
    assert out[0]["sky_noise"] == pytest.approx(1 / math.sqrt(np.sum(1 / (sky_ * 1.5 * npix * lf**2))))
    s = 0.09 * 100**-0.67 * air**1.5 * math.exp(-2200 / 8000) * (2 * exp) ** -0.5
    assert out[0]["scint_noise"] == pytest.approx(1 / math.sqrt(np.mean(1 / s**2)))


def test_sql_functions(spark):
    models.register_sql_functions(spark)
    row = spark.sql("SELECT flux_to_mag(mag_to_flux(18.2e0)) AS m, flux_to_mag(-1e0) AS z, sky_separation(0e0, 0e0, 0e0, 1e0) AS s").first()
    assert row["m"] == pytest.approx(18.2) and row["z"] == 0.0 and row["s"] == pytest.approx(1.0)


def test_sun_is_where_almanacs_have_it(spark):
    # published instants (UTC) of equinoxes and solstices, and the Earth's least and greatest distances
    turns = [("2000-03-20 07:35:00", 0.0), ("2020-12-21 10:02:00", 270.0), ("2024-03-20 03:06:00", 0.0), ("2024-06-20 20:51:00", 90.0), ("2024-09-22 12:44:00", 180.0)]
    distances = [("2020-01-05 07:48:00", 0.983244), ("2019-07-04 22:11:00", 1.016754)]
    df = spark.createDataFrame([(a,) for a, _ in turns + distances], "ts string").withColumn("t", F.col("ts").cast("timestamp_ntz"))
    lon, dist = timing.sun_place(timing.julian_date("t"))
    got = {r["ts"]: r for r in df.select("ts", lon.alias("lon"), dist.alias("dist")).collect()}
    for at, want in turns:
        # the apparent place has aberration of -0.0057 degrees and nutation of up to 0.005 besides
        assert abs((got[at]["lon"] - 0.0057 - want + 180) % 360 - 180) < 0.007
    for at, want in distances:
        assert got[at]["dist"] == pytest.approx(want, abs=1e-5)


def test_light_time_of_sites_and_of_the_moved_equinox(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-20 03:06:00' AS t")
    jd = timing.julian_date("t")
    _, dist = timing.sun_place(jd)
    # at the equinox of 2024 the Sun stands 0.3383 degrees (precession) less 0.0057 (aberration) and 0.0014 (nutation) before the
    # equinox of 2000; the other direction is towards ecliptic longitude 90 of 2000
    n, tilt = 0.3383 - 0.0057 - 0.0014, math.radians(23.4392911)
    side = timing.light_seconds(jd, 90.0, math.degrees(tilt))
    row = df.select(side.alias("s"), dist.alias("r"), timing.light_seconds(jd, 180.0 - n * math.cos(tilt), n * math.sin(tilt)).alias("away")).first()
    assert row["s"] == pytest.approx(499.004784 * row["r"] * math.sin(math.radians(n)), abs=0.02) and row["away"] == pytest.approx(499.004784 * row["r"], abs=0.02)
    for name, (east, north, height) in timing.SITES.items():
        site = timing.site_vector(east, north, height)
        sidereal = (280.46061837 + 360.98564736629 * (df.select(jd.alias("j")).first()["j"] - 2451545.0) + east) % 360
        zenith = [timing.light_seconds(jd, sidereal, math.degrees(math.atan2(site[2], site[1])), s) for s in (site, None)]
        up, centre = df.select(zenith[0].alias("a"), zenith[1].alias("b")).first()
        assert up - centre == pytest.approx(math.hypot(site[1], site[2]) / 299792.458, abs=1e-9) and 6350 < math.hypot(site[1], site[2]) < 6382, name
