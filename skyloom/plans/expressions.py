"""Scalar expressions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import lens, phot, sky, stellar, text, timing, transforms
from skyloom.functions.common import settled
from skyloom.operators import models, stats
from skyloom.operators.bracket import between, bracket_join
from skyloom.operators.quantiles import aggregate_with_quantiles
from skyloom.plans.base import Tables, query, r6, with_views

MPL = "(2.5e0/ln(10e0))"


def rounded(df, keys: list[str], columns: dict, digits: int = 6):
    return df.select(*keys, *[settled(c, digits).alias(n) for n, c in columns.items()])


@query("flux_to_mag", with_views("ev") + f"""SELECT event_id, {r6('25e0 - 2.5e0*log10(flux)')} AS mag, {r6(f'{MPL}*sqrt(flux)/1e1/flux')} AS mag_err,
    {r6('27.4e0 - 2.5e0*log10(flux/6e1)')} AS model_mag FROM ev""")
def flux_to_mag(t: Tables):
    err = F.sqrt("flux") / 10.0
    mag, mag_err = phot.flux_to_mag("flux", err)
    model, _ = phot.flux_to_mag("flux", err, phot.MODEL_ZP, exposure=60.0)
    return rounded(t.events, ["event_id"], {"mag": mag, "mag_err": mag_err, "model_mag": model})


@query("mag_to_flux", with_views("valid") + f"""SELECT image_id, seq, star_id, {r6('pow(1e1, (mag-25e0)/-2.5e0)')} AS flux,
    {r6('mag_err/(2.5e0*log10(exp(1e0)))*pow(1e1, (mag-25e0)/-2.5e0)')} AS flux_err FROM valid""")
def mag_to_flux(t: Tables):
    flux, err = phot.mag_to_flux("mag", "mag_err")
    return rounded(t.valid, ["image_id", "seq", "star_id"], {"flux": flux, "flux_err": err})


GAIA_SQL = """gf AS (SELECT star_id, flux, flux*6e-1 - 3e3 AS bp, flux*7e-1 AS rp FROM star_pixels),
    gm AS (SELECT star_id, CASE WHEN flux > 0 THEN 25.6884e0 - 2.5e0*log10(flux) ELSE 0e0 END AS gmag, CASE WHEN flux > 0 THEN (2.5e0/ln(10e0))*1e-2 ELSE 0e0 END AS gerr,
    CASE WHEN bp > 0 THEN 25.3514e0 - 2.5e0*log10(bp) ELSE 0e0 END AS bpmag, CASE WHEN bp > 0 THEN (2.5e0/ln(10e0))*2e-2 ELSE 0e0 END AS bperr,
    CASE WHEN rp > 0 THEN 24.7619e0 - 2.5e0*log10(rp) ELSE 0e0 END AS rpmag, CASE WHEN rp > 0 THEN (2.5e0/ln(10e0))*3e-2 ELSE 0e0 END AS rperr FROM gf)"""


def gaia_mags(t: Tables):
    f = t.star_pixels.select("star_id", "flux", (F.col("flux") * 0.6 - 3000.0).alias("bp"), (F.col("flux") * 0.7).alias("rp"))
    cols = {}
    for name, source, band, frac in (("g", "flux", "G", 0.01), ("bp", "bp", "G_BP", 0.02), ("rp", "rp", "G_RP", 0.03)):
        cols[name + "mag"], cols[name + "err"] = phot.gaia_flux_to_mag(source, F.abs(source) * frac, band)
    return f.select("star_id", *[c.alias(n) for n, c in cols.items()])


@query("gaia_flux_to_mag", with_views("star_pixels", extra=GAIA_SQL) + f"""SELECT star_id, {r6('gmag')} AS gmag, {r6('gerr')} AS gerr, {r6('bpmag')} AS bpmag,
    {r6('rpmag')} AS rpmag, {r6('CASE WHEN bpmag > 0 AND rpmag > 0 THEN bpmag-rpmag END')} AS bp_rp,
    {r6('CASE WHEN bpmag > 0 AND rpmag > 0 THEN sqrt(bperr*bperr+rperr*rperr) END')} AS bp_rp_err FROM gm""")
def gaia_flux_to_mag(t: Tables):
    c, e = phot.colour("bpmag", "bperr", "rpmag", "rperr")
    return rounded(gaia_mags(t), ["star_id"], {"gmag": "gmag", "gerr": "gerr", "bpmag": "bpmag", "rpmag": "rpmag", "bp_rp": c, "bp_rp_err": e})


GC = "(gmag-rpmag)"
GE = "sqrt(gerr*gerr+rperr*rperr)"


@query("gaia_to_sdss", with_views("star_pixels", extra=GAIA_SQL + f", c AS (SELECT *, {GC} AS c, {GE} AS s FROM gm)") + f"""SELECT star_id,
    {r6('gmag - (0.13518e0 - 0.46245e0*c - 0.25171e0*c*c + 0.021349e0*c*c*c)')} AS g,
    {r6('sqrt((gerr*gerr + pow(0.46245e0,2))*s*s + 4*pow(0.25171e0,2)*c*c*s*s + 9*pow(0.021349e0,2)*pow(c,4)*s*s + pow(0.16497e0,2))')} AS g_err,
    {r6('gmag - (-0.12879e0 + 0.24662e0*c - 0.027464e0*c*c - 0.049465e0*c*c*c)')} AS r,
    {r6('sqrt((gerr*gerr + pow(0.24662e0,2))*s*s + 4*pow(0.027464e0,2)*c*c*s*s + 9*pow(0.049465e0,2)*pow(c,4)*s*s + pow(0.066739e0,2))')} AS r_err,
    {r6('gmag - (-0.29676e0 + 0.64728e0*c - 0.10141e0*c*c)')} AS i,
    {r6('sqrt((gerr*gerr + pow(0.64728e0,2))*s*s + 4*pow(0.10141e0,2)*c*c*s*s + pow(0.098957e0,2))')} AS i_err,
    {r6('gmag - (-0.01760e0 - 0.006860e0*c - 0.1732e0*c*c)')} AS v, {r6('sqrt(gerr*gerr + pow(0.045858e0,2))')} AS v_err,
    {r6('gmag - (-0.003226e0 + 0.3833e0*c - 0.1345e0*c*c)')} AS rc, {r6('gmag - (0.02085e0 + 0.7419e0*c - 0.09631e0*c*c)')} AS ic FROM c""")
def gaia_to_sdss(t: Tables):
    d = gaia_mags(t).withColumn("c", F.col("gmag") - F.col("rpmag")).withColumn(
        "s", F.sqrt(F.col("gerr") * F.col("gerr") + F.col("rperr") * F.col("rperr"))
    )
    sdss = phot.gaia_to_sdss("gmag", "gerr", "c", "s")
    j = phot.gaia_to_johnson("gmag", "gerr", "c")
    return rounded(d, ["star_id"], {**sdss, "v": j["V"], "v_err": j["V_err"], "rc": j["R"], "ic": j["I"]})


@query("sdss_johnson", with_views("star_mags", extra="""c AS (SELECT star_id, g, g_err, g-r AS gr, sqrt(g_err*g_err+r_err*r_err) AS gre, r-i AS ri, sqrt(r_err*r_err+i_err*i_err) AS rie
    FROM (SELECT star_id, nullif(g, 0e0) AS g, nullif(r, 0e0) AS r, nullif(i, 0e0) AS i, g_err, r_err, i_err FROM star_mags)),
    j AS (SELECT *, 0.98e0*gr + 0.22e0 AS bv, sqrt(gre*gre+pow(0.04e0,2)) AS bve, 1.09e0*ri + 0.22e0 AS vr, 1e0*ri + 0.21e0 AS rcic, sqrt(rie*rie + pow(0.01e0,2)) AS rcice,
    g + 0.39e0*gr + 0.21e0 AS b, g - 0.59e0*gr - 0.01e0 AS v, sqrt(g_err*g_err + gre*gre + pow(0.01e0,2)) AS ve FROM c)""")
    + f"""SELECT star_id, {r6('bv')} AS bv, {r6('vr')} AS vr, {r6('rcic')} AS rcic, {r6('b')} AS b, {r6('v')} AS v, {r6('ve')} AS v_err,
    {r6('v-vr')} AS rc, {r6('v-vr-rcic')} AS ic, {r6('1.02e0*bv - 0.22e0')} AS back_gr, {r6('0.91e0*rcic - 0.20e0')} AS back_ri, {r6('1.72e0*rcic - 0.41e0')} AS back_rz,
    {r6('sqrt(pow((0.91e0*rcic-0.20e0)/rcic*rcice, 2) + pow(0.03e0,2))')} AS back_ri_err,
    {r6('v + 0.60e0*bv - 0.12e0')} AS back_g, {r6('v - 0.42e0*bv + 0.11e0')} AS back_r,
    {r6('sqrt(pow((v+0.60e0*bv-0.12e0)/v*ve,2) + pow((v+0.60e0*bv-0.12e0)/bv*bve,2) + pow(0.02e0,2))', 3)} AS back_g_err FROM j""")
def sdss_johnson(t: Tables):
    """There and back; missing bands stay null."""
    m = t.star_mags
    for band in "gri":
        m = m.withColumn(band, F.when(F.col(band) > 0, F.col(band)))
    gr, gre = F.col("g") - F.col("r"), F.sqrt(F.col("g_err") * F.col("g_err") + F.col("r_err") * F.col("r_err"))
    ri, rie = F.col("r") - F.col("i"), F.sqrt(F.col("r_err") * F.col("r_err") + F.col("i_err") * F.col("i_err"))
    j = transforms.sdss_to_johnson({"g": "g", "g_err": "g_err", "gr": gr, "gr_err": gre, "ri": ri, "ri_err": rie})
    d = transforms.johnson_derived(j)
    back = transforms.johnson_to_sdss(j)
    return m.select(
        "star_id", *[settled(j[c]).alias(c) for c in ("bv", "vr", "rcic", "b", "v", "v_err")],
        settled(d["r"]).alias("rc"), settled(d["i"]).alias("ic"),
        *[settled(back[c]).alias("back_" + c) for c in ("gr", "ri", "rz", "ri_err", "g", "r")],
        settled(back["g_err"], 3).alias("back_g_err"),
    )


def _jhk_case(k: int, which: int) -> str:
    rows = [(lim, c[which][k]) for lim, *c in transforms.TWOMASS_TO_SDSS]
    return "CASE " + " ".join(f"WHEN mh > {lim}e0 THEN {v}e0" for lim, v in rows) + f" ELSE {transforms.TWOMASS_ALL[which][k]}e0 END"


@query("jhk_to_sdss", with_views("star_mags", extra="c AS (SELECT star_id, g-r AS jh, r-i AS hk, (size-40)/1e1 AS mh FROM star_mags)")
    + f"""SELECT star_id, {r6(f'({_jhk_case(0, 0)})*jh + ({_jhk_case(1, 0)})*hk + ({_jhk_case(2, 0)})')} AS gr, {r6(_jhk_case(3, 0))} AS gr_err,
    {r6(f'({_jhk_case(0, 1)})*jh + ({_jhk_case(1, 1)})*hk + ({_jhk_case(2, 1)})')} AS ri, {r6(_jhk_case(3, 1))} AS ri_err FROM c""")
def jhk_to_sdss(t: Tables):
    c = t.star_mags.select("star_id", (F.col("g") - F.col("r")).alias("jh"), (F.col("r") - F.col("i")).alias("hk"), ((F.col("size") - 40) / 10.0).alias("mh"))
    return rounded(c, ["star_id"], transforms.twomass_to_sdss("jh", "hk", "mh"))


@query("colours", with_views("star_mags") + "SELECT star_id, " + ", ".join(
    f"{r6(f'CASE WHEN {a} > 0 AND {b} > 0 THEN {a}-{b} ELSE -99.999e0 END')} AS {a}{b}, "
    f"{r6(f'CASE WHEN {a} > 0 AND {b} > 0 THEN sqrt({a}_err*{a}_err+{b}_err*{b}_err) ELSE -99.999e0 END')} AS {a}{b}_err" for a, b in ("gr", "gi", "ri"))
    + " FROM star_mags")
def colours(t: Tables):
    cols = {}
    for a, b in ("gr", "gi", "ri"):
        c, e = phot.colour(a, a + "_err", b, b + "_err")
        cols[a + b], cols[f"{a}{b}_err"] = phot.with_sentinel(c), phot.with_sentinel(e)
    return rounded(t.star_mags, ["star_id"], cols)


# extinction of one field per band: value, error
EXTINCTION = {"g": (3.2, 0.05), "r": (2.3, 0.04), "i": (1.7, 0.03)}


@query("extinction_correct", with_views("star_mags") + f"""SELECT star_id, {r6('g-3.2e0')} AS g0, {r6('sqrt(g_err*g_err+25e-4)')} AS g0_err, {r6('r-2.3e0')} AS r0,
    {r6('sqrt(r_err*r_err+16e-4)')} AS r0_err, {r6('i-1.7e0')} AS i0, {r6('sqrt(i_err*i_err+9e-4)')} AS i0_err, {r6('(g-3.2e0)-(r-2.3e0)')} AS gr0 FROM star_mags""")
def extinction_correct(t: Tables):
    cols = {}
    for band, (a, e) in EXTINCTION.items():
        cols[band + "0"], cols[band + "0_err"] = phot.deredden(band, band + "_err", a, e)
    cols["gr0"] = cols["g0"] - cols["r0"]
    return rounded(t.star_mags, ["star_id"], cols)


@query("set_delta", with_views("valid") + f"""SELECT image_id, seq, star_id, {r6("mag + CASE filter WHEN 'gp' THEN 12e-2 WHEN 'rp' THEN -5e-2 ELSE 0e0 END")} AS mag FROM valid""")
def set_delta(t: Tables):
    """Per-filter corrections; rows of a filter without one stay as they are."""
    delta = phot.per_filter("filter", {"gp": 0.12, "rp": -0.05})
    return t.valid.withColumn("d", F.coalesce(delta, F.lit(0.0))).select("image_id", "seq", "star_id", settled(F.col("mag") + F.col("d")).alias("mag"))


GAL_SQL = """gal AS (SELECT star_id, radians(fmod(122.93192e0 - degrees(atan2(cos(radians(dec))*sin(radians(ra-192.85948e0)),
    sin(radians(dec))*cos(radians(27.12825e0)) - cos(radians(dec))*sin(radians(27.12825e0))*cos(radians(ra-192.85948e0)))) + 720e0, 360e0)) AS l FROM stars),
    rc AS (SELECT star_id, degrees(l) AS l, 8.16e0/(cos(l) + sin(l)/tan(radians(40e0))) AS d FROM gal)"""


@query("red_clump_model", with_views("stars", extra=GAL_SQL) + f"""SELECT star_id, {r6('l')} AS gal_l, {r6('d')} AS distance_kpc, {r6('1.331e0 + 5*log10(d*1e3) - 5')} AS m_g,
    {r6('0.552e0 + 5*log10(d*1e3) - 5')} AS m_r, {r6('0.262e0 + 5*log10(d*1e3) - 5')} AS m_i, {r6('0.97e0 + 5*log10(d*1e3) - 5')} AS m_v,
    {r6('14.443e0 + 5*log10(8.16e0/d)')} AS i_app,
    {r6('pow(1e1, (14.443e0 + 5*log10(8.16e0/d) + 12e-2 + 5)/5)', 4)} AS d_pc,
    {r6('(pow(1e1, (14.443e0 + 5*log10(8.16e0/d) + 2e-2 + 12e-2 - 1e-2 + 5)/5) - pow(1e1, (14.443e0 + 5*log10(8.16e0/d) - 2e-2 + 12e-2 + 1e-2 + 5)/5))/2', 4)} AS d_pc_err FROM rc""")
def red_clump_model(t: Tables):
    lon, _ = sky.galactic_longitude_latitude("ra", "dec")
    d = t.stars.select("star_id", lon.alias("l"), stellar.red_clump_distance_kpc("ra", "dec").alias("d"))
    i_app = stellar.red_clump_apparent_i("d")
    dist, err = stellar.distance_pc(i_app, 0.02, -0.12, 0.01)
    cols = {"gal_l": F.col("l"), "distance_kpc": F.col("d"), "i_app": i_app}
    for band in ("g", "r", "i", "V"):
        cols["m_" + band.lower()] = stellar.red_clump_apparent(band, "d")
    return d.select("star_id", *[settled(c).alias(n) for n, c in cols.items()], settled(dist, 4).alias("d_pc"), settled(err, 4).alias("d_pc_err"))


def _poly_sql(c: list[float], x: str) -> str:
    return " + ".join(f"({v}e0)*pow({x}, {n})" for n, v in enumerate(c))


def _ang_sql(name: str, table: tuple, mag: str, merr: str, col: str, cerr: str) -> str:
    c, e, (lo, hi) = table
    var = " + ".join(f"pow({v}e0, 2)" for v in e)
    value = f"({_poly_sql(c, col)} - 0.2e0*{mag})"
    spread = f"sqrt({cerr}*{cerr} + {var} + {merr}*{merr})"
    return (f"{r6(f'pow(1e1, {value})*1e3/2')} AS {name}, {r6(f'{spread}/abs({value})*pow(1e1, {value})*1e3/2')} AS {name}_err, "
            f"{col} BETWEEN {lo}e0 AND {hi}e0 AS {name}_valid")


RADII = [("adams_dwarf", stellar.ADAMS[("dwarfs", "V-I")]), ("adams_giant", stellar.ADAMS[("giants", "V-I")]), ("adams_all", stellar.ADAMS[("all", "V-I")]), ("boyajian_vi", stellar.BOYAJIAN["V-I"])]


@query("angular_radius", with_views("star_mags", extra="""c AS (SELECT star_id, g - 0.59e0*(g-r) - 0.01e0 AS v, 2e-2 AS ve, g-r AS gr, 1e-2 AS gre, 0.4e0 + (size % 30)/2e1 AS vi, 3e-2 AS vie
    FROM star_mags WHERE g > 0 AND r > 0)""") + "SELECT star_id, " + ", ".join(_ang_sql(n, tb, "v", "ve", "vi", "vie") for n, tb in RADII)
    + ", " + _ang_sql("boyajian_gr", stellar.BOYAJIAN["g-r"], "v", "ve", "gr", "gre")
    + f""", {r6(f"8e3*3.085677581491367e16*sin(radians((pow(1e1, ({_poly_sql(stellar.ADAMS[('dwarfs', 'V-I')][0], 'vi')} - 0.2e0*v))*1e3/2)/1e6/3600e0))/6.957e8")} AS radius_8kpc FROM c""")
def angular_radius(t: Tables):
    m = t.star_mags.where("g > 0 AND r > 0").select(
        "star_id", (F.col("g") - 0.59 * (F.col("g") - F.col("r")) - 0.01).alias("v"), (F.col("g") - F.col("r")).alias("gr"),
        (F.lit(0.4) + (F.col("size") % 30) / 20.0).alias("vi"),
    )
    out = []
    first = None
    for name, table in [*RADII, ("boyajian_gr", stellar.BOYAJIAN["g-r"])]:
        col, err = ("gr", 0.01) if name == "boyajian_gr" else ("vi", 0.03)
        value, spread, ok = stellar.log_angular_diameter(table, "v", 0.02, col, err)
        r, e = stellar.angular_radius_muas(value, spread)
        first = (r, e) if first is None else first
        out += [settled(r).alias(name), settled(e).alias(name + "_err"), ok.alias(name + "_valid")]
    radius, _ = stellar.radius_at_distance(first[0], first[1], 8000.0)
    return m.select("star_id", *out, settled(radius).alias("radius_8kpc"))


@query("mass_radius", with_views("star_mags", extra="""c AS (SELECT star_id, 3500e0 + size*70 AS teff, 1e0 + (star_id % 40)/1e1 AS logg, 1e0 + (star_id % 9)/1e1 AS theta, 5e-2 AS se FROM star_mags),
    x AS (SELECT *, log10(teff) - 4.1e0 AS x FROM c),
    lr AS (SELECT *, 2.4427e0 + 0.6679e0*x + 0.1771e0*x*x + 0.705e0*x*x*x - 0.21415e0*logg*logg + 0.02306e0*logg*logg*logg + 0.04173e0*0.0152e0 AS lr FROM x),
    r AS (SELECT *, pow(1e1, lr) AS rad, abs(0.014e0/lr)*pow(1e1, lr) AS rade FROM lr)""")
    + f"""SELECT star_id, {r6('rad')} AS radius, {r6('rade')} AS radius_err, {r6('rad*6.957e8/tan(radians(theta/1e6/3600e0))/3.085677581491367e16', 3)} AS distance_pc,
    {r6('sqrt(pow(rade/rad, 2)+pow(se/theta, 2))*rad*6.957e8/tan(radians(theta/1e6/3600e0))/3.085677581491367e16', 3)} AS distance_pc_err,
    CASE WHEN logg > CASE WHEN teff >= 6000 THEN 3.5e0 WHEN teff <= 4250 THEN 4e0 ELSE 5.2e0 - 2.8e-4*teff END THEN 'dwarf' ELSE 'giant' END AS lclass FROM r""")
def mass_radius(t: Tables):
    c = t.star_mags.select(
        "star_id", (F.lit(3500.0) + F.col("size") * 70).alias("teff"), (F.lit(1.0) + (F.col("star_id") % 40) / 10.0).alias("logg"),
        (F.lit(1.0) + (F.col("star_id") % 9) / 10.0).alias("theta"),
    )
    r, e = stellar.torres_radius("teff", "logg", 0.0152)
    d, de = stellar.distance_from_radius_pc(r, e, "theta", 0.05)
    return c.select(
        "star_id", settled(r).alias("radius"), settled(e).alias("radius_err"), settled(d, 3).alias("distance_pc"),
        settled(de, 3).alias("distance_pc_err"), stellar.luminosity_class("teff", "logg").alias("lclass"),
    )


MODEL_SQL = """m AS (SELECT c_custkey AS model_id, 2e1 + (c_custkey % 50) AS tE, 5e-1 AS sig_tE, 1e-3*(1 + c_custkey % 7) AS rho, 1e-4 AS sig_rho,
    1e-1 + (c_custkey % 11)/1e2 AS piEN, 1e-2 AS sig_piEN, 5e-2 + (c_custkey % 13)/1e2 AS piEE, 2e-2 AS sig_piEE, 1e0 + (c_custkey % 17)/1e1 AS thetaS, 5e-2 AS sig_thetaS,
    8e0 AS DS, 5e-1 AS sig_DS, 6e-1 + (c_custkey % 19)/1e1 AS s, 1e-2 AS sig_s, 1e-3*(1 + c_custkey % 23) AS q, 1e-3*(1 + c_custkey % 5) AS dsdt, 1e-4 AS sig_dsdt,
    2e-3*(1 + c_custkey % 3) AS dadt, 2e-4 AS sig_dadt FROM customer),
    a AS (SELECT *, sqrt(piEN*piEN+piEE*piEE) AS piE, sqrt(sig_piEN*sig_piEN+sig_piEE*sig_piEE) AS sig_piE, thetaS/rho AS thetaE,
      sqrt(pow(sig_thetaS/thetaS,2)+pow(sig_rho/rho,2))*thetaS/rho AS sig_thetaE FROM m),
    b AS (SELECT *, thetaE*piE AS pi_rel, sqrt(pow(sig_thetaE/thetaE,2)+pow(sig_piE/piE,2))*thetaE*piE AS sig_pi_rel, radians(thetaE/1e6/3600e0) AS th, radians(sig_thetaE/1e6/3600e0) AS sth,
      1.495978707e11/(DS*1e3*3.085677581491367e16) AS pis FROM a),
    c AS (SELECT *, radians(pi_rel/1e6/3600e0)+pis AS pil, sqrt(pow(radians(sig_pi_rel/1e6/3600e0),2)+pow(pis*sig_DS/DS,2)) AS spil FROM b),
    d AS (SELECT *, 1.495978707e11/pil/3.085677581491367e16/1e3 AS DL, spil/pil*1.495978707e11/pil/3.085677581491367e16/1e3 AS sig_DL, 1e3*3.085677581491367e16/1.495978707e11 AS ka,
      pow(299792458e0,2)*1.495978707e11/(4*6.6743e-11)/1.988409870698051e30*th/piE AS ML, sqrt(pow(sig_thetaE/thetaE,2)+pow(sig_piE/piE,2)) AS fM FROM c),
    e AS (SELECT *, DL*ka*sin(th) AS RE, sqrt(pow(sig_DL/DL,2)+pow(cos(th)*sth/th,2)) AS fRE, dsdt*365.24e0/s AS g1, dadt*365.24e0 AS g2,
      sqrt(pow(sig_dsdt/dsdt,2)+pow(sig_s/s,2)+pow(sig_dadt/dadt,2)) AS fg FROM d),
    f AS (SELECT *, pow(s*RE,3)*(g1*g1+g2*g2)/(8*pi()*pi()*ML) AS kepe, sqrt(pow(sig_s/s,2)+pow(fRE,2)) AS fsre FROM e)"""


@query("lens_physics", "WITH " + MODEL_SQL + f"""SELECT model_id, {r6('thetaE', 3)} AS theta_e, {r6('sig_thetaE', 3)} AS sig_theta_e, {r6('pi_rel', 3)} AS pi_rel, {r6('sig_pi_rel', 3)} AS sig_pi_rel,
    {r6('DL')} AS dl, {r6('sig_DL')} AS sig_dl, {r6('5*log10(DL*1e3)-5')} AS dist_mod, {r6('RE')} AS re, {r6('fRE*RE')} AS sig_re, {r6('ML')} AS ml, {r6('fM*ML')} AS sig_ml,
    {r6('ML/(1+q)')} AS m1, {r6('ML*q/(1+q)')} AS m2, {r6('s*DL*ka*th')} AS a_proj, {r6('sqrt(pow(sig_s/s,2)+pow(sig_DL/DL,2)+pow(sig_thetaE/thetaE,2))*s*DL*ka*th')} AS sig_a_proj,
    {r6('kepe')} AS kepe, {r6('sqrt(9*fsre*fsre+4*fg*fg+fM*fM)*kepe')} AS sig_kepe, {r6('thetaE/tE*365.24e0/1e3')} AS mu_rel,
    {r6('sqrt(pow(sig_thetaE/thetaE,2)+pow(sig_tE/tE,2))*thetaE/tE*365.24e0/1e3')} AS sig_mu_rel FROM f""")
def lens_physics(t: Tables):
    k = F.col("c_custkey")
    m = t.raw("customer").select(
        k.alias("model_id"), (F.lit(20.0) + k % 50).alias("tE"), F.lit(0.5).alias("sig_tE"), (F.lit(1e-3) * (1 + k % 7)).alias("rho"), F.lit(1e-4).alias("sig_rho"),
        (F.lit(0.1) + (k % 11) / 100.0).alias("piEN"), F.lit(0.01).alias("sig_piEN"), (F.lit(0.05) + (k % 13) / 100.0).alias("piEE"), F.lit(0.02).alias("sig_piEE"),
        (F.lit(1.0) + (k % 17) / 10.0).alias("thetaS"), F.lit(0.05).alias("sig_thetaS"), F.lit(8.0).alias("DS"), F.lit(0.5).alias("sig_DS"),
        (F.lit(0.6) + (k % 19) / 10.0).alias("s"), F.lit(0.01).alias("sig_s"), (F.lit(1e-3) * (1 + k % 23)).alias("q"),
        (F.lit(1e-3) * (1 + k % 5)).alias("dsdt"), F.lit(1e-4).alias("sig_dsdt"), (F.lit(2e-3) * (1 + k % 3)).alias("dalphadt"), F.lit(2e-4).alias("sig_dalphadt"),
    )
    p = lens.lens_parameters(m)
    three = {"theta_e": "thetaE", "sig_theta_e": "sig_thetaE", "pi_rel": "pi_rel", "sig_pi_rel": "sig_pi_rel"}
    six = {"dl": "DL", "sig_dl": "sig_DL", "dist_mod": "dist_mod", "re": "RE", "sig_re": "sig_RE", "ml": "ML", "sig_ml": "sig_ML", "m1": "M1", "m2": "M2",
           "a_proj": "a_proj", "sig_a_proj": "sig_a_proj", "kepe": "kepe", "sig_kepe": "sig_kepe", "mu_rel": "mu_rel", "sig_mu_rel": "sig_mu_rel"}
    return p.select("model_id", *[settled(c, 3).alias(n) for n, c in three.items()], *[settled(c).alias(n) for n, c in six.items()])


def _pieces_sql(x: str, knots: list[float], pieces: list[list[float]]) -> str:
    parts = []
    for n, p in enumerate(pieces):
        poly = " + ".join(f"({v!r}::double)*pow({x}-{knots[n]}e0, {k})" for k, v in enumerate(p))
        parts.append(f"WHEN {x} < {knots[n + 1]}e0 THEN {poly}")
    last = " + ".join(f"({v!r}::double)*pow({x}-{knots[-2]}e0, {k})" for k, v in enumerate(pieces[-1]))
    return f"CASE WHEN {x} < {knots[0]}e0 OR {x} > {knots[-1]}e0 THEN NULL {' '.join(parts)} ELSE {last} END"


def _linear_pieces(knots, values):
    return [[values[n], (values[n + 1] - values[n]) / (knots[n + 1] - knots[n])] for n in range(len(knots) - 1)]


def short(colour: str) -> str:
    return colour.lower().replace("-", "").replace("'", "p")


@query("colour_interpolation", with_views("star_mags", extra="c AS (SELECT star_id, 7e-1 + (star_id % 260)/1e2 AS vi, 2e0 + (size % 35)/1e1 AS rv, 1e-1 + (size % 9)/1e1 AS ebv FROM star_mags)")
    + "SELECT star_id, " + ", ".join(f"{r6(_pieces_sql('vi', stellar.GIANT_VI, stellar.spline_pieces(stellar.GIANT_VI, v)))} AS {short(k)}" for k, v in stellar.GIANT_COLOURS.items())
    + ", " + ", ".join(f"{r6('(' + _pieces_sql('rv', stellar.RV_GRID, _linear_pieces(stellar.RV_GRID, v)) + ')*ebv')} AS a_{k}" for k, v in stellar.RV_TABLE.items()) + " FROM c")
def colour_interpolation(t: Tables):
    c = t.star_mags.select("star_id", (F.lit(0.7) + (F.col("star_id") % 260) / 100.0).alias("vi"), (F.lit(2.0) + (F.col("size") % 35) / 10.0).alias("rv"), (F.lit(0.1) + (F.col("size") % 9) / 10.0).alias("ebv"))
    cols = {short(k): stellar.interpolate_spline("vi", stellar.GIANT_VI, v) for k, v in stellar.GIANT_COLOURS.items()}
    cols |= {"a_" + k: stellar.band_reddening("ebv", 0.01, "rv", k)[0] for k in stellar.RV_TABLE}
    return rounded(c, ["star_id"], cols)


COLOURS = list(stellar.COLOUR_NAMES.values())
COLOUR_TABLE = "class string, vk double, " + ", ".join(f"{c} double" for c in COLOURS)
TABLE_SQL = "tb(class, vk, " + ", ".join(COLOURS) + ") AS (VALUES " + ", ".join(
    "('" + row[0] + "', " + ", ".join("NULL::double" if v is None else f"{v}::double" for v in row[1:]) + ")" for row in stellar.colour_rows()) + ")"
COLOUR_SQL = TABLE_SQL + """, c AS (SELECT star_id, CASE WHEN star_id % 3 = 0 THEN 'dwarf' ELSE 'giant' END AS class, -5e-1 + (star_id % 801)/1e2 AS vk FROM star_mags),
    k AS (SELECT *, lead(vk) OVER (PARTITION BY class ORDER BY vk) AS vk1, """ + ", ".join(f"lead({c}) OVER (PARTITION BY class ORDER BY vk) AS {c}1" for c in COLOURS) + """ FROM tb)"""


def star_classes(t: Tables):
    k = F.col("star_id")
    return t.star_mags.select("star_id", F.when(k % 3 == 0, "dwarf").otherwise("giant").alias("class"), (F.lit(-0.5) + (k % 801) / 100.0).alias("vk"))


@query("colour_bracket_join", with_views("star_mags", extra=COLOUR_SQL) + "SELECT star_id, c.class, " + ", ".join(
    f"{r6(f'CASE WHEN c.vk = k.vk THEN {c} ELSE {c} + (c.vk-k.vk)/(vk1-k.vk)*({c}1-{c}) END')} AS {c}" for c in COLOURS) + " FROM c LEFT JOIN k ON k.class = c.class AND c.vk >= k.vk AND (c.vk < vk1 OR vk1 IS NULL)")
def colour_bracket_join(t: Tables):
    """All seven colours of dwarfs and giants from their V−K, interpolated in a table that is a DataFrame; null outside it."""
    table = t.spark.createDataFrame(stellar.colour_rows(), COLOUR_TABLE)
    out = bracket_join(star_classes(t), table, "vk", "vk", COLOURS, ["class"])
    return rounded(out, ["star_id", "class"], {c: between(c, "vk", "vk") for c in COLOURS})


@query("reference_tables", with_views("star_mags", extra="c AS (SELECT star_id, 7e-1 + (star_id % 260)/1e2 AS vi FROM star_mags), k AS (SELECT * FROM (VALUES "
    + ", ".join(f"({n}, {v}e0, {vk}e0)" for n, (v, vk) in enumerate(zip(stellar.GIANT_VI, stellar.GIANT_COLOURS["V-K"]))) + ") AS t(n, kvi, kvk))")
    + f"""SELECT star_id, {r6('arg_min(kvi, (abs(vi-kvi), n))')} AS nearest_vi, {r6('arg_min(kvk, (abs(vi-kvi), n))')} AS nearest_vk FROM c, k GROUP BY star_id""")
def reference_tables(t: Tables):
    """Row of the built-in giant colour table nearest in V−I for every star."""
    c = t.star_mags.select("star_id", (F.lit(0.7) + (F.col("star_id") % 260) / 100.0).alias("vi"))
    best = models.nearest_table_row("vi", models.GIANT_TABLE)
    return c.select("star_id", settled(best["vi"]).alias("nearest_vi"), settled(best["vk"]).alias("nearest_vk"))


def _poly(x: str, terms) -> str:
    out = f"({terms[-1]!r}::double)"
    for c in reversed(terms[:-1]):
        out = f"({out}*{x} + ({c!r}::double))"
    return out


SITE_VECTORS = {n: timing.site_vector(*timing.SITES[s]) for n, s in enumerate(("lsc", "cpt", "coj"))}
SITE_ROWS = ", ".join(f"({n}, {a!r}::double, {b!r}::double, {c!r}::double)" for n, (a, b, c) in SITE_VECTORS.items())
HJD_SQL = f"""w(k, east, axis, height) AS (VALUES {SITE_ROWS}), e AS (SELECT event_id, star_id, epoch_us(ts)/1e6/86400e0 + 2440587.5e0 + 1.5e2/86400e0 AS jd, radians(ra) AS a, radians(dec) AS d, east, axis, height FROM ev JOIN stars USING (star_id) JOIN w ON w.k = star_id % 3),
    q AS (SELECT *, (jd - 2415020e0)/36525e0 AS t, (jd - 2451545e0)/36525e0 AS s FROM e),
    m AS (SELECT *, radians({_poly('t', timing.MEAN_ANOMALY)}) AS m, {_poly('t', timing.ECCENTRICITY)} AS ec FROM q),
    c AS (SELECT *, {' + '.join(f"{_poly('t', k)}*sin({n}*m)" for n, k in enumerate(timing.CENTRE, 1))} AS turn FROM m),
    u AS (SELECT *, {_poly('t', timing.MEAN_LONGITUDE)} + turn + {' + '.join(f"({lc!r}::double)*cos(radians({ph!r}::double + {ra!r}::double*t)) + ({ls!r}::double)*sin(radians({ph!r}::double + {ra!r}::double*t))" for ph, ra, lc, ls, _, _ in timing.PERTURBATIONS)}
      - {timing.PRECESSION[0]!r}::double*s - {timing.PRECESSION[1]!r}::double*s*s AS lon, 1.0000002e0*(1 - ec*ec)/(1 + ec*cos(m + radians(turn))) + {' + '.join(f"({dc!r}::double)*cos(radians({ph!r}::double + {ra!r}::double*t)) + ({ds!r}::double)*sin(radians({ph!r}::double + {ra!r}::double*t))" for ph, ra, _, _, dc, ds in timing.PERTURBATIONS)} AS r,
      radians(280.46061837e0 + 360.98564736629e0*(jd - 2451545e0) + east) AS st FROM c),
    h AS (SELECT *, -r*(cos(radians(lon))*cos(d)*cos(a) + cos(radians({timing.TILT_2000!r}::double))*sin(radians(lon))*cos(d)*sin(a) + sin(radians({timing.TILT_2000!r}::double))*sin(radians(lon))*sin(d))*{timing.AU_SECONDS!r}::double
      + (axis*(cos(st)*cos(d)*cos(a) + sin(st)*cos(d)*sin(a)) + height*sin(d))/{timing.LIGHT_KM_S!r}::double AS seconds FROM u)"""


@query("helio_julian_date", with_views("ev", "stars", extra=HJD_SQL) + f"SELECT event_id, {r6('jd')} AS jd, {r6('jd + seconds/86400')} AS hjd, {r6('seconds', 4)} AS seconds FROM h")
def helio_julian_date(t: Tables):
    """Mid-exposure dates of measurements at three sites, with the light time against the Sun in seconds."""
    d = t.events.join(t.stars.select("star_id", "ra", "dec"), "star_id")
    sites = t.spark.createDataFrame([(n, *v) for n, v in SITE_VECTORS.items()], "k bigint, east double, axis double, height double")
    d = d.withColumn("k", F.col("star_id") % 3).join(sites, "k")
    jd = timing.julian_date("ts") + F.lit(150.0) / F.lit(86400.0)
    light = timing.light_seconds(jd, "ra", "dec", ("east", "axis", "height"))
    hjd = timing.heliocentric_jd("ts", 300.0, "ra", "dec", ("east", "axis", "height"))
    return d.select("event_id", settled(jd).alias("jd"), settled(hjd).alias("hjd"), settled(light, 4).alias("seconds"))


SEXA_SQL = """tx AS (SELECT o_orderkey AS image_id, printf('%02d:%02d:%02d.%02d', o_custkey % 24, o_orderkey % 60, (o_orderkey*7) % 60, o_custkey % 100) AS ra_text,
    printf('%s%02d:%02d:%02d.%d', CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '+' END, o_orderkey % 31, o_custkey % 60, (o_custkey*3) % 60, o_orderkey % 10) AS dec_text FROM orders)"""


def sexagesimal_texts(t: Tables):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.raw("orders").select(
        o.alias("image_id"), F.format_string("%02d:%02d:%02d.%02d", c % 24, o % 60, (o * 7) % 60, c % 100).alias("ra_text"),
        F.format_string("%s%02d:%02d:%02d.%d", F.when(o % 2 == 0, "-").otherwise("+"), o % 31, c % 60, (c * 3) % 60, o % 10).alias("dec_text"),
    )


@query("sexagesimal", "WITH " + SEXA_SQL + f"""SELECT image_id, {r6("15*(CAST(split_part(ra_text, ':', 1) AS double) + CAST(split_part(ra_text, ':', 2) AS double)/60 + CAST(split_part(ra_text, ':', 3) AS double)/3600)")} AS ra,
    {r6("CASE WHEN dec_text[1] = '-' THEN -1 ELSE 1 END*(CAST(split_part(dec_text[2:], ':', 1) AS double) + CAST(split_part(dec_text, ':', 2) AS double)/60 + CAST(split_part(dec_text, ':', 3) AS double)/3600)")} AS dec FROM tx""")
def sexagesimal(t: Tables):
    return rounded(sexagesimal_texts(t), ["image_id"], {"ra": sky.sexagesimal_to_deg("ra_text", hours=True), "dec": sky.sexagesimal_to_deg("dec_text")})


@query("format_number", with_views("valid") + """SELECT image_id, seq, star_id, printf('%.3f', mag) AS mag_text, printf('%.2f', round(mag, 2)) || ' +/- ' || printf('%.3f', mag_err) AS both_text
    FROM valid""")
def format_number(t: Tables):
    return t.valid.select(
        "image_id", "seq", "star_id", text.fixed_decimals("mag", 3).alias("mag_text"),
        F.concat_ws(" +/- ", text.fixed_decimals(F.round("mag", 2), 2), text.fixed_decimals("mag_err", 3)).alias("both_text"),
    )


@query("error_rescale", with_views("valid") + f"""SELECT image_id, seq, star_id, {r6('CASE site WHEN $$lsc-doma$$ THEN sqrt(1e-4 + 121e-2*mag_err*mag_err) WHEN $$cpt-doma$$ THEN sqrt(4e-4 + 81e-2*mag_err*mag_err) ELSE mag_err END')} AS mag_err FROM valid""")
def error_rescale(t: Tables):
    """Factors per telescope as a small table; a telescope without factors keeps its errors."""
    factors = models.rescaling_table(t.spark, {"lsc-doma": (0.01, 1.1), "cpt-doma": (0.02, 0.9)})
    d = t.valid.join(F.broadcast(factors), t.valid["site"] == factors["telescope"], "left")
    return rounded(d, ["image_id", "seq", "star_id"], {"mag_err": phot.rescale_error("mag_err", "a0", "a1")})


@query("limb_coefficient", with_views("phot", extra="f AS (SELECT DISTINCT concat('star_', star_id, '_', site, '_', filter, '.dat') AS name FROM phot)")
    + """SELECT name, CASE WHEN name LIKE '%!_ip%' ESCAPE '!' THEN 0.503e0 WHEN name LIKE '%!_rp%' ESCAPE '!' THEN 0.6445e0 WHEN name LIKE '%!_gp%' ESCAPE '!' THEN 0.8371e0 END AS gamma FROM f""")
def limb_coefficient(t: Tables):
    names = t.phot.select(F.concat(F.lit("star_"), F.col("star_id"), F.lit("_"), "site", F.lit("_"), "filter", F.lit(".dat")).alias("name")).distinct()
    return names.select("name", phot.limb_coefficient("name").alias("gamma"))


@query("noise_model", with_views("images", extra="""a AS (SELECT count(*) AS n, sum(1/(sky+1)) AS isky, avg(1/pow(0.09e0*pow(1e2, -0.67e0)*pow(1e0 + moon_fraction, 1.5e0)*exp(-2e3/8e3)*pow(2*(1e1 + nstars), -0.5e0), 2)) AS iscint FROM images),
    g AS (SELECT 14e0 + i/1e1 AS mag, pow(1e1, (14e0 + i/1e1 - 25e0)/-2.5e0)*2e0 AS flux, n, isky, iscint FROM a, range(0, 70) r(i)),
    x AS (SELECT *, 2.5e0/flux*log10(exp(1e0)) AS lf FROM g),
    y AS (SELECT mag, sqrt(1e2*pi()*16)*lf/sqrt(n) AS rd, sqrt(2*pi()*16)*lf/sqrt(isky) AS sk, sqrt(flux)*lf/sqrt(n) AS st, 1/sqrt(iscint) AS sc FROM x)""")
    + f"SELECT {r6('mag')} AS mag, {r6('rd', 9)} AS read_noise, {r6('sk', 9)} AS sky_noise, {r6('st', 9)} AS star_noise, {r6('sc', 9)} AS scint_noise, {r6('sqrt(rd*rd+sk*sk+st*st+sc*sc)', 9)} AS total_noise FROM y")
def noise_model(t: Tables):
    frames = t.images.select((F.col("sky") + 1).alias("sky"), (F.lit(1.0) + F.col("moon_fraction")).alias("airmass"), (F.lit(10.0) + F.col("nstars")).alias("exposure"))
    out = models.noise_model(frames, 14.0, 0.1, 70, zero_point=25.0, gain=2.0, read_noise=10.0, aperture_diameter=8.0, telescope_diameter_m=1.0, height_m=2000.0)
    return out.select(settled("mag").alias("mag"), *[settled(c, 9).alias(c) for c in ("read_noise", "sky_noise", "star_noise", "scint_noise", "total_noise")])


@query("kernel_bin", with_views("images", extra="p AS (SELECT floor(3*quantile_cont(fwhm, 0.2)) AS k1, floor(3*quantile_cont(fwhm, 0.4)) AS k2 FROM images)")
    + """SELECT image_id, CAST(least(CAST(floor(3*fwhm) >= k1 AS int) + CAST(floor(3*fwhm) >= k2 AS int), 1) AS int) AS kernel_bin,
    CAST(CASE WHEN CAST(floor(3*fwhm) >= k1 AS int) + CAST(floor(3*fwhm) >= k2 AS int) = 0 THEN k1 ELSE k2 END AS bigint) AS kernel_size FROM images, p""")
def kernel_bin(t: Tables):
    """Kernel sizes from the 20th and 40th percentile of FWHM; the bin of every image."""
    q = aggregate_with_quantiles(t.images, [], [], {"q": ("fwhm", [0.2, 0.4])}).select(
        F.floor(3 * F.col("q")[0]).alias("k1"), F.floor(3 * F.col("q")[1]).alias("k2")
    )
    size = F.floor(3 * F.col("fwhm"))
    bins = (size >= F.col("k1")).cast("int") + (size >= F.col("k2")).cast("int")
    return stats.attach_row(t.images, q).select(
        "image_id", F.least(bins, F.lit(1)).cast("int").alias("kernel_bin"), F.when(bins == 0, F.col("k1")).otherwise(F.col("k2")).alias("kernel_size")
    )


@query("angular_separation", with_views("stars", extra="b AS (SELECT star_id, ra + ((star_id*31) % 7 - 3)*2e-1/3600e0 AS ra2, dec + (star_id % 5)/3600e0 AS dec2 FROM stars)")
    + f"""SELECT star_id, {r6('degrees(acos(greatest(-1e0, least(1e0, sin(radians(dec))*sin(radians(-29e0)) + cos(radians(dec))*cos(radians(-29e0))*cos(radians(ra-268e0))))))')} AS far_deg,
    {r6('sqrt(pow((ra-ra2)*cos(radians(dec)),2)+pow(dec-dec2,2))*3600')} AS near_arcsec, {r6('sqrt(pow(ra-ra2,2)+pow(dec-dec2,2))*3600')} AS flat_arcsec FROM stars JOIN b USING (star_id)""")
def angular_separation(t: Tables):
    k = F.col("star_id")
    d = t.stars.withColumn("ra2", F.col("ra") + ((k * 31) % 7 - 3) * F.lit(0.2) / 3600.0).withColumn("dec2", F.col("dec") + (k % 5) / 3600.0)
    return rounded(d, ["star_id"], {
        "far_deg": sky.separation_deg("ra", "dec", 268.0, -29.0), "near_arcsec": sky.residual_spherical_arcsec("ra", "dec", "ra2", "dec2"),
        "flat_arcsec": sky.residual_flat_arcsec("ra", "dec", "ra2", "dec2"),
    })


@query("offset_coordinates", with_views("stars", extra="o AS (SELECT star_id, ra + 1e-3 AS ra1, dec - 2e-3 AS dec1, ra - 267.5e0 AS u, dec + 29.5e0 AS v FROM stars)")
    + f"""SELECT star_id, {r6('ra1')} AS ra, {r6('dec1')} AS dec, {r6('0.999e0*u + 0.01e0*v + 0.1e0')} AS ax, {r6('-0.01e0*u + 1.001e0*v - 0.2e0')} AS ay,
    {r6('1e-1 + 1.001e0*u + 1e-2*u*u + 1e-3*u*u*u + 2e-3*v + 1e-4*v*v + 1e-5*v*v*v')} AS px, {r6('-1e-1 + 1e-3*u + 2e-3*u*u + 3e-3*u*u*u + 0.998e0*v + 4e-3*v*v + 5e-3*v*v*v')} AS py FROM o""")
def offset_coordinates(t: Tables):
    u, v = F.col("ra") - 267.5, F.col("dec") + 29.5
    ax, ay = models.affine(u, v, [[0.999, 0.01, 0.1], [-0.01, 1.001, -0.2]])
    px, py = models.cubic_without_cross_terms(u, v, [0.1, 1.001, 0.01, 0.001, 0.002, 1e-4, 1e-5], [-0.1, 0.001, 0.002, 0.003, 0.998, 0.004, 0.005])
    return rounded(t.stars, ["star_id"], {"ra": F.col("ra") + 0.001, "dec": F.col("dec") - 0.002, "ax": ax, "ay": ay, "px": px, "py": py})


@query("udf_sky", with_views("valid", "stars") + f"""SELECT image_id, seq, star_id, {r6('pow(1e1, (mag-25e0)/-2.5e0)')} AS flux, {r6('25e0 - 2.5e0*log10(pow(1e1, (mag-25e0)/-2.5e0))')} AS mag_back,
    {r6('degrees(2*asin(least(1e0, sqrt(pow(sin(radians(-29e0-dec)/2),2) + cos(radians(dec))*cos(radians(-29e0))*pow(sin(radians(268e0-ra)/2),2)))))')} AS sep FROM valid JOIN stars USING (star_id)""")
def udf_sky(t: Tables):
    """The same functions inside SQL text, as SQL functions that Catalyst inlines."""
    models.register_sql_functions(t.spark)
    return t.spark.sql(
        """SELECT image_id, seq, star_id, round(mag_to_flux(mag), 6) + 0e0 AS flux, round(flux_to_mag(mag_to_flux(mag)), 6) + 0e0 AS mag_back,
               round(sky_separation(ra, dec, 268e0, -29e0), 6) + 0e0 AS sep
           FROM {valid} JOIN {stars} USING (star_id)""", valid=t.valid, stars=t.stars,
    )
