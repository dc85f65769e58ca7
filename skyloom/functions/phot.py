"""Fluxes, magnitudes, colours and their errors."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from skyloom.functions.common import as_column, num, polynomial, quadrature, ratio

# fixed values: zero points of instrumental and model magnitudes
INSTRUMENT_ZP = 25.0
MODEL_ZP = 27.4
MAG_PER_LN = 2.5 / math.log(10.0)

# fixed values: Gaia DR2 VEGAMAG zero points (Evans et al. 2018)
GAIA_ZP = {"G": 25.6884, "G_BP": 25.3514, "G_RP": 24.7619}

# fixed values: Gaia DR2 colour polynomials, lowest power first, and their scatter (Evans et al. 2018)
GAIA_TO_SDSS = {
    "g": ([0.13518, -0.46245, -0.25171, 0.021349], 0.16497),
    "r": ([-0.12879, 0.24662, -0.027464, -0.049465], 0.066739),
    "i": ([-0.29676, 0.64728, -0.10141], 0.098957),
}
GAIA_TO_JOHNSON = {
    "V": ([-0.01760, -0.006860, -0.1732], 0.045858),
    "R": ([-0.003226, 0.3833, -0.1345], 0.04840),
    "I": ([0.02085, 0.7419, -0.09631], 0.04956),
}

# fixed values: limb-darkening coefficient per filter code
LIMB_DARKENING = {"gp": 0.8371, "rp": 0.6445, "ip": 0.503, "Z": 0.4134}

COLOUR_SENTINEL = -99.999


def flux_to_mag(flux, flux_err, zero_point: float = INSTRUMENT_ZP, exposure=None) -> tuple[Column, Column]:
    """Magnitude and error; 0 and 0 where the flux is not positive or its error negative."""
    flux, flux_err = as_column(flux), as_column(flux_err)
    fraction = ratio(flux_err, flux)
    if exposure is not None:
        flux = ratio(flux, exposure)
    ok = (flux > 0) & (flux_err >= 0)
    mag = F.when(ok, num(zero_point) - 2.5 * F.log10(flux)).otherwise(num(0.0))
    return mag, F.when(ok, num(MAG_PER_LN) * fraction).otherwise(num(0.0))


def mag_to_flux(mag, mag_err, zero_point: float = INSTRUMENT_ZP) -> tuple[Column, Column]:
    flux = F.pow(num(10.0), (as_column(mag) - zero_point) / -2.5)
    return flux, as_column(mag_err) / num(2.5 * math.log10(math.e)) * flux


def gaia_flux_to_mag(flux, flux_err, band: str) -> tuple[Column, Column]:
    return flux_to_mag(flux, flux_err, GAIA_ZP[band])


def gaia_to_sdss(g_mag, g_err, colour, colour_err) -> dict[str, Column]:
    """SDSS g, r, i from Gaia G and BP−RP, errors with every term of the polynomial derivative."""
    m, e, c, s = (as_column(x) for x in (g_mag, g_err, colour, colour_err))
    out = {}
    for band, (p, scatter) in GAIA_TO_SDSS.items():
        out[band] = m - polynomial(c, p)
        variance = (e * e + num(p[1] ** 2)) * s * s + num(4 * p[2] ** 2) * c * c * s * s + num(scatter**2)
        if len(p) > 3:
            variance = variance + num(9 * p[3] ** 2) * F.pow(c, num(4.0)) * s * s
        out[band + "_err"] = F.sqrt(variance)
    return out


def gaia_to_johnson(g_mag, g_err, colour) -> dict[str, Column]:
    out = {}
    for band, (p, scatter) in GAIA_TO_JOHNSON.items():
        out[band] = as_column(g_mag) - polynomial(colour, p)
        out[band + "_err"] = quadrature(g_err, scatter)
    return out


def colour(blue, blue_err, red, red_err) -> tuple[Column, Column]:
    """Colour and error, null where a band is not measured."""
    both = (as_column(blue) > 0) & (as_column(red) > 0)
    return F.when(both, as_column(blue) - as_column(red)), F.when(both, quadrature(blue_err, red_err))


def with_sentinel(x, sentinel: float = COLOUR_SENTINEL) -> Column:
    return F.coalesce(as_column(x), num(sentinel))


def deredden(mag, mag_err, extinction, extinction_err) -> tuple[Column, Column]:
    return as_column(mag) - as_column(extinction), quadrature(mag_err, extinction_err)


def per_filter(filter_col, values: dict[str, float]) -> Column:
    """Value looked up by filter code, null for an unknown code."""
    pairs = [F.lit(x) for k, v in values.items() for x in (k, float(v))]
    return F.try_element_at(F.create_map(*pairs), as_column(filter_col))


def limb_coefficient(file_name) -> Column:
    """Coefficient of the last filter code whose ``_code`` occurs in a file name."""
    name = as_column(file_name)
    out = F.lit(None).cast("double")
    for code, value in LIMB_DARKENING.items():
        out = F.when(name.contains("_" + code), num(value)).otherwise(out)
    return out


def rescale_error(err, a0, a1) -> Column:
    """sqrt(a0² + a1²σ²); σ itself where no factors exist."""
    err, a0, a1 = as_column(err), as_column(a0), as_column(a1)
    return F.coalesce(F.sqrt(a0 * a0 + a1 * a1 * err * err), err)


def calibrate(mag, err, a, b, c00, c01, c11) -> tuple[Column, Column]:
    """a·m + b with the covariance of the fit; 0 for magnitudes below 7."""
    mag, err, a, b, c00, c01, c11 = (as_column(x) for x in (mag, err, a, b, c00, c01, c11))
    variance = mag * mag * c00 + 2 * mag * c01 + c11 + a * a * err * err
    ok = mag >= 7.0
    return F.when(ok, a * mag + b).otherwise(num(0.0)), F.when(ok, F.sqrt(variance)).otherwise(num(0.0))


def max_expected_error(mean_mag) -> Column:
    """Largest error expected at a magnitude, from the field's scatter relation."""
    # fixed values: slope, offset and scatter of log10(rms) against magnitude
    slope, offset, scatter = 0.232444, -5.0562, 0.310577
    return F.pow(num(10.0), num(slope) * as_column(mean_mag) + num(offset) + num(scatter))
