"""Stars: red clump model, angular and physical radii, distances, luminosity class, table interpolation."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, functions as F

from skyloom.functions.common import as_column, num, polynomial, quadrature, ratio
from skyloom.functions.sky import galactic_longitude_latitude

# fixed values: SI constants
PARSEC = 3.085677581491367e16
AU = 1.495978707e11
R_SUN = 6.957e8
M_SUN = 1.988409870698051e30
LIGHT_SPEED = 299792458.0
GRAVITY = 6.6743e-11

# fixed values: red clump absolute magnitudes and errors (Bensby et al. 2017; Ruiz-Dern et al. 2017)
RED_CLUMP = {
    "V": (0.97, 0.0),
    "I": (-0.12, 0.0),
    "G": (0.495, 0.009),
    "J": (-0.945, 0.01),
    "H": (-1.450, 0.017),
    "Ks": (-1.606, 0.009),
    "g": (1.331, 0.056),
    "r": (0.552, 0.026),
    "i": (0.262, 0.032),
    "W1": (-1.711, 0.017),
    "W2": (-1.585, 0.016),
    "W3": (-1.638, 0.011),
    "W4": (-1.704, 0.012),
}
# fixed values: distance of the Galactic centre [kpc], bar angle [deg], clump I at the centre (Nataf et al. 2013)
CENTRE_KPC, BAR_DEG, CLUMP_I = 8.16, 40.0, 14.443

# fixed values: log angular diameter polynomials (Adams et al. 2018): class, colour → coefficients, errors, range
ADAMS = {
    ("all", "I-H"): ([0.541, 0.133, 0.0], [0.004, 0.003, 0.0], (-0.042, 1.935)),
    ("all", "I-K"): ([0.528, 0.108, 0.0], [0.005, 0.003, 0.0], (0.019, 2.159)),
    ("all", "V-I"): ([0.542, 0.391, 0.0], [0.006, 0.006, 0.0], (-0.050, 1.740)),
    ("all", "V-H"): ([0.538, 0.074, 0.0], [0.004, 0.002, 0.0], (-0.052, 3.615)),
    ("all", "V-K"): ([0.529, 0.062, 0.0], [0.004, 0.002, 0.0], (-0.021, 3.839)),
    ("dwarfs", "I-H"): ([0.529, 0.166, 0.0], [0.007, 0.010, 0.0], (-0.042, 1.198)),
    ("dwarfs", "I-K"): ([0.520, 0.118, 0.0], [0.007, 0.010, 0.0], (0.019, 1.309)),
    ("dwarfs", "V-I"): ([0.542, 0.378, 0.0], [0.007, 0.011, 0.0], (-0.050, 1.160)),
    ("dwarfs", "V-H"): ([0.534, 0.079, 0.0], [0.005, 0.003, 0.0], (-0.052, 3.447)),
    ("dwarfs", "V-K"): ([0.523, 0.063, 0.0], [0.006, 0.005, 0.0], (-0.021, 2.209)),
    ("giants", "I-H"): ([0.523, 0.144, 0.0], [0.011, 0.007, 0.0], (0.065, 1.935)),
    ("giants", "I-K"): ([0.543, 0.098, 0.0], [0.011, 0.007, 0.0], (1.129, 2.159)),
    ("giants", "V-I"): ([0.535, 0.490, -0.068], [0.027, 0.046, 0.019], (-0.010, 1.740)),
    ("giants", "V-H"): ([0.532, 0.076, 0.0], [0.009, 0.003, 0.0], (0.055, 3.615)),
    ("giants", "V-K"): ([0.562, 0.051, 0.0], [0.009, 0.003, 0.0], (2.049, 3.839)),
}
# fixed values: log angular diameter polynomials (Boyajian et al. 2014)
BOYAJIAN = {
    "g-r": ([0.66728, 0.58135, 0.88293, -1.41005, 0.67248], [0.00203, 0.01180, 0.03470, 0.04331, 0.01736], (-0.23, 1.40)),
    "g-i": ([0.69174, 0.54346, -0.02149, 0.0, 0.0], [0.00125, 0.00266, 0.00097, 0.0, 0.0], (-0.43, 2.78)),
    "V-I": ([0.50659, 0.56448, 0.17460, -0.16268, 0.03292], [0.00103, 0.00793, 0.01647, 0.01002, 0.00184], (-0.02, 2.77)),
}
# fixed values: log radius from log Teff and log g (Torres et al. 2010), b1..b7 and scatter
TORRES = (2.4427, 0.6679, 0.1771, 0.705, -0.21415, 0.02306, 0.04173)
TORRES_SCATTER = 0.014

# fixed values: extinction per unit reddening at four R_V (Schlafly & Finkbeiner 2011, table 6)
RV_GRID = [2.1, 3.1, 4.1, 5.1]
RV_TABLE = {
    "g": [3.843, 3.303, 3.054, 2.910],
    "r": [2.255, 2.285, 2.300, 2.308],
    "i": [1.583, 1.698, 1.751, 1.782],
    "z": [1.211, 1.263, 1.286, 1.300],
}
# fixed values: intrinsic colours of giants by V−I (Bessell & Brett 1988, table 3); error 0.04. The second 0.94 is
# put up to 0.94001, because an interpolation needs rising knots
GIANT_VI = [0.81, 0.91, 0.94, 0.94001, 1.00, 1.08, 1.17, 1.36, 1.50, 1.63, 1.78, 1.90, 2.05, 2.25, 2.55, 3.05]
GIANT_COLOURS = {
    "V-K": [1.75, 2.05, 2.15, 2.16, 2.31, 2.50, 2.70, 3.00, 3.26, 3.60, 3.85, 4.05, 4.30, 4.64, 5.10, 5.96],
    "J-H": [0.37, 0.47, 0.50, 0.50, 0.54, 0.58, 0.63, 0.68, 0.73, 0.79, 0.83, 0.85, 0.87, 0.90, 0.93, 0.95],
    "H-K": [0.065, 0.08, 0.085, 0.085, 0.095, 0.10, 0.115, 0.14, 0.15, 0.165, 0.19, 0.205, 0.215, 0.235, 0.245, 0.285],
    "J-K": [0.45, 0.55, 0.58, 0.58, 0.63, 0.68, 0.74, 0.82, 0.88, 0.95, 1.01, 1.05, 1.08, 1.13, 1.17, 1.23],
    "K-L": [0.04, 0.05, 0.06, 0.06, 0.07, 0.08, 0.09, 0.10, 0.11, 0.12, 0.12, 0.13, 0.15, 0.17, 0.18, 0.20],
    "K-L'": [0.05, 0.06, 0.07, 0.07, 0.08, 0.09, 0.10, 0.12, 0.14, 0.16, 0.17, 0.17, 0.19, 0.20, 0.21, 0.22],
    "K-M": [0.0, -0.01, -0.02, -0.02, -0.03, -0.04, -0.05, -0.06, -0.07, -0.08, -0.09, -0.10, -0.12, -0.13, -0.14, -0.15],
}
# fixed values: intrinsic colours of dwarfs from B8 to M6, by V−K (Bessell & Brett 1988, table 2)
DWARF_VK = [-0.35, 0.00, 0.14, 0.38, 0.50, 0.70, 0.82, 1.10, 1.32, 1.41, 1.46, 1.53, 1.64, 1.96, 2.22, 2.63, 2.85, 3.16, 3.65, 3.87, 4.11, 4.65, 5.26, 6.12, 7.30]
DWARF_COLOURS = {
    "V-I": [-0.15, 0.00, 0.06, 0.27, 0.24, 0.33, 0.40, 0.53, 0.62, 0.66, 0.68, 0.71, 0.75, 0.88, 0.98, 1.15, 1.22, 1.45, 1.80, 1.96, 2.14, 2.47, 2.86, 3.39, 4.18],
    "J-H": [-0.05, 0.00, 0.02, 0.06, 0.09, 0.13, 0.165, 0.23, 0.285, 0.305, 0.32, 0.33, 0.37, 0.45, 0.50, 0.58, 0.61, 0.66, 0.695, 0.68, 0.665, 0.62, 0.60, 0.62, 0.66],
    "H-K": [-0.035, 0.00, 0.005, 0.015, 0.025, 0.03, 0.035, 0.04, 0.045, 0.05, 0.052, 0.055, 0.06, 0.075, 0.09, 0.105, 0.11, 0.13, 0.165, 0.20, 0.21, 0.25, 0.275, 0.32, 0.37],
    "J-K": [-0.09, 0.00, 0.02, 0.08, 0.11, 0.16, 0.19, 0.27, 0.34, 0.36, 0.37, 0.385, 0.43, 0.53, 0.59, 0.68, 0.72, 0.79, 0.86, 0.87, 0.87, 0.87, 0.88, 0.94, 1.03],
    "K-L": [-0.03, 0.00, 0.01, 0.02, 0.03, 0.03, 0.03, 0.04, 0.04, 0.05, 0.05, 0.05, 0.05, 0.06, 0.07, 0.09, 0.10, 0.11, 0.14, 0.15, 0.16, 0.20, 0.23, 0.29, 0.36],
    "K-L'": [-0.04, 0.00, 0.01, 0.02, 0.03, 0.03, 0.03, 0.04, 0.04, 0.05, 0.05, 0.05, 0.05, 0.06, 0.07, 0.10, 0.11, 0.13, 0.17, 0.21, 0.23, 0.32, 0.37, 0.42, 0.48],
    "K-M": [-0.05, 0.00, 0.01, 0.03, 0.03, 0.03, 0.03, 0.02, 0.02, 0.01, 0.01, 0.01, 0.00, -0.01, -0.02, -0.04, None, None, None, None, None, None, None, None, None],
}
# the seven colours of both tables beside the one they are looked up by (V−K), as column names
COLOUR_NAMES = {"V-I": "vi", "J-H": "jh", "H-K": "hk", "J-K": "jk", "K-L": "kl", "K-L'": "klp", "K-M": "km"}
COLOUR_TABLE_ERROR = 0.04


def colour_rows() -> list[tuple]:
    """Rows (class, vk, vi, jh, hk, jk, kl, klp, km) of the built-in tables of dwarfs and giants, for a table as a DataFrame."""
    giants = {"V-I": GIANT_VI} | GIANT_COLOURS
    out = [("dwarf", vk, *[DWARF_COLOURS[c][n] for c in COLOUR_NAMES]) for n, vk in enumerate(DWARF_VK)]
    return out + [("giant", vk, *[giants[c][n] for c in COLOUR_NAMES]) for n, vk in enumerate(GIANT_COLOURS["V-K"])]


def distance_modulus(kpc) -> Column:
    return 5.0 * F.log10(as_column(kpc) * 1000.0) - 5.0


def red_clump_distance_kpc(ra, dec) -> Column:
    """Distance along the bar in the direction of a position."""
    lon, _ = galactic_longitude_latitude(ra, dec)
    lon = F.radians(lon)
    return num(CENTRE_KPC) / (F.cos(lon) + F.sin(lon) / num(math.tan(math.radians(BAR_DEG))))


def red_clump_apparent(band: str, kpc) -> Column:
    return num(RED_CLUMP[band][0]) + distance_modulus(kpc)


def red_clump_apparent_i(kpc) -> Column:
    """Apparent I from the clump at the Galactic centre."""
    return num(CLUMP_I) + 5.0 * F.log10(ratio(num(CENTRE_KPC), kpc))


def distance_pc(app, app_err, absolute, abs_err) -> tuple[Column, Column]:
    """Distance from apparent and absolute magnitude; error from the values shifted by both errors."""
    app, app_err, absolute, abs_err = (as_column(x) for x in (app, app_err, absolute, abs_err))

    def d(m, big_m):
        return F.pow(num(10.0), (m - big_m + 5.0) / 5.0)

    return d(app, absolute), (d(app + app_err, absolute + abs_err) - d(app - app_err, absolute - abs_err)) / 2.0


def log_angular_diameter(table: tuple, mag, mag_err, colour, colour_err) -> tuple[Column, Column, Column]:
    """Log of the angular diameter, its error and whether the colour is in the range of the relation."""
    coefficients, errors, (low, high) = table
    colour = as_column(colour)
    value = polynomial(colour, coefficients) - 0.2 * as_column(mag)
    spread = F.sqrt(
        as_column(colour_err) * as_column(colour_err) + num(sum(e * e for e in errors)) + as_column(mag_err) * as_column(mag_err)
    )
    return value, spread, colour.between(low, high)


def angular_radius_muas(log_diameter, log_diameter_err) -> tuple[Column, Column]:
    diameter = F.pow(num(10.0), as_column(log_diameter)) * 1000.0
    return diameter / 2.0, ratio(log_diameter_err, F.abs(as_column(log_diameter))) * diameter / 2.0


def muas_to_rad(x) -> Column:
    return F.radians(as_column(x) / 1e6 / 3600.0)


def rad_to_muas(x) -> Column:
    return F.degrees(as_column(x)) * 3600.0 * 1e6


def radius_at_distance(theta_muas, theta_err, pc) -> tuple[Column, Column]:
    """Radius in solar radii of an angular radius seen at a distance."""
    r = as_column(pc) * num(PARSEC) * F.sin(muas_to_rad(theta_muas)) / num(R_SUN)
    return r, ratio(theta_err, theta_muas) * r


def torres_radius(teff, logg, metallicity) -> tuple[Column, Column]:
    b1, b2, b3, b4, b5, b6, b7 = TORRES
    x, g = F.log10(as_column(teff)) - 4.1, as_column(logg)
    log_r = polynomial(x, [b1, b2, b3, b4]) + num(b5) * g * g + num(b6) * g * g * g + num(b7) * as_column(metallicity)
    r = F.pow(num(10.0), log_r)
    return r, F.abs(ratio(num(TORRES_SCATTER), log_r)) * r


def distance_from_radius_pc(radius, radius_err, theta_muas, theta_err) -> tuple[Column, Column]:
    """R/tan θ; the relative errors of both are added in quadrature.

    The published code mixes 1/σθ and 1/θ² in the second term; the documented meaning is built here.
    """
    d = ratio(as_column(radius) * num(R_SUN), F.tan(muas_to_rad(theta_muas))) / num(PARSEC)
    fr, ft = ratio(radius_err, radius), ratio(theta_err, theta_muas)
    return d, F.sqrt(fr * fr + ft * ft) * d


def luminosity_class(teff, logg) -> Column:
    """dwarf or giant by the log g threshold at a temperature (Ciardi et al. 2011)."""
    teff = as_column(teff)
    limit = F.when(teff >= 6000.0, num(3.5)).when(teff <= 4250.0, num(4.0)).otherwise(num(5.2) - num(2.8e-4) * teff)
    return F.when(as_column(logg) > limit, "dwarf").otherwise("giant")


def _segment(x: Column, knots: list[float]) -> Column:
    """1-based number of the interval of the knots that holds x."""
    below = F.size(F.filter(F.array(*[F.lit(k) for k in knots]), lambda k: k <= x))
    return F.least(F.greatest(below, F.lit(1)), F.lit(len(knots) - 1))


def _piecewise(x, knots: list[float], pieces: list[list[float]]) -> Column:
    """Polynomial of each interval in (x − left knot); null outside the table."""
    x = as_column(x)
    k = _segment(x, knots)

    def pick(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), k)

    d = x - pick(knots[:-1])
    power = len(pieces[0])
    out = pick([p[power - 1] for p in pieces])
    for n in range(power - 2, -1, -1):
        out = out * d + pick([p[n] for p in pieces])
    return F.when(x.between(knots[0], knots[-1]), out)


def interpolate_linear(x, knots: list[float], values: list[float]) -> Column:
    steps = [[values[n], (values[n + 1] - values[n]) / (knots[n + 1] - knots[n])] for n in range(len(knots) - 1)]
    return _piecewise(x, knots, steps)


def spline_pieces(knots: list[float], values: list[float]) -> list[list[float]]:
    """Cubic interpolating spline with not-a-knot ends as coefficients per interval.

    The table has a fixed handful of knots, so the solve is a constant cost at plan time.
    """
    x, y = np.asarray(knots, float), np.asarray(values, float)
    n, h = len(x), np.diff(x)
    slope = np.diff(y) / h
    a, b = np.zeros((n, n)), np.zeros(n)
    for k in range(1, n - 1):
        a[k, k - 1], a[k, k], a[k, k + 1] = h[k - 1], 2 * (h[k - 1] + h[k]), h[k]
        b[k] = 6 * (slope[k] - slope[k - 1])
    a[0, :3] = [h[1], -(h[0] + h[1]), h[0]]
    a[-1, -3:] = [h[-1], -(h[-2] + h[-1]), h[-2]]
    m = np.linalg.solve(a, b)
    return [
        [float(y[k]), float(slope[k] - h[k] * (2 * m[k] + m[k + 1]) / 6), float(m[k] / 2), float((m[k + 1] - m[k]) / (6 * h[k]))]
        for k in range(n - 1)
    ]


def interpolate_spline(x, knots: list[float], values: list[float]) -> Column:
    return _piecewise(x, knots, spline_pieces(knots, values))


def band_reddening(ebv, ebv_err, rv, band: str) -> tuple[Column, Column]:
    """Extinction in a band from E(B−V), with R_V interpolated in the table."""
    total = interpolate_linear(rv, RV_GRID, RV_TABLE[band]) * as_column(ebv)
    return total, ratio(ebv_err, ebv) * total
