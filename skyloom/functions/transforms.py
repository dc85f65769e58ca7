"""Published colour transformations between photometric systems."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyloom.functions.common import as_column, num, quadrature, ratio

# fixed values: SDSS → Johnson-Cousins colours (Jester et al. 2005): output, input, slope, offset, scatter
TO_JOHNSON_COLOURS = [
    ("ub", "ug", 0.78, -0.88, 0.05),
    ("bv", "gr", 0.98, 0.22, 0.04),
    ("vr", "ri", 1.09, 0.22, 0.03),
    ("rcic", "ri", 1.00, 0.21, 0.01),
]
# output, slope on g−r, offset, scatter
TO_JOHNSON_MAGS = [("b", 0.39, 0.21, 0.03), ("v", -0.59, -0.01, 0.01)]

# fixed values: Johnson-Cousins → SDSS colours (Jester et al. 2005)
TO_SDSS_COLOURS = [
    ("ug", "ub", 1.28, 1.13, 0.06),
    ("gr", "bv", 1.02, -0.22, 0.04),
    ("ri", "rcic", 0.91, -0.20, 0.03),
    ("rz", "rcic", 1.72, -0.41, 0.03),
]
# output, slope on B−V, offset, scatter
TO_SDSS_MAGS = [("g", 0.60, -0.12, 0.02), ("r", -0.42, 0.11, 0.03)]

# fixed values: 2MASS → SDSS (Bilir et al. 2008): lower metallicity limit,
# J−H, H−K and constant terms of g−r and its scatter, then the same for r−i
TWOMASS_TO_SDSS = [
    (-0.4, (1.991, 1.348, -0.247, 0.136), (1.000, 1.004, -0.220, 0.120)),
    (-1.2, (1.217, 0.491, 0.050, 0.083), (0.600, 0.268, -0.049, 0.037)),
    (-3.0, (1.422, 0.600, -0.003, 0.099), (0.609, 0.279, -0.047, 0.045)),
]
TWOMASS_ALL = ((1.951, 1.199, -0.230, 0.135), (0.991, 0.792, -0.210, 0.107))


def sdss_to_johnson(values: dict[str, Column | str]) -> dict[str, Column]:
    """Colours and magnitudes for the inputs given (``ug gr ri g``); missing inputs give no output.

    Inputs come as name and ``name_err``; a null input gives a null output.
    """
    out = {}
    for name, source, slope, offset, scatter in TO_JOHNSON_COLOURS:
        if source in values:
            out[name] = num(slope) * as_column(values[source]) + num(offset)
            out[name + "_err"] = quadrature(values[source + "_err"], scatter)
    if "g" in values and "gr" in values:
        for name, slope, offset, scatter in TO_JOHNSON_MAGS:
            out[name] = as_column(values["g"]) + num(slope) * as_column(values["gr"]) + num(offset)
            out[name + "_err"] = quadrature(values["g_err"], values["gr_err"], scatter)
    return out


def johnson_derived(v: dict[str, Column]) -> dict[str, Column]:
    """R, I and V−I from V, V−R and Rc−Ic."""
    r, r_err = v["v"] - v["vr"], quadrature(v["v_err"], v["vr_err"])
    i, i_err = r - v["rcic"], quadrature(r_err, v["rcic_err"])
    return {"r": r, "r_err": r_err, "i": i, "i_err": i_err, "vi": v["v"] - i, "vi_err": quadrature(v["v_err"], i_err)}


def johnson_to_sdss(values: dict[str, Column | str]) -> dict[str, Column]:
    """Inverse direction; errors scale with output over input, as the relation is defined."""
    out = {}
    for name, source, slope, offset, scatter in TO_SDSS_COLOURS:
        if source in values:
            x = as_column(values[source])
            out[name] = num(slope) * x + num(offset)
            out[name + "_err"] = quadrature(ratio(out[name], x) * as_column(values[source + "_err"]), scatter)
    if "v" in values and "bv" in values:
        v, bv = as_column(values["v"]), as_column(values["bv"])
        for name, slope, offset, scatter in TO_SDSS_MAGS:
            m = v + num(slope) * bv + num(offset)
            out[name] = m
            out[name + "_err"] = quadrature(ratio(m, v) * as_column(values["v_err"]), ratio(m, bv) * as_column(values["bv_err"]), scatter)
    return out


def twomass_to_sdss(jh, hk, metallicity=None) -> dict[str, Column]:
    """g−r and r−i with their scatter; coefficients follow the metallicity where it is known."""
    jh, hk = as_column(jh), as_column(hk)

    def choose(which: int, k: int) -> Column:
        chosen = num(TWOMASS_ALL[which][k])
        if metallicity is None:
            return chosen
        m = as_column(metallicity)
        for limit, gr, ri in reversed(TWOMASS_TO_SDSS):
            chosen = F.when(m > limit, num((gr, ri)[which][k])).otherwise(chosen)
        return chosen

    out = {}
    for which, name in enumerate(("gr", "ri")):
        out[name] = choose(which, 0) * jh + choose(which, 1) * hk + choose(which, 2)
        out[name + "_err"] = choose(which, 3)
    return out
