"""Physical parameters of a lens from model parameters, one row per model or posterior sample."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions.common import num, quadrature, ratio
from skyloom.functions.stellar import AU, GRAVITY, LIGHT_SPEED, M_SUN, PARSEC, distance_modulus, muas_to_rad

# fixed value: days per year in the motion relations
YEAR = 365.24
KAPPA = LIGHT_SPEED**2 * AU / (4.0 * GRAVITY)


def _fraction(value: str, err: str) -> Column:
    return ratio(F.col(err), F.col(value))


def lens_parameters(models: DataFrame) -> DataFrame:
    """Adds θE, πrel, lens distance, RE, masses, separation, energy ratio and proper motion with errors.

    Input columns: tE rho piEN piEE thetaS DS s q dsdt dalphadt, each with ``sig_`` but q. Angles in
    µas, DS in kpc, tE in days. σ of the source parallax uses the relative error of DS; the published
    code divides an au by σ in kpc, a mix of units.
    """
    d = models
    d = d.withColumn("piE", quadrature("piEN", "piEE")).withColumn("sig_piE", quadrature("sig_piEN", "sig_piEE"))
    d = d.withColumn("thetaE", ratio(F.col("thetaS"), F.col("rho")))
    d = d.withColumn("sig_thetaE", quadrature(_fraction("thetaS", "sig_thetaS"), _fraction("rho", "sig_rho")) * F.col("thetaE"))
    d = d.withColumn("pi_rel", F.col("thetaE") * F.col("piE"))
    d = d.withColumn("sig_pi_rel", quadrature(_fraction("thetaE", "sig_thetaE"), _fraction("piE", "sig_piE")) * F.col("pi_rel"))

    ds_m = F.col("DS") * 1000.0 * num(PARSEC)
    pi_s = ratio(num(AU), ds_m)
    d = d.withColumn("_pi_l", muas_to_rad("pi_rel") + pi_s)
    d = d.withColumn("_sig_pi_l", quadrature(muas_to_rad("sig_pi_rel"), pi_s * _fraction("DS", "sig_DS")))
    d = d.withColumn("DL", ratio(num(AU), F.col("_pi_l")) / num(PARSEC) / 1000.0)
    d = d.withColumn("sig_DL", ratio(F.col("_sig_pi_l"), F.col("_pi_l")) * F.col("DL"))
    d = d.withColumn("dist_mod", distance_modulus("DL"))
    d = d.withColumn("sig_dist_mod", _fraction("DL", "sig_DL") * F.col("dist_mod"))

    kpc_au = 1000.0 * PARSEC / AU
    theta, sig_theta = muas_to_rad("thetaE"), muas_to_rad("sig_thetaE")
    d = d.withColumn("RE", F.col("DL") * num(kpc_au) * F.sin(theta))
    d = d.withColumn("sig_RE", quadrature(_fraction("DL", "sig_DL"), ratio(F.cos(theta) * sig_theta, theta)) * F.col("RE"))

    d = d.withColumn("ML", ratio(num(KAPPA / M_SUN) * theta, F.col("piE")))
    d = d.withColumn("sig_ML", quadrature(_fraction("thetaE", "sig_thetaE"), _fraction("piE", "sig_piE")) * F.col("ML"))
    d = d.withColumn("M1", F.col("ML") / (1.0 + F.col("q"))).withColumn("M2", F.col("ML") * F.col("q") / (1.0 + F.col("q")))
    d = d.withColumn("sig_M1", _fraction("ML", "sig_ML") * F.col("M1")).withColumn("sig_M2", _fraction("ML", "sig_ML") * F.col("M2"))

    d = d.withColumn("a_proj", F.col("s") * F.col("DL") * num(kpc_au) * theta)
    parts = (_fraction("s", "sig_s"), _fraction("DL", "sig_DL"), _fraction("thetaE", "sig_thetaE"))
    d = d.withColumn("sig_a_proj", quadrature(*parts) * F.col("a_proj"))

    sre = F.col("s") * F.col("RE")
    f_sre = quadrature(_fraction("s", "sig_s"), _fraction("RE", "sig_RE"))
    dsdt, dadt = F.col("dsdt") * YEAR, F.col("dalphadt") * YEAR
    gamma_sq = ratio(dsdt, F.col("s")) * ratio(dsdt, F.col("s")) + dadt * dadt
    f_gamma = quadrature(_fraction("dsdt", "sig_dsdt"), _fraction("s", "sig_s"), _fraction("dalphadt", "sig_dalphadt"))
    d = d.withColumn("kepe", ratio(sre * sre * sre * gamma_sq, num(8.0 * math.pi**2) * F.col("ML")))
    d = d.withColumn("sig_kepe", quadrature(3.0 * f_sre, 2.0 * f_gamma, _fraction("ML", "sig_ML")) * F.col("kepe"))

    d = d.withColumn("mu_rel", ratio(F.col("thetaE"), F.col("tE")) * num(YEAR / 1000.0))
    d = d.withColumn("sig_mu_rel", quadrature(_fraction("thetaE", "sig_thetaE"), _fraction("tE", "sig_tE")) * F.col("mu_rel"))
    return d.drop("_pi_l", "_sig_pi_l")
