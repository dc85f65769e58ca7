"""Column types of every stored table as DDL text; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(ddl: str) -> T.StructType:
    """The DDL text as a StructType (needs a session)."""
    return T.StructType.fromDDL(ddl)


PHOT = (
    "field string, quadrant int, filter string, star_id bigint, image_id bigint, seq int, site string, hjd double, mag double, mag_err double, "
    "cal_mag double, cal_mag_err double, corr_mag double, corr_mag_err double, norm_mag double, norm_mag_err double, pscale double, qc_flag int"
)
STARS = ("field_id bigint, ra double, dec double, quadrant int, quadrant_id bigint, gaia_source_id string")
FIELD_INDEX = ("field_id bigint, dataset string, dataset_star_id bigint, separation double")
DATASETS = ("dataset string, site string, filter string, primary_ref int, norm_a double, norm_b double, c00 double, c01 double, c11 double")
IMAGES = (
    "image_index bigint, filename string, dataset string, filter string, hjd double, datetime timestamp, exposure double, ra string, dec string, "
    "moon_distance double, moon_fraction double, airmass double, sigma_x double, sigma_y double, sky double, fwhm double, nstars int, "
    "use_phot int, use_ref int, shift_x double, shift_y double, pscale double, warp array<double>, qc_flag int"
)
STAMPS = ("dataset string, filename string, stamp_id int, x_min int, x_max int, y_min int, y_max int, warp array<double>")
NORMALIZATIONS = ("reference string, star_id bigint, filter string, dataset string, delta_mag double, delta_mag_err double")
CALIBRATIONS = ("dataset string, a double, b double, c00 double, c01 double, c11 double")
MATCHES = ("dataset_star_id bigint, field_id bigint, dataset_ra double, dataset_dec double, field_ra double, field_dec double, separation double")
LIGHTCURVE = ("hjd double, inst_mag double, inst_mag_err double, cal_mag double, cal_mag_err double, pscale double, qc_flag int")

# tables of the field crossmatch bundle and of the photometric database
FIELD_BUNDLE = {"stars": STARS, "field_index": FIELD_INDEX, "datasets": DATASETS, "images": IMAGES, "stamps": STAMPS}
DATABASE = {
    "facilities": ("facility_id bigint, facility_code string, site string, enclosure string, telescope string, instrument string"),
    "filters": ("filter_id bigint, filter_name string"),
    "software": ("code_id bigint, code_name string, version string, stage string"),
    "images": IMAGES,
    "reference_images": ("refimg_id bigint, facility bigint, filter bigint, software bigint, filename string"),
    "reference_components": ("component_id bigint, image bigint, reference_image bigint"),
    "stars": STARS,
    "phot": PHOT,
    "stamps": STAMPS,
}

# survey column → common column, per catalogue release
CATALOGUE_COLUMNS = {
    "2MASS": {"_2MASS": "source_id", "RAJ2000": "ra", "DEJ2000": "dec", "Jmag": "jmag", "e_Jmag": "jmag_err", "Hmag": "hmag", "e_Hmag": "hmag_err", "Kmag": "kmag", "e_Kmag": "kmag_err"},
    "VPHAS+": {"sourceID": "source_id", "RAJ2000": "ra", "DEJ2000": "dec", "gmag": "gmag", "e_gmag": "gmag_err", "rmag": "rmag", "e_rmag": "rmag_err", "imag": "imag", "e_imag": "imag_err", "clean": "clean"},
    "Gaia-DR2": {"Source": "source_id", "RA_ICRS": "ra", "e_RA_ICRS": "ra_err", "DE_ICRS": "dec", "e_DE_ICRS": "dec_err", "FG": "g_flux", "e_FG": "g_flux_err", "FBP": "bp_flux", "e_FBP": "bp_flux_err", "FRP": "rp_flux", "e_FRP": "rp_flux_err"},
    "Gaia-EDR3": {"source_id": "source_id", "ra": "ra", "ra_error": "ra_err", "dec": "dec", "dec_error": "dec_err", "phot_g_mean_flux": "g_flux", "phot_g_mean_flux_error": "g_flux_err", "phot_bp_mean_flux": "bp_flux", "phot_bp_mean_flux_error": "bp_flux_err",
                  "phot_rp_mean_flux": "rp_flux", "phot_rp_mean_flux_error": "rp_flux_err", "pm": "pm", "pmra": "pm_ra", "pmdec": "pm_dec", "parallax": "parallax", "parallax_error": "parallax_err"},
}
