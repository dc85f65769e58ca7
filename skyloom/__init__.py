"""Time-series photometry on Spark: match, measure, calibrate and normalize star light curves."""

__version__ = "0.1.0"
