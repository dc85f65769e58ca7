"""Registered queries: every operator run on whole tables, with the SQL that must give the same rows."""

from skyloom.plans import (  # noqa: F401  (registration happens on import)
    bookkeeping,
    calibration,
    expressions,
    matching,
    ordered,
    pixels,
    quality,
    scans,
    statistics,
    streams,
)
