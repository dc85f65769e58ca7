"""Codes of datasets, facilities and filters, and numbers as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyloom.functions.common import as_column

# fixed values: filter codes of the instrument → survey filter
SLOAN = {"gp": "g", "rp": "r", "ip": "i"}


def dataset_parts(code) -> dict[str, Column]:
    """Parts of ``FIELD_site-enclosure-telescope-n-instrument_filter``; null for what a malformed code lacks."""
    pieces = F.split(as_column(code), "_")
    place = F.split(F.get(pieces, F.lit(1)), "-")
    return {
        "field": F.get(pieces, F.lit(0)),
        "site": F.get(place, F.lit(0)),
        "enclosure": F.get(place, F.lit(1)),
        "telescope": F.get(place, F.lit(2)),
        "instrument": F.try_element_at(place, F.lit(-1)),
        "filter": F.try_element_at(pieces, F.lit(-1)),
    }


def short_code(code) -> Column:
    """``site-enclosure_filter``."""
    p = dataset_parts(code)
    return F.concat_ws("_", F.concat_ws("-", p["site"], p["enclosure"]), p["filter"])


def sloan_filter(code) -> Column:
    code = as_column(code)
    out = code
    for name, letter in SLOAN.items():
        out = F.when(code == name, letter).otherwise(out)
    return out


def is_primary_enclosure(code) -> Column:
    return F.lower(as_column(code)).contains("doma")


def facility_code(site, enclosure, telescope, instrument) -> Column:
    return F.concat_ws("-", *[as_column(c) for c in (site, enclosure, telescope, instrument)])


def instrument_class(instrument) -> Column:
    """Camera class from the instrument prefix."""
    i = F.lower(as_column(instrument))
    return F.when(i.startswith("fa") | i.startswith("fl"), "sinistro").otherwise(i)


def fixed_decimals(x, digits: int) -> Column:
    """Number with a fixed count of decimals, ``None`` for null."""
    x = as_column(x)
    return F.when(x.isNull(), "None").otherwise(F.format_string(f"%.{digits}f", x))


def value_and_error(value, err) -> Column:
    """``value +/- error``, both rounded to the digit that the error-to-value ratio supports."""
    value, err = as_column(value), as_column(err)
    digits = F.abs(F.log10(F.try_divide(err, F.abs(value))).cast("int"))

    def shown(x: Column) -> Column:
        scale = F.pow(F.lit(10.0), digits)
        return (F.round(x * scale) / scale).cast("string")

    both_zero = (value == 0) & (err == 0)
    return F.when(both_zero, "0.0 +/- 0.0").when((value == 0) | (err <= 0), F.lit(None)).otherwise(
        F.concat_ws(" +/- ", shown(value), shown(err))
    )
