"""Positions on the sky and in the image plane."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions.common import as_column, num


def separation_deg(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance in degrees; the haversine form stays exact for small angles."""
    ra1, dec1, ra2, dec2 = (as_column(c) for c in (ra1, dec1, ra2, dec2))
    half_dec = F.sin(F.radians(dec2 - dec1) / 2)
    half_ra = F.sin(F.radians(ra2 - ra1) / 2)
    h = half_dec * half_dec + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * half_ra * half_ra
    return F.degrees(2 * F.asin(F.least(num(1.0), F.sqrt(h))))


def separation_arccos_deg(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance by the cosine rule."""
    ra1, dec1, ra2, dec2 = (F.radians(as_column(c)) for c in (ra1, dec1, ra2, dec2))
    c = F.sin(dec1) * F.sin(dec2) + F.cos(dec1) * F.cos(dec2) * F.cos(ra1 - ra2)
    return F.degrees(F.acos(F.greatest(num(-1.0), F.least(num(1.0), c))))


def residual_spherical_arcsec(ra1, dec1, ra2, dec2) -> Column:
    """Small-angle distance with the RA term scaled by cos(dec), the angle taken in radians."""
    ra1, dec1, ra2, dec2 = (as_column(c) for c in (ra1, dec1, ra2, dec2))
    dra = (ra1 - ra2) * F.cos(F.radians(dec1))
    ddec = dec1 - dec2
    return F.sqrt(dra * dra + ddec * ddec) * 3600.0


def residual_flat_arcsec(ra1, dec1, ra2, dec2) -> Column:
    """Flat distance without the cos(dec) factor."""
    ra1, dec1, ra2, dec2 = (as_column(c) for c in (ra1, dec1, ra2, dec2))
    return F.sqrt((ra1 - ra2) * (ra1 - ra2) + (dec1 - dec2) * (dec1 - dec2)) * 3600.0


def zone_of(dec, height: float) -> Column:
    return F.floor((as_column(dec) + 90.0) / num(height))


def ra_cells_in_zone(zone: Column, height: float) -> Column:
    """Number of RA cells in a declination zone.

    A cell is at least as wide as the RA difference of any two points ``height`` apart that
    touch the zone, so a match is never more than one cell away; near a pole one cell is left.
    """
    low = zone * num(height) - 90.0
    reach = F.least(num(90.0), F.greatest(F.abs(low), F.abs(low + height)) + height)
    ratio = num(math.sin(math.radians(height) / 2)) / F.greatest(F.cos(F.radians(reach)), num(1e-12))
    widest = F.degrees(2 * F.asin(F.least(num(1.0), ratio))) * 1.000001
    return F.greatest(num(1.0), F.floor(num(360.0) / widest)).cast("bigint")


def ra_cell(ra, cells: Column) -> Column:
    return F.pmod(F.floor(as_column(ra) / (num(360.0) / cells)), cells)


@dataclass(frozen=True)
class Cover:
    """Declination range and right-ascension parts (low, high within 0 to 360) that hold a region of the sky.

    The comparisons are plain ones with literals, so they reach the scan as pushed filters; with
    the height of the zones that a stored catalogue is partitioned by, the zones come first and
    only their folders are listed.
    """

    dec_min: float
    dec_max: float
    parts: tuple[tuple[float, float], ...]

    def zones(self, height: float) -> tuple[int, int]:
        return int((self.dec_min + 90.0) // height), int((self.dec_max + 90.0) // height)

    def of(self, df: DataFrame, zone_height: float | None = None, zone: str = "zone") -> DataFrame:
        if zone_height is not None:
            df = df.where(F.col(zone).between(*self.zones(zone_height)))
        df = df.where(F.col("dec").between(self.dec_min, self.dec_max))
        if self.parts == ((0.0, 360.0),):
            return df
        inside = F.lit(False)
        for low, high in self.parts:
            inside = inside | F.col("ra").between(low, high)
        return df.where(inside)


def ra_parts(low: float, high: float) -> tuple[tuple[float, float], ...]:
    """The way from ``low`` up to ``high`` in degrees, cut at 0 = 360; ``high`` below ``low`` goes through 0."""
    if high - low >= 360.0:
        return ((0.0, 360.0),)
    low, high = low % 360.0, (high % 360.0 if high != 360.0 else 360.0)
    if low <= high:
        # 0 and 360 are the same place
        return ((low, high),) + (((0.0, 0.0),) if high == 360.0 else ()) + (((360.0, 360.0),) if low == 0.0 else ())
    return (low, 360.0), (0.0, high)


def box_cover(ra_min: float, ra_max: float, dec_min: float, dec_max: float) -> Cover:
    """A box; ``ra_min`` above ``ra_max``, or an end outside 0 to 360, means a box across RA 0."""
    return Cover(max(dec_min, -90.0), min(dec_max, 90.0), ra_parts(ra_min, ra_max))


def cone_cover(ra0: float, dec0: float, radius: float) -> Cover:
    """A circle: its RA range widens with declination and is the whole turn where it holds a pole; a rounding step wider than exact."""
    slack = 1e-9
    low, high = dec0 - radius - slack, dec0 + radius + slack
    if low <= -90.0 or high >= 90.0:
        return Cover(max(low, -90.0), min(high, 90.0), ((0.0, 360.0),))
    half = math.degrees(math.asin(min(1.0, math.sin(math.radians(min(radius, 90.0))) / math.cos(math.radians(dec0))))) * (1 + slack) + slack
    return Cover(low, high, ra_parts(ra0 - half, ra0 + half))


def sexagesimal_to_deg(text, hours: bool = False) -> Column:
    """``hh:mm:ss`` or ``dd:mm:ss`` to degrees; the sign is read from the text so that -00 keeps it, other text gives null."""
    text = F.trim(as_column(text))
    parts = F.split(F.regexp_replace(text, "^[+-]", ""), ":")
    size = (
        F.get(parts, F.lit(0)).try_cast("double") + F.get(parts, F.lit(1)).try_cast("double") / 60.0 + F.get(parts, F.lit(2)).try_cast("double") / 3600.0
    ) * (15.0 if hours else 1.0)
    return F.when(text.startswith("-"), -size).otherwise(size)


def galactic_longitude_latitude(ra, dec) -> tuple[Column, Column]:
    """Galactic l and b in degrees from ICRS positions."""
    # fixed values: IAU galactic pole (J2000) and longitude of the north celestial pole, degrees
    pole_ra, pole_dec, pole_lon = 192.85948, 27.12825, 122.93192
    ra, dec = F.radians(as_column(ra)), F.radians(as_column(dec))
    sd, cd = math.sin(math.radians(pole_dec)), math.cos(math.radians(pole_dec))
    dra = ra - num(math.radians(pole_ra))
    sin_b = F.sin(dec) * sd + F.cos(dec) * cd * F.cos(dra)
    y = F.cos(dec) * F.sin(dra)
    x = F.sin(dec) * cd - F.cos(dec) * sd * F.cos(dra)
    lon = F.pmod(num(pole_lon) - F.degrees(F.atan2(y, x)), num(360.0))
    return lon, F.degrees(F.asin(sin_b))
