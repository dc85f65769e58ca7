"""Dates as Julian days."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from skyloom.functions.common import as_column, num, polynomial

UNIX_EPOCH_JD = 2440587.5


def micros_since_epoch(ts) -> Column:
    """Microseconds of a clock time without zone since 1970, from its parts, so that no zone is applied."""
    ts = as_column(ts).cast("timestamp_ntz")
    day = F.unix_date(ts.cast("date")).cast("bigint")
    second = (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("bigint")
    return (day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60) * 1000000 + second


def seconds_since_epoch(ts) -> Column:
    """Seconds of a timestamp without time zone (UTC) since 1970."""
    return micros_since_epoch(ts) / num(1e6)


def as_instant(ts) -> Column:
    """Timestamp without zone, taken as UTC, as an instant; does not depend on the session zone."""
    return F.timestamp_micros(micros_since_epoch(ts))


def as_utc_clock(ts) -> Column:
    """Instant as the UTC clock time, without zone."""
    seconds = (F.unix_micros(as_column(ts)).cast("decimal(20,0)") / 1000000).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def julian_date(ts) -> Column:
    return seconds_since_epoch(ts) / num(86400.0) + num(UNIX_EPOCH_JD)


# fixed values: the Sun's mean longitude, mean anomaly and eccentricity, equation of the centre and the largest terms of
# Venus, Jupiter and the Moon; degrees and astronomical units, time in centuries since 1900 January 0.5 (Newcomb's theory)
MEAN_LONGITUDE = (279.69668, 36000.76892, 0.0003025)
MEAN_ANOMALY = (358.47583, 35999.04975, -0.00015)
ECCENTRICITY = (0.01675104, -0.0000418, -0.000000126)
CENTRE = ((1.91946, -0.004789), (0.020094, -0.0001), (0.000293, 0.0))
# phase, phase per century, cosine and sine of the longitude, cosine and sine of the distance
PERTURBATIONS = (
    (153.23, 22518.7541, 0.00134, 0.0, 0.0, 0.00000543),
    (216.57, 45037.5082, 0.00154, 0.0, 0.0, 0.00001575),
    (312.69, 32964.3577, 0.0020, 0.0, 0.0, 0.00001627),
    (350.74, 445267.1142, 0.0, 0.00179, 0.00003076, 0.0),
    (353.40, 65928.7155, 0.0, 0.0, 0.0, 0.00000927),
    (231.19, 20.20, 0.0, 0.00178, 0.0, 0.0),
)
PRECESSION = (1.396971, 0.0003086)  # of the longitude since 2000, degrees for a century and its square
TILT_2000 = 23.4392911
AU_SECONDS, LIGHT_KM_S, DAY_SECONDS = 499.004784, 299792.458, 86400.0
# fixed values: geodetic longitude east, latitude and height in metres of observatories
SITES = {"lsc": (-70.8048, -30.1674, 2201.0), "cpt": (20.8101, -32.3806, 1760.0), "coj": (149.0612, -31.2733, 1116.0)}


def site_vector(longitude: float, latitude: float, height_m: float) -> tuple[float, float, float]:
    """Longitude in degrees, and distance from the axis and height above the equator plane in km (WGS 84)."""
    phi, flattening, equator = math.radians(latitude), 1 / 298.257223563, 6378.137
    c = 1 / math.sqrt(math.cos(phi) ** 2 + (1 - flattening) ** 2 * math.sin(phi) ** 2)
    h = height_m / 1000.0
    return longitude, (equator * c + h) * math.cos(phi), (equator * c * (1 - flattening) ** 2 + h) * math.sin(phi)


def sun_place(jd) -> tuple[Column, Column]:
    """Longitude of the Sun (degrees, mean equinox of the date, no aberration) and its distance; good to some arc seconds."""
    t = (as_column(jd) - num(2415020.0)) / num(36525.0)
    m = F.radians(polynomial(t, list(MEAN_ANOMALY)))
    lon = polynomial(t, list(MEAN_LONGITUDE))
    turn = num(0.0)
    for n, terms in enumerate(CENTRE, 1):
        turn = turn + polynomial(t, list(terms)) * F.sin(num(float(n)) * m)
    e = polynomial(t, list(ECCENTRICITY))
    dist = num(1.0000002) * (num(1.0) - e * e) / (num(1.0) + e * F.cos(m + F.radians(turn)))
    lon = lon + turn
    for phase, rate, lon_cos, lon_sin, dist_cos, dist_sin in PERTURBATIONS:
        a = F.radians(num(phase) + num(rate) * t)
        lon = lon + num(lon_cos) * F.cos(a) + num(lon_sin) * F.sin(a)
        dist = dist + num(dist_cos) * F.cos(a) + num(dist_sin) * F.sin(a)
    return lon, dist


def light_seconds(jd, ra, dec, site: tuple | None = None) -> Column:
    """How many seconds earlier a signal from an ICRS direction reaches the observer than the Sun (negative: later).

    The Sun's place is a truncated series, turned back to the equinox of 2000. ``site`` is the observatory: longitude,
    distance from the axis and height of the equator plane as in :func:`site_vector`, numbers or columns; without it
    the observer is at the Earth's centre. The error is some hundredths of a second.
    """
    jd = as_column(jd)
    lon, dist = sun_place(jd)
    since = (jd - num(2451545.0)) / num(36525.0)
    lon = F.radians(lon - num(PRECESSION[0]) * since - num(PRECESSION[1]) * since * since)
    tilt = math.radians(TILT_2000)
    x, y, z = F.cos(lon), num(math.cos(tilt)) * F.sin(lon), num(math.sin(tilt)) * F.sin(lon)
    a, d = F.radians(as_column(ra)), F.radians(as_column(dec))
    nx, ny, nz = F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)
    seconds = -dist * (x * nx + y * ny + z * nz) * num(AU_SECONDS)
    if site is None:
        return seconds
    east, axis, height = (as_column(v) for v in site)
    sidereal = F.radians(num(280.46061837) + num(360.98564736629) * (jd - num(2451545.0)) + east)
    return seconds + (axis * (F.cos(sidereal) * nx + F.sin(sidereal) * ny) + height * nz) / num(LIGHT_KM_S)


def heliocentric_jd(ts, exposure_s, ra, dec, site: tuple | None = None) -> Column:
    """Heliocentric Julian date of mid-exposure, in the time scale of ``ts``; see :func:`light_seconds`."""
    jd = julian_date(ts) + as_column(exposure_s) / num(2.0 * DAY_SECONDS)
    return jd + light_seconds(jd, ra, dec, site) / num(DAY_SECONDS)
