"""OP-128: projected conic coordinates to longitude and latitude."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class ConicZone:
    """Secant Lambert conformal conic on an ellipsoid (degrees and metres)."""

    origin_lat: float
    origin_lon: float
    parallel_1: float
    parallel_2: float
    false_easting: float
    false_northing: float
    semi_major: float = 6378137.0
    inverse_flattening: float = 298.257222101


def conic_zone_cc(central_latitude: int) -> ConicZone:
    """The nine-zone conformal conic family: parallels 0.75 degree either side of the
    central latitude, false northing growing by a million per zone."""
    return ConicZone(
        origin_lat=float(central_latitude),
        origin_lon=3.0,
        parallel_1=central_latitude - 0.75,
        parallel_2=central_latitude + 0.75,
        false_easting=1_700_000.0,
        false_northing=(central_latitude - 41) * 1_000_000.0 + 200_000.0,
    )


def _parameters(zone: ConicZone):
    f = 1 / zone.inverse_flattening
    e = math.sqrt(2 * f - f * f)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi):
        s = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    p1, p2, p0 = (math.radians(v) for v in (zone.parallel_1, zone.parallel_2, zone.origin_lat))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    rho0 = zone.semi_major * big_f * t(p0) ** n
    return e, n, big_f, rho0


def to_lonlat(x: Column, y: Column, zone: ConicZone) -> tuple[Column, Column]:
    """Longitude and latitude in degrees, as pure column arithmetic.

    Latitude uses the closed series from conformal latitude (fourth order in e²),
    good to well below a millimetre.
    """
    e, n, big_f, rho0 = _parameters(zone)
    dx = x - zone.false_easting
    dy = F.lit(rho0) - (y - zone.false_northing)
    rho = F.sqrt(dx * dx + dy * dy)
    theta = F.atan2(dx, dy)
    t = F.pow(rho / (zone.semi_major * big_f), F.lit(1 / n))
    chi = F.lit(math.pi / 2) - 2 * F.atan(t)
    e2, e4, e6, e8 = e**2, e**4, e**6, e**8
    a2 = e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360
    a4 = 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520
    a6 = 7 * e6 / 120 + 81 * e8 / 1120
    a8 = 4279 * e8 / 161280
    lat = chi + a2 * F.sin(2 * chi) + a4 * F.sin(4 * chi) + a6 * F.sin(6 * chi) + a8 * F.sin(8 * chi)
    lon = theta / n + math.radians(zone.origin_lon)
    return F.degrees(lon), F.degrees(lat)
