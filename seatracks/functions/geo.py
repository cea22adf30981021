"""Distances, bearings, speeds, projections and geometry text, as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The sphere's radius in km, metres of a nautical mile, WGS84's half axis and flattening.
RADIUS_KM, MILE_M = 6367.0, 1852.0
WGS_A, WGS_F = 6378137.0, 1 / 298.257223563


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def haversine_km(lon1, lat1, lon2, lat2) -> Column:
    lon1, lat1, lon2, lat2 = (F.radians(_c(x)) for x in (lon1, lat1, lon2, lat2))
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return F.lit(2 * RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    return haversine_km(lon1, lat1, lon2, lat2) * 1000


def initial_bearing(lon1, lat1, lon2, lat2) -> Column:
    """Degrees from north, from 0 up to 360."""
    lon1, lat1, lon2, lat2 = (F.radians(_c(x)) for x in (lon1, lat1, lon2, lat2))
    y = F.sin(lon2 - lon1) * F.cos(lat2)
    x = F.cos(lat1) * F.sin(lat2) - F.sin(lat1) * F.cos(lat2) * F.cos(lon2 - lon1)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0))


def elapsed_s(t1, t2) -> Column:
    return (F.unix_micros(_c(t2)) - F.unix_micros(_c(t1))) / F.lit(1e6)


def speed_kts(metres, seconds) -> Column:
    """Null where no time has passed."""
    return F.try_divide(_c(metres) / MILE_M, _c(seconds) / 3600)


def km_per_s(km, seconds) -> Column:
    return F.try_divide(_c(km), _c(seconds))


def euclid(x1, y1, x2, y2) -> Column:
    return F.sqrt(F.pow(_c(x2) - _c(x1), 2) + F.pow(_c(y2) - _c(y1), 2))


def point_wkt(x, y) -> Column:
    return F.format_string("POINT (%.6f %.6f)", _c(x), _c(y))


def line_wkt(vertices) -> Column:
    """From an array of structs x, y."""
    text = F.transform(_c(vertices), lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string")))
    return F.concat(F.lit("LINESTRING ("), F.array_join(text, ", "), F.lit(")"))


def segment_wkt(x1, y1, x2, y2) -> Column:
    return line_wkt(F.array(F.struct(_c(x1).alias("x"), _c(y1).alias("y")), F.struct(_c(x2).alias("x"), _c(y2).alias("y"))))


def wkt_to_vertices(wkt) -> Column:
    """The vertices of a LINESTRING text."""
    inner = F.regexp_extract(_c(wkt), r"\(([^()]*)\)", 1)
    pair = lambda t: F.split(F.trim(t), r"\s+")
    return F.transform(F.split(inner, ","), lambda t: F.struct(pair(t)[0].cast("double").alias("x"), pair(t)[1].cast("double").alias("y")))


def project_point(lon, lat, epsg: int) -> tuple[Column, Column]:
    """x and y of WGS84 degrees: 4326 itself, 3857, 3395, and UTM zones 326zz and 327zz (Krueger's series, to a
    millimetre inside a zone). Other codes raise."""
    lon, lat = _c(lon), _c(lat)
    if epsg == 4326:
        return lon, lat
    lam, phi = F.radians(lon), F.radians(lat)
    e = math.sqrt(WGS_F * (2 - WGS_F))
    if epsg == 3857:
        return WGS_A * lam, WGS_A * F.log(F.tan(F.lit(math.pi / 4) + phi / 2))
    if epsg == 3395:
        s = e * F.sin(phi)
        return WGS_A * lam, WGS_A * F.log(F.tan(F.lit(math.pi / 4) + phi / 2) * F.pow((1 - s) / (1 + s), e / 2))
    zone = epsg % 100
    if epsg // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"EPSG {epsg} is not among 4326, 3857, 3395, 326zz and 327zz")
    n = WGS_F / (2 - WGS_F)
    big = WGS_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    k = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - k * F.atanh(k * s))
    away = lam - math.radians(6 * zone - 183)
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(alpha, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000 + 0.9996 * big * x, (0 if epsg // 100 == 326 else 1e7) + 0.9996 * big * y


def step_m(lon1, lat1, lon2, lat2, epsg: int = 4326) -> Column:
    """Length of a line between two points: on the sphere for 4326, else in the projected plane."""
    if epsg == 4326:
        return haversine_m(lon1, lat1, lon2, lat2)
    return euclid(*project_point(lon1, lat1, epsg), *project_point(lon2, lat2, epsg))
