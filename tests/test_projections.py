"""Projections against a published point and against integrals over the ellipsoid."""

import cmath
import math

import numpy as np
import pytest

from seatracks.functions import geo

A, FLAT = 6378137.0, 1 / 298.257223563
E2 = FLAT * (2 - FLAT)
KNOTS, WEIGHTS = np.polynomial.legendre.leggauss(40)


def integral(f, end):
    """Of f from 0 to a complex end, along a straight line."""
    return sum(w * f(end * (x + 1) / 2) for x, w in zip(KNOTS, WEIGHTS, strict=True)) * end / 2


def isometric(phi):
    return integral(lambda t: (1 - E2) / ((1 - E2 * cmath.sin(t) ** 2) * cmath.cos(t)), phi)


def meridian(phi):
    return integral(lambda t: A * (1 - E2) / (1 - E2 * cmath.sin(t) ** 2) ** 1.5, phi)


def transverse(lon, lat, zone):
    """x and y of a UTM zone: the meridian's arc at the complex latitude whose isometric latitude is that of the point plus
    i times its longitude from the middle of the zone."""
    phi = complex(math.radians(lat))
    aim = isometric(phi) + 1j * math.radians(lon - (6 * zone - 183))
    for _ in range(30):  # Newton's steps
        phi -= (isometric(phi) - aim) * (1 - E2 * cmath.sin(phi) ** 2) * cmath.cos(phi) / (1 - E2)
    z = 0.9996 * meridian(phi)
    return 500000 + z.imag, z.real


def project(spark, points, epsg):
    df = spark.createDataFrame(points, "lon double, lat double").coalesce(1)
    return [tuple(r) for r in df.select(*geo.project_point("lon", "lat", epsg)).collect()]


def test_web_mercator_published_point(spark):
    # the example of EPSG's guidance note 7-2: 24 22' 54.433" N, 100 20' 00.000" W
    ((x, y),) = project(spark, [(-(100 + 20 / 60), 24 + 22 / 60 + 54.433 / 3600)], 3857)
    assert abs(x + 11169055.58) < 0.01 and abs(y - 2800000.00) < 0.01


def test_world_mercator(spark):
    points = [(-63.57, 44.65), (0.0, 0.0), (179.9, -71.2), (-120.5, 83.0)]
    for (lon, lat), (x, y) in zip(points, project(spark, points, 3395), strict=True):
        assert abs(x - A * math.radians(lon)) < 1e-3 and abs(y - A * isometric(complex(math.radians(lat))).real) < 1e-3


@pytest.mark.parametrize("zone", [1, 20, 33, 60])
def test_transverse_mercator_to_a_millimetre(spark, zone):
    points = [(6 * zone - 183 + d, lat) for d in (-3.0, -1.25, 0.0, 0.5, 3.0) for lat in (0.0, 12.5, 44.65, 72.0, 83.5)]
    for (lon, lat), (x, y), (_, south) in zip(points, project(spark, points, 32600 + zone), project(spark, [(a, -b) for a, b in points], 32700 + zone), strict=True):
        want = transverse(lon, lat, zone)
        assert abs(x - want[0]) < 1e-3 and abs(y - want[1]) < 1e-3 and abs(1e7 - want[1] - south) < 1e-3


def test_planar_steps_use_the_projection(spark):
    df = spark.createDataFrame([(-63.0, 44.0, -62.9, 44.1)], "a double, b double, c double, d double")
    (x1, y1), (x2, y2) = (transverse(*p, 20) for p in ((-63.0, 44.0), (-62.9, 44.1)))
    assert abs(df.select(geo.step_m("a", "b", "c", "d", 32620)).first()[0] - math.hypot(x2 - x1, y2 - y1)) < 2e-3
