"""Overlays on polygons of any shape against plain geometry."""

import math
import random

import pytest
from pyspark.sql import functions as F

from seatracks.operators import grid as G

POLYGON = "cell_id long, rings array<array<struct<x:double,y:double>>>"
SEGMENT = "id long, x1 double, y1 double, x2 double, y2 double"


def star(rng, cx, cy, low, high, n):
    return [(cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n)) for i in range(n) for r in [rng.uniform(low, high)]]


def rows(polygons):
    return [(i, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for i, rings in polygons.items()]


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                odd = not odd
    return odd


def length(rings, seg, n=4000):
    """By sampling many midpoints."""
    x1, y1, x2, y2 = seg
    hits = sum(inside(rings, x1 + (x2 - x1) * (i + 0.5) / n, y1 + (y2 - y1) * (i + 0.5) / n) for i in range(n))
    return math.dist((x1, y1), (x2, y2)) * hits / n


@pytest.mark.parametrize("tile", [0.7, 3.0])
def test_star_polygons_with_holes(spark, tile):
    rng = random.Random(5)
    polygons = {}
    for i in range(12):
        cx, cy = rng.uniform(-5, 5), rng.uniform(-5, 5)
        hole = star(rng, cx, cy, 0.1, 0.45, 7)
        polygons[i] = [star(rng, cx, cy, 0.5, 2.5, 17), hole[::-1] if i % 2 else hole] + ([star(rng, cx + 6, cy, 0.3, 1, 9)] if i % 3 == 0 else [])
    segments = [(k, *(rng.uniform(-8, 8) for _ in range(4))) for k in range(60)]
    layer = G.Polygons(spark.createDataFrame(rows(polygons), POLYGON), tile)
    got = {(r.id, r.grid_id): r.len for r in G.grid_interpolate(spark.createDataFrame(segments, SEGMENT), layer, "x1", "x2").groupBy("id", "grid_id").agg(F.sum("grd_len_km").alias("len")).collect()}
    for k, *seg in segments:
        for i, rings in polygons.items():
            assert abs(got.get((k, i), 0) * 1000 - length(rings, seg)) < math.dist(seg[:2], seg[2:]) * 0.006, (k, i)


def test_parts_in_order_and_apart(spark):
    comb = [(0, 0), (10, 0), (10, 5), (8, 5), (8, 1), (6, 1), (6, 5), (4, 5), (4, 1), (2, 1), (2, 5), (0, 5)]
    layer = G.Polygons(spark.createDataFrame(rows({1: [comb]}), POLYGON), 2.0)
    lines = spark.createDataFrame([(7, "a", [(-1.0, 3.0), (11.0, 3.0), (11.0, 0.5), (-1.0, 0.5)])], "id long, name string, vertices array<struct<x:double,y:double>>")
    row = G.grid_intersect(lines, layer, ["id"]).first()
    assert [(p.e, round(p.xa, 9), round(p.xb, 9)) for p in row.parts] == [(0, 0, 2), (0, 4, 6), (0, 8, 10), (2, 10, 0)] and row.name == "a"
    assert round(G.grid_length(lines, layer, ["id"]).first().grd_len_km * 1000, 9) == 16


def test_borders(spark):
    square = lambda x, y: [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]
    polygons = {i * 3 + j: [square(i, j)] for i in range(3) for j in range(3)}
    data = [(1, 0.25, 1.0, 2.75, 1.0), (2, 0.0, 0.0, 3.0, 3.0), (3, 1.0, 0.0, 1.0, 3.0), (4, 0.5, 0.5, 1.0, 0.5), (5, 1.5, 1.5, 1.5, 1.5), (6, -1.0, 1.0, 0.0, 0.0)]
    cells, segments = spark.createDataFrame(rows(polygons), POLYGON), spark.createDataFrame(data, SEGMENT)
    as_lines = segments.withColumn("vertices", F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))))
    on = lambda layer: {(r.id, r.grid_id): round(r.grd_len_km * 1000, 9) for r in G.grid_length(as_lines, layer, ["id"]).collect()}
    assert on(G.Polygons(cells, 0.8)) == on(G.Grid(0, 0, 1, 3, 3))
    one = on(G.Polygons(cells, 0.8, borders="one"))
    for k, *seg in data[:5]:
        assert abs(sum(v for (i, _), v in one.items() if i == k) - math.dist(seg[:2], seg[2:])) < 1e-8, k
    with pytest.raises(ValueError, match="borders"):
        G.grid_length(as_lines, G.Polygons(cells, 1, borders="none"), ["id"])


def test_lengths_over_a_partition_add_up(spark):
    """Triangles around random points, all of a square: what a line has in it is what it has in them."""
    rng = random.Random(9)
    polygons, k = {}, 0
    for i in range(4):
        for j in range(4):
            corners, mid = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)], (i + rng.uniform(0.2, 0.8), j + rng.uniform(0.2, 0.8))
            for a, b in zip(corners, corners[1:] + corners[:1], strict=True):
                polygons[k], k = [[a, b, mid]], k + 1
    segments = [(n, *(rng.choice([rng.uniform(0, 4), rng.randrange(5)]) for _ in range(4))) for n in range(80)]
    layer = G.Polygons(spark.createDataFrame(rows(polygons), POLYGON), 1.0, borders="one")
    got = {r.id: r.len for r in G.grid_interpolate(spark.createDataFrame([(n, *map(float, s)) for n, *s in segments], SEGMENT), layer, "x1", "x2").groupBy("id").agg((F.sum("grd_len_km") * 1000).alias("len")).collect()}
    for n, *s in segments:
        if not (s[0] == s[2] and s[0] in (0, 4) or s[1] == s[3] and s[1] in (0, 4)):  # of the outer border half belongs to none
            assert abs(got.get(n, 0) - math.dist(s[:2], s[2:])) < 1e-9, s


def test_hot_tiles_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(G, "HOT_TILE", 3)
    rng = random.Random(2)
    segments = spark.createDataFrame([(k, rng.random(), rng.random(), rng.random(), rng.random()) for k in range(2500)] + [(9999, 5.1, 5.1, 5.2, 5.2)], SEGMENT)
    cells = spark.createDataFrame(rows({0: [[(0, 0), (1, 0), (1, 1), (0, 1)]], 1: [[(5, 5), (6, 5), (6, 6)]]}), POLYGON)
    assert G.grid_interpolate(segments, G.Polygons(cells, 1.0), "x1", "x2").count() == 2501


def test_empty(spark):
    cells, segments = spark.createDataFrame([], POLYGON), spark.createDataFrame([], SEGMENT)
    assert G.grid_interpolate(segments, G.Polygons(cells, 1.0), "x1", "x2").count() == 0


def test_pairs_are_cut_in_batches(spark):
    """The cut of a pair is numpy over a batch, not an expression over each pair's arrays; an empty batch is one too."""
    import numpy as np
    import pyarrow as pa

    square = [dict(zip("xyuv", v, strict=True)) for v in ((0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0), (1.0, 1.0, 0.0, 1.0), (0.0, 1.0, 0.0, 0.0))]
    kind = pa.list_(pa.struct([(c, pa.float64()) for c in "xyuv"]))
    edges = np.array([(-1, 0.5, 3, 0.5), (0.5, 0.5, 0.5, 0.5), (5, 5, 5, 5), (0, 0, 2, 0), (-1, 1, 1, 3), (-1, 0, 1, 2)], float)
    got = G._cut(*edges.T, pa.array([square] * len(edges), kind), True).to_pylist()
    want = [[(0.25, 0.5)], [(0.0, 0.0)], [], [(0.0, 0.5)], [], [(0.5, 0.5)]]
    assert [[(p["a"], p["b"]) for p in parts] for parts in got] == want
    assert G._cut(*np.zeros((4, 0)), pa.array([], kind), False).to_pylist() == []
