"""Regular grids and layers of any polygons, and the overlay of lines on them.

A grid is arithmetic, so no index and no join is needed to find a line's cells: each edge is cut into the grid's columns
and, inside each, into its rows, so a long edge makes as many rows as it has cells. Cells that only touch an edge count.
Polygons meet edges by square tiles; a pair is cut by the crossings of the edge's line with all sides, in order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..functions import geo
from ..shared import shared_dir, written


@dataclass(frozen=True)
class Grid:
    xmin: float
    ymin: float
    size: float
    nx: int
    ny: int
    epsg: int = 4326

    def cells(self, spark: SparkSession) -> DataFrame:
        """cell_id (columns first), ix, iy and the borders of each cell."""
        ids = spark.range(self.nx * self.ny).withColumnRenamed("id", "cell_id")
        ids = ids.withColumn("ix", F.floor(F.col("cell_id") / F.lit(self.ny)).cast("int")).withColumn("iy", (F.col("cell_id") % F.lit(self.ny)).cast("int"))
        edge = lambda low, i: F.lit(low) + i * F.lit(float(self.size))
        return ids.select("cell_id", "ix", "iy", edge(self.xmin, F.col("ix")).alias("xmin"), edge(self.ymin, F.col("iy")).alias("ymin"), edge(self.xmin, F.col("ix") + 1).alias("xmax"), edge(self.ymin, F.col("iy") + 1).alias("ymax"))


@dataclass(frozen=True)
class Polygons:
    """Polygons of any shape: ``rings`` is an array of rings, each an array of structs x, y; what lies in an odd number of
    rings is inside, so holes and parts are just rings, in either direction, closed or not.

    ``tile`` is the side of the squares by which polygons and edges are joined, best about the size of a polygon. With
    ``borders="both"`` a border belongs to all polygons it bounds, and points that only touch are kept, as with a grid;
    with ``"one"`` what lies on a border that two polygons share belongs to one of them, so that lengths over a partition
    of the plane add up.
    """

    df: DataFrame
    tile: float
    id: str = "cell_id"
    rings: str = "rings"
    epsg: int = 4326
    borders: str = "both"


def make_grid(spark: SparkSession, minlon: float, maxlon: float, minlat: float, maxlat: float, epsg: int, size: float) -> Grid:
    """The grid of whole cells that covers the projected corners, centred on their middle."""
    corners = spark.createDataFrame([(float(x), float(y)) for x in (minlon, maxlon) for y in (minlat, maxlat)], "lon double, lat double")
    x, y = geo.project_point("lon", "lat", epsg)
    b = corners.select(x.alias("x"), y.alias("y")).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    nx, ny = (math.ceil(abs(hi - lo) / size) for lo, hi in ((b.x0, b.x1), (b.y0, b.y1)))
    return Grid((b.x1 + b.x0) / 2 - nx * size / 2, (b.y1 + b.y0) / 2 - ny * size / 2, size, nx, ny, epsg)


def check_srs(lines_epsg: int, grid: Grid | Polygons, on_mismatch: str = "error") -> None:
    if lines_epsg != grid.epsg:
        if on_mismatch == "error":
            raise ValueError(f"lines are in EPSG {lines_epsg}, the grid in {grid.epsg}")
        import warnings

        warnings.warn(f"lines are in EPSG {lines_epsg}, the grid in {grid.epsg}", stacklevel=2)


def _span(lo: Column, hi: Column, start: float, size: float, n: int) -> Column:
    """Numbers of the strips that an interval meets or touches; none outside the grid."""
    first = F.greatest(F.lit(0), (F.ceil((lo - start) / size - 1e-9) - 1).cast("int"))
    last = F.least(F.lit(n - 1), F.floor((hi - start) / size + 1e-9).cast("int"))
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _between(p: Column, d: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """The part of 0..1 where p + t d lies between lo and hi; empty (1, 0) if none does."""
    a, b = (lo - p) / d, (hi - p) / d
    flat = F.when((p >= lo) & (p <= hi), F.lit(0.0)), F.when((p >= lo) & (p <= hi), F.lit(1.0))
    t0 = F.when(d == 0, F.coalesce(flat[0], F.lit(1.0))).otherwise(F.greatest(F.lit(0.0), F.least(a, b)))
    t1 = F.when(d == 0, F.coalesce(flat[1], F.lit(0.0))).otherwise(F.least(F.lit(1.0), F.greatest(a, b)))
    return t0, t1


def _clipped(edges: DataFrame, grid: Grid | Polygons) -> DataFrame:
    """A row for each edge (x1, y1, x2, y2 as ``_x1`` ...) and cell that it meets, with the part t0..t1 inside; in a polygon
    there may be several."""
    if isinstance(grid, Polygons):
        return _clipped_by_polygons(edges, grid)
    x1, y1, x2, y2 = (F.col(c) for c in ("_x1", "_y1", "_x2", "_y2"))
    s = float(grid.size)
    out = edges.withColumn("_ix", F.explode(_span(F.least(x1, x2), F.greatest(x1, x2), grid.xmin, s, grid.nx)))
    lo = F.lit(grid.xmin) + F.col("_ix") * s
    t0, t1 = _between(x1, x2 - x1, lo, lo + s)
    out = out.withColumn("_a", t0).withColumn("_b", t1).where("_a <= _b")
    ya, yb = y1 + (y2 - y1) * F.col("_a"), y1 + (y2 - y1) * F.col("_b")
    out = out.withColumn("_iy", F.explode(_span(F.least(ya, yb) - 1e-9 * s, F.greatest(ya, yb) + 1e-9 * s, grid.ymin, s, grid.ny)))
    lo = F.lit(grid.ymin) + F.col("_iy") * s
    u0, u1 = _between(y1, y2 - y1, lo, lo + s)
    out = out.withColumn("_t0", F.greatest("_a", u0)).withColumn("_t1", F.least("_b", u1)).where("_t0 <= _t1")
    return out.withColumn("grid_id", F.col("_ix").cast("long") * grid.ny + F.col("_iy"))


def _tiled(edges: DataFrame, tile: float) -> DataFrame:
    """The edges with each tile (_tx, _ty) they pass; ``_c`` is the tile's column with its first and last row, ``_c0`` the
    column before it, null for the first."""
    x1, y1, x2, y2 = (F.col(c) for c in ("_x1", "_y1", "_x2", "_y2"))

    def column(c: Column) -> Column:
        a, b = _between(x1, x2 - x1, c * tile, (c + 1) * tile)
        a, b = F.least(a, b), F.greatest(a, b)
        ya, yb = y1 + (y2 - y1) * a, y1 + (y2 - y1) * b
        low, high = F.greatest(F.least(ya, yb) - 1e-9 * tile, F.least(y1, y2)), F.least(F.greatest(ya, yb) + 1e-9 * tile, F.greatest(y1, y2))
        return F.struct(c.alias("c"), F.floor(low / tile).alias("r0"), F.floor(high / tile).alias("r1"))

    out = edges.withColumn("_cs", F.transform(F.sequence(F.floor(F.least(x1, x2) / tile), F.floor(F.greatest(x1, x2) / tile)), column))
    out = out.select("*", F.posexplode("_cs").alias("_i", "_c")).withColumn("_c0", F.get("_cs", F.col("_i") - 1)).drop("_cs", "_i")
    return out.withColumn("_tx", F.col("_c.c")).withColumn("_ty", F.explode(F.sequence("_c.r0", "_c.r1")))


#: Tiles with more than this share of all edges' tiles are dealt to several tasks, and the polygons there repeated.
HOT_TILE = 1 << 10


def _clipped_by_polygons(edges: DataFrame, layer: Polygons) -> DataFrame:
    """As ``_clipped``. A pair that meets in several tiles is kept in the first: columns from left to right, then rows."""
    tile = float(layer.tile)
    tiled = _tiled(edges, tile)
    counts = written(tiled.groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias("_n")), f"{shared_dir(edges.sparkSession)}/tiles")
    share = max((counts.agg(F.sum("_n")).first()[0] or 0) // HOT_TILE, 1000)
    # of such tiles there are at most HOT_TILE
    hot = F.broadcast(counts.where(F.col("_n") > share).select("_tx", "_ty", F.ceil(F.col("_n") / share).cast("int").alias("_copies")))
    flat = lambda k: F.flatten(F.transform(layer.rings, lambda r: F.transform(r, lambda v: v[k])))
    box = {"x0": F.array_min(flat("x")), "x1": F.array_max(flat("x")), "y0": F.array_min(flat("y")), "y1": F.array_max(flat("y"))}
    polygons = layer.df.select(F.col(layer.id).alias("grid_id"), _sides(layer.rings).alias("_p"), *[f(c).alias(f"{p}{n}") for n, c in box.items() for p, f in (("_b", lambda v: F.floor(v / tile)), ("_p", lambda v: v))])
    polygons = polygons.withColumn("_tx", F.explode(F.sequence("_bx0", "_bx1"))).withColumn("_ty", F.explode(F.sequence("_by0", "_by1")))
    polygons = polygons.join(hot, ["_tx", "_ty"], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))).drop("_copies")
    tiled = tiled.join(hot, ["_tx", "_ty"], "left").withColumn("_salt", F.pmod(F.xxhash64("_x1", "_y1", "_x2", "_y2"), F.coalesce("_copies", F.lit(1))).cast("int")).drop("_copies")
    low, high = (lambda k: F.least(f"_{k}1", f"_{k}2")), (lambda k: F.greatest(f"_{k}1", f"_{k}2"))
    met = tiled.join(polygons, ["_tx", "_ty", "_salt"]).where((low("x") <= F.col("_px1")) & (high("x") >= F.col("_px0")) & (low("y") <= F.col("_py1")) & (high("y") >= F.col("_py0")))
    earlier = (F.col("_c0.c") >= F.col("_bx0")) & (F.col("_c0.r0") <= F.col("_by1")) & (F.col("_c0.r1") >= F.col("_by0"))
    met = met.where((F.col("_ty") == F.greatest("_c.r0", "_by0")) & ~F.coalesce(earlier, F.lit(False)))
    met = met.withColumn("_t", F.explode(_inside("_p", layer.borders)))
    kept = [c for c in edges.columns if c != "grid_id"]
    return met.select(*kept, "grid_id", F.col("_t.a").alias("_t0"), F.col("_t.b").alias("_t1"))


def _sides(rings: str) -> Column:
    """All sides of all rings: x, y, and where to (u, v)."""
    def of(ring: Column) -> Column:
        return F.transform(ring, lambda v, i: F.struct(v["x"].alias("x"), v["y"].alias("y"), F.get(ring, (i + 1) % F.size(ring))["x"].alias("u"), F.get(ring, (i + 1) % F.size(ring))["y"].alias("v")))

    return F.flatten(F.transform(rings, of))


PARTS = ArrayType(StructType([StructField("a", DoubleType()), StructField("b", DoubleType())]))


def _inside(sides: str, borders: str) -> Column:
    """The parts a..b of an edge (0 to 1) inside, in order, apart from each other. An edge without length is a part (0, 0)
    where it lies inside."""
    if borders not in ("both", "one"):
        raise ValueError("borders is both or one")

    def cut(x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array, sides: pa.Array) -> pa.Array:
        return _cut(*(np.asarray(c, np.float64) for c in (x1, y1, x2, y2)), sides, borders == "both")

    return F.arrow_udf(cut, PARTS)("_x1", "_y1", "_x2", "_y2", sides)


def _cut(x: np.ndarray, y: np.ndarray, x2: np.ndarray, y2: np.ndarray, sides: pa.Array, both: bool) -> pa.Array:
    """``_inside`` for a batch of pairs: all their sides side by side."""
    n = len(x)
    pair = np.repeat(np.arange(n), np.asarray(pc.fill_null(pc.list_value_length(sides), 0)))
    flat = sides.flatten()
    px, py, qx, qy = (np.asarray(flat.field(k), np.float64) for k in ("x", "y", "u", "v"))
    point = (x2 == x) & (y2 == y)
    dx, dy, end = np.where(point, 1.0, x2 - x), y2 - y, np.where(point, 0.0, 1.0)
    ex, ey, ox, oy = dx[pair], dy[pair], x[pair], y[pair]
    off = lambda vx, vy: ex * (vy - oy) - ey * (vx - ox)  # noqa: E731  on which side of the edge's line
    on = lambda vx, vy: (ex * (vx - ox) + ey * (vy - oy)) / (ex * ex + ey * ey)  # noqa: E731  where along it
    a, b = off(px, py), off(qx, qy)
    # a corner that lies on the line counts to its left, so what only touches crosses twice or not at all
    crosses = (a < 0) != (b < 0)
    share = np.divide(a, a - b, out=np.zeros_like(a), where=crosses)
    at, of = on(px + (qx - px) * share, py + (qy - py) * share)[crosses], pair[crosses]
    order = np.lexsort((at, of))
    at, of = at[order], of[order]
    # crossings of a pair are even in number as rings are closed; each odd one begins a part
    starts, stops, owner = at[0::2], at[1::2], of[0::2]
    if both:
        first, second = a == 0, b == 0
        p, q = on(px, py)[first], on(qx, qy)[first]
        q = np.where(second[first], q, p)
        starts, stops, owner = np.concatenate((starts, np.minimum(p, q))), np.concatenate((stops, np.maximum(p, q))), np.concatenate((owner, pair[first]))
    starts, stops = np.maximum(starts, 0.0), np.minimum(stops, end[owner])
    kept = starts <= stops
    starts, stops, owner = starts[kept], stops[kept], owner[kept]
    order = np.lexsort((stops, starts, owner))
    starts, stops, owner = starts[order], stops[order], owner[order]
    furthest = _furthest(stops, owner)  # parts that meet become one
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (starts[1:] > furthest[:-1])
    begin = np.flatnonzero(fresh)
    last = np.append(begin[1:], len(starts)) - 1 if len(begin) else begin
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner[begin], minlength=n))))
    parts = pa.StructArray.from_arrays([pa.array(starts[begin]), pa.array(furthest[last])], ["a", "b"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts)


def _furthest(stops: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The greatest stop so far of each owner, which come in runs: by doubling steps within a run."""
    out, step = stops.copy(), 1
    while step < len(out) and (same := owner[step:] == owner[:-step]).any():
        out[step:] = np.where(same, np.maximum(out[step:], out[:-step]), out[step:])
        step *= 2
    return out


def _at(t: str) -> tuple[Column, Column]:
    return F.col("_x1") + (F.col("_x2") - F.col("_x1")) * F.col(t), F.col("_y1") + (F.col("_y2") - F.col("_y1")) * F.col(t)


def _segments(df: DataFrame, grid: Grid | Polygons) -> DataFrame:
    return _clipped(df.withColumns({f"_{c}": F.col(c) for c in ("x1", "y1", "x2", "y2")}), grid)


def _edges(lines: DataFrame, vertices: str) -> DataFrame:
    """A row for each edge of a line, with the line's columns as ``_line_`` and their names; what isn't used of them
    isn't carried along."""
    own = [f"_line_{c}" for c in lines.columns]
    out = lines.select(*[F.col(c).alias(n) for c, n in zip(lines.columns, own, strict=True)], F.col(vertices).alias("_v"))
    out = out.select(*own, "_v", F.explode(F.when(F.size("_v") > 1, F.sequence(F.lit(0), F.size("_v") - 2))).alias("_e"))
    p = lambda i, k: F.get("_v", F.col("_e") + i)[k]
    return out.select(*own, "_e", p(0, "x").alias("_x1"), p(0, "y").alias("_y1"), p(1, "x").alias("_x2"), p(1, "y").alias("_y2"))


def _parts(lines: DataFrame, grid: Grid | Polygons, vertices: str, key: Sequence[str]) -> DataFrame:
    """For each line (by its key) and cell: the line's columns, grid_id, ``_len`` of the parts inside and, in order, those
    (``_parts``)."""
    cut = _clipped(_edges(lines, vertices), grid)
    (xa, ya), (xb, yb) = _at("_t0"), _at("_t1")
    part = F.struct(F.col("_e").alias("e"), xa.alias("xa"), ya.alias("ya"), xb.alias("xb"), yb.alias("yb"))
    met = cut.groupBy(*[F.col(f"_line_{k}").alias(k) for k in key], "grid_id").agg(
        *[F.first(f"_line_{c}").alias(f"_line_{c}") for c in lines.columns if c not in key],
        F.sort_array(F.collect_list(part)).alias("_parts"),
        F.sum(geo.euclid("_x1", "_y1", "_x2", "_y2") * (F.col("_t1") - F.col("_t0"))).alias("_len"),
    )
    return met.select(*[F.col(c if c in key else f"_line_{c}").alias(c) for c in lines.columns], F.col("grid_id").alias("_cell"), "_parts", "_len")


def grid_intersect(lines: DataFrame, grid: Grid | Polygons, key: Sequence[str], vertices: str = "vertices", lines_epsg: int | None = None, on_mismatch: str = "error") -> DataFrame:
    """All columns of each line with the cells or polygons it meets, its parts inside (``parts``: edge e, from xa, ya to xb,
    yb) and their text. Touching points are kept."""
    check_srs(grid.epsg if lines_epsg is None else lines_epsg, grid, on_mismatch)
    one = lambda p: F.concat(F.lit("("), F.concat_ws(" ", p["xa"].cast("string"), p["ya"].cast("string")), F.lit(", "), F.concat_ws(" ", p["xb"].cast("string"), p["yb"].cast("string")), F.lit(")"))
    wkt = F.concat(F.lit("MULTILINESTRING ("), F.array_join(F.transform("_parts", one), ", "), F.lit(")"))
    return _parts(lines, grid, vertices, key).select(*lines.columns, F.col("_cell").alias("grid_id"), F.col("_parts").alias("parts"), wkt.alias("int_wkt"))


def grid_length(lines: DataFrame, grid: Grid | Polygons, key: Sequence[str], vertices: str = "vertices", lines_epsg: int | None = None, on_mismatch: str = "error") -> DataFrame:
    """All columns of each line with its cells and planar length / 1000 there (km if the plane is in metres)."""
    check_srs(grid.epsg if lines_epsg is None else lines_epsg, grid, on_mismatch)
    return _parts(lines, grid, vertices, key).select(*lines.columns, (F.col("_len") / 1000).alias("grd_len_km"), F.col("_cell").alias("grid_id"))


def grid_track_length(chunks: DataFrame, grid: Grid | Polygons, key: Sequence[str] = ("mmsi", "track_id"), vertices: str = "vertices", lines_epsg: int | None = None, on_mismatch: str = "error") -> DataFrame:
    """Tracks in pieces (see ``track_chunks``) over cells: key, grid_id, planar length / 1000 there, and the number of parts.

    Edges are cut as they are and only numbers are gathered, so a track may be of any length.
    """
    check_srs(grid.epsg if lines_epsg is None else lines_epsg, grid, on_mismatch)
    cut = _clipped(_edges(chunks, vertices), grid)
    keys = [F.col(f"_line_{k}").alias(k) for k in key]
    return cut.groupBy(*keys, "grid_id").agg(F.sum(_length()).alias("grd_len_km"), F.count(F.lit(1)).alias("n_parts"))


def _middle() -> Column:
    return (F.col("_t0") + F.col("_t1")) / 2


def _length() -> Column:
    return geo.euclid("_x1", "_y1", "_x2", "_y2") * (F.col("_t1") - F.col("_t0")) / 1000


def grid_interpolate(segments: DataFrame, grid: Grid | Polygons, v1: str, v2: str, name: str = "interp") -> DataFrame:
    """Two-point lines with their cells and a value between both ends' at the middle of the part inside (for a line
    inside one cell that is the mean). Touching points are kept."""
    t = _middle()
    return _segments(segments, grid).select(*segments.columns, (F.col(v1) * (1 - t) + F.col(v2) * t).alias(name), _length().alias("grd_len_km"), "grid_id")


def grid_interpolate_time(segments: DataFrame, grid: Grid | Polygons, v1: str, v2: str, t1: str, t2: str, name: str = "interp", time_name: str = "interp_time") -> DataFrame:
    """As ``grid_interpolate``, with the time there (whole seconds) and the part's text; only parts with a length."""
    t = _middle()
    a, b = (F.unix_timestamp(c) for c in (t1, t2))
    (xa, ya), (xb, yb) = _at("_t0"), _at("_t1")
    # the two weights are close to rounding where a middle falls on a whole second
    seconds = F.floor(F.round(a + (b - a) * t, 6)).cast("long")
    return _segments(segments, grid).where("_t1 > _t0").select(*segments.columns, (F.col(v1) * (1 - t) + F.col(v2) * t).alias(name), F.timestamp_seconds(seconds).alias(time_name), _length().alias("grd_len_km"), geo.segment_wkt(xa, ya, xb, yb).alias("int_wkt"), "grid_id")


def grid_density(cells: DataFrame, vessel: str = "mmsi", value: str = "interp") -> DataFrame:
    """For each cell: length, vessels, lines and mean value of what crosses it."""
    return cells.groupBy("grid_id").agg(F.sum("grd_len_km").alias("total_len_km"), F.countDistinct(vessel).alias("n_vessels"), F.count(F.lit(1)).alias("n_lines"), F.avg(value).alias("avg_value"))


def polygon_length(segments: DataFrame, cells: DataFrame, cell_id: str, tile: float, vertices: str = "vertices") -> DataFrame:
    """Two-point lines over polygons of one ring (``vertices``): grid_id and length inside / 1000. Layers with holes, and
    all other overlays, take ``Polygons``."""
    layer = Polygons(cells.withColumn("_rings", F.array(vertices)), tile, cell_id, "_rings")
    parts = _segments(segments.drop("grid_id"), layer)
    return parts.groupBy(*segments.columns, "grid_id").agg(F.sum(_length()).alias("grd_len_km"))
