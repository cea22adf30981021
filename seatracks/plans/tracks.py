"""Queries over vessels' reports: cleaning, segments, tracks and grids; and the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import grid as G
from ..operators import legacy as L
from ..operators import segment as S
from ..schema import PING_COLUMNS
from ..sources.writers import track_points
from .pings import PINGS, pings

GAP_S, MAX_KPH, TIES = 86400.0, 160.0, ("event_id",)
#: Cells of the overlays, in degrees.
CELL = 0.1


def _r(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def q_pings(spark: SparkSession, d: str) -> DataFrame:
    return pings(spark, d).select("event_id", *PING_COLUMNS)


def q_out_of_range(spark: SparkSession, d: str) -> DataFrame:
    return S.point_to_point(pings(spark, d), GAP_S, TIES)[1].where(F.col("reason") == S.OUT_OF_RANGE).select("event_id", "mmsi", "reason")


#: Vessels with one report (every seventh), and with two of which one is out of range.
_ALONE = "CASE WHEN event_id % 7 = 0 THEN 400000000 + event_id WHEN event_id % 97 IN (0, 1) THEN 500000000 + CAST(floor(event_id / 97) AS BIGINT) ELSE mmsi END"


def q_single_points(spark: SparkSession, d: str) -> DataFrame:
    """Reports that are alone on their vessel, or are so once reports out of range are gone."""
    p = pings(spark, d).withColumn("mmsi", F.expr(_ALONE))
    return S.point_to_point(p, GAP_S, TIES)[1].where(F.col("reason") == S.STRANDED).select("event_id", "mmsi", "reason")


def q_duplicate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return S.point_to_point(pings(spark, d), GAP_S, TIES)[1].where(F.col("reason").isin(*S.DUPLICATE)).select("event_id", "mmsi", "reason")


def q_p2p_pairs(spark: SparkSession, d: str) -> DataFrame:
    return S.point_to_point(pings(spark, d), GAP_S, TIES)[0].select("event_id", "mmsi", "segidx", "time", "time2", "latitude", "latitude2", "longitude", "longitude2", "sog", "sog2")


def q_p2p_discards(spark: SparkSession, d: str) -> DataFrame:
    return S.point_to_point(pings(spark, d), GAP_S, TIES)[1].select("event_id", "mmsi", "reason")


def q_discard_summary(spark: SparkSession, d: str) -> DataFrame:
    return S.discard_summary(S.point_to_point(pings(spark, d), GAP_S, TIES)[1])


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return S.build_segments(S.point_to_point(pings(spark, d), GAP_S, TIES)[0])


def q_p2p_segments(spark: SparkSession, d: str) -> DataFrame:
    out = _segments(spark, d).select("mmsi", "track_id", "elp_sec", "st_date", "en_date", "sogpt1", "sogpt2", "avg_sog", "distspdkts", "seg_len_km", "x1", "y1", "x2", "y2")
    return _r(out, "avg_sog", "distspdkts", "seg_len_km")


def q_threshold_points(spark: SparkSession, d: str) -> DataFrame:
    return S.threshold_points(pings(spark, d), GAP_S, MAX_KPH, TIES)[0].select("event_id", "mmsi", "segidx")


def q_threshold_discards(spark: SparkSession, d: str) -> DataFrame:
    return S.threshold_points(pings(spark, d), GAP_S, MAX_KPH, TIES)[1].select("event_id", "mmsi", "reason")


def q_tracks(spark: SparkSession, d: str) -> DataFrame:
    points = S.threshold_points(pings(spark, d), GAP_S, MAX_KPH, TIES)[0]
    return _r(S.build_tracks(points, ties=TIES).select("mmsi", "track_id", "elp_sec", "seg_pts", "st_date", "en_date", "avg_sog", "med_sog", "dstspdkts", "seg_len_km"), "avg_sog", "med_sog", "dstspdkts", "seg_len_km")


def q_track_cells(spark: SparkSession, d: str) -> DataFrame:
    """All tracks over the grid, in pieces of a few edges."""
    points = S.threshold_points(pings(spark, d), GAP_S, MAX_KPH, TIES)[0]
    out = G.grid_track_length(S.track_chunks(points, ties=TIES, size=8), _grid(spark, d))
    return _to_bits(out, grd_len_km=SUM_BITS)


def q_bearing_distance(spark: SparkSession, d: str) -> DataFrame:
    p = S.point_to_point(pings(spark, d), GAP_S, TIES)[0]
    args = ("longitude", "latitude", "longitude2", "latitude2")
    return p.select("event_id", F.round(geo.haversine_km(*args), 6).alias("km"), F.round(geo.initial_bearing(*args), 6).alias("bearing"))


def q_grid_cells(spark: SparkSession, d: str) -> DataFrame:
    """A grid over the extent of the reports, with the number of reports in each cell."""
    seen = pings(spark, d).where((F.abs("latitude") <= 90) & (F.abs("longitude") <= 180))
    b = seen.agg(F.min("longitude").alias("x0"), F.max("longitude").alias("x1"), F.min("latitude").alias("y0"), F.max("latitude").alias("y1")).first()
    grid = G.make_grid(spark, b.x0, b.x1, b.y0, b.y1, 4326, 0.5)
    cell = lambda c, low: F.floor((F.col(c) - F.lit(low)) / F.lit(grid.size)).cast("int")
    counts = seen.groupBy(cell("longitude", grid.xmin).alias("gx"), cell("latitude", grid.ymin).alias("gy")).agg(F.count(F.lit(1)).alias("n"))
    out = grid.cells(spark).join(counts, (F.col("ix") == F.col("gx")) & (F.col("iy") == F.col("gy")), "left")
    return _r(out.select("cell_id", "ix", "iy", "xmin", "ymin", "xmax", "ymax", F.coalesce("n", F.lit(0)).alias("n_pings")), "xmin", "ymin", "xmax", "ymax")


#: Binary digits after the point that overlays are compared at. Decimal digits would not do: many lengths and values lie
#: just between two of those, and engines round such ties apart.
VALUE_BITS, LENGTH_BITS, SUM_BITS, PLACE_BITS, CROSSING_BITS = 30, 50, 40, 36, 20


def _to_bits(df: DataFrame, **bits: int) -> DataFrame:
    return df.withColumns({c: F.floor(F.col(c) * 2.0**k + 0.5) / 2.0**k for c, k in bits.items()})


def _bits_sql(x: str, k: int) -> str:
    return f"floor({x} * pow(2, {k}) + 0.5) / pow(2, {k})"


def _grid(spark: SparkSession, d: str) -> G.Grid:
    """A grid over the extent of all reports in range, and so of all segments, with half a cell around it: none lies on
    its border."""
    seen = pings(spark, d).where((F.abs("latitude") <= 90) & (F.abs("longitude") <= 180))
    b = seen.agg(F.min("longitude").alias("x0"), F.max("longitude").alias("x1"), F.min("latitude").alias("y0"), F.max("latitude").alias("y1")).first()
    return G.Grid(0, 0, CELL, 0, 0) if b.x0 is None else G.make_grid(spark, b.x0 - CELL / 2, b.x1 + CELL / 2, b.y0 - CELL / 2, b.y1 + CELL / 2, 4326, CELL)


def _layer(spark: SparkSession, d: str) -> G.Polygons:
    """The same grid as a layer of polygons."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    rings = F.array(F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax")))
    return G.Polygons(_grid(spark, d).cells(spark).select("cell_id", rings.alias("rings")), 5 * CELL)


def _lines(spark: SparkSession, d: str) -> DataFrame:
    ends = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))
    return _segments(spark, d).withColumn("vertices", ends)


def q_grid_lengths(spark: SparkSession, d: str) -> DataFrame:
    out = G.grid_length(_lines(spark, d), _grid(spark, d), ("mmsi", "track_id"))
    return _to_bits(out.select("mmsi", "track_id", "grid_id", "grd_len_km"), grd_len_km=LENGTH_BITS)


def q_grid_interp(spark: SparkSession, d: str) -> DataFrame:
    out = G.grid_interpolate(_segments(spark, d), _grid(spark, d), "sogpt1", "sogpt2")
    return _to_bits(out.select("mmsi", "track_id", "grid_id", "interp"), interp=VALUE_BITS)


def _interp_time(spark: SparkSession, d: str) -> DataFrame:
    return G.grid_interpolate_time(_segments(spark, d), _grid(spark, d), "sogpt1", "sogpt2", "st_date", "en_date")


def q_grid_interp_time(spark: SparkSession, d: str) -> DataFrame:
    return _to_bits(_interp_time(spark, d).select("mmsi", "track_id", "grid_id", "interp", "interp_time", "grd_len_km"), interp=VALUE_BITS, grd_len_km=LENGTH_BITS)


def q_grid_density(spark: SparkSession, d: str) -> DataFrame:
    return _to_bits(G.grid_density(_interp_time(spark, d)), total_len_km=SUM_BITS, avg_value=VALUE_BITS)


def _part_columns(df: DataFrame, bits: int = PLACE_BITS) -> DataFrame:
    parts = df.select("mmsi", "track_id", "grid_id", F.explode("parts").alias("p")).select("mmsi", "track_id", "grid_id", "p.xa", "p.ya", "p.xb", "p.yb")
    return _to_bits(parts, xa=bits, ya=bits, xb=bits, yb=bits)


def q_grid_intersect(spark: SparkSession, d: str) -> DataFrame:
    """The parts of all segments in the cells they meet or touch."""
    return _part_columns(G.grid_intersect(_lines(spark, d), _grid(spark, d), ("mmsi", "track_id")))


def q_polygon_intersect(spark: SparkSession, d: str) -> DataFrame:
    """The same over the cells as polygons, whose crossings come by another way; parts without length are left out."""
    out = _part_columns(G.grid_intersect(_lines(spark, d), _layer(spark, d), ("mmsi", "track_id")), CROSSING_BITS)
    return out.where("xa <> xb or ya <> yb")


def q_legacy_p2p(spark: SparkSession, d: str) -> DataFrame:
    pairs = L.legacy_point_to_point(L.legacy_clean(pings(spark, d), TIES)[0], TIES)
    return _r(L.legacy_build_segments(pairs, GAP_S)[0].select("mmsi", "track_id", "elp_sec", "distspdkts", "seg_len_km"), "distspdkts", "seg_len_km")


def q_legacy_tracks(spark: SparkSession, d: str) -> DataFrame:
    points, _ = L.legacy_tracks(pings(spark, d), GAP_S, MAX_KPH, TIES)
    return _r(L.legacy_layers(points, ties=TIES)[0].select("mmsi", "track_id", "seg_pts", "elp_sec", "seg_len_km", "bad_spd"), "seg_len_km")


def q_legacy_points(spark: SparkSession, d: str) -> DataFrame:
    """The vertices of the older tracks as points, with the flag that stays once a step has been too fast."""
    points, _ = L.legacy_tracks(pings(spark, d), GAP_S, MAX_KPH, TIES)
    return track_points(L.legacy_layers(points, ties=TIES)[1])


_ORDER = "PARTITION BY mmsi ORDER BY time, message_id, latitude, longitude, cog, sog, heading, event_id"
_BASE = f"""
WITH pings AS ({PINGS}),
counted AS (SELECT *, count(*) OVER (PARTITION BY mmsi) AS n FROM pings),
good AS (SELECT *, count(*) OVER (PARTITION BY mmsi) AS m FROM counted WHERE n > 1 AND abs(latitude) <= 90 AND abs(longitude) <= 180),
nexts AS (SELECT *, lead(event_id) OVER w AS event2, lead(time) OVER w AS time2, lead(latitude) OVER w AS latitude2, lead(longitude) OVER w AS longitude2, lead(sog) OVER w AS sog2 FROM good WINDOW w AS ({_ORDER})),
pairs AS (SELECT *, time = time2 OR (latitude = latitude2 AND longitude = longitude2) AS dup, (epoch_us(time2) - epoch_us(time)) / 1e6 AS gap FROM nexts),
p2p AS (SELECT *, row_number() OVER ({_ORDER}) - 1 AS segidx FROM pairs WHERE event2 IS NOT NULL AND NOT dup AND gap <= {GAP_S})
"""
_KM = "2 * 6367.0 * asin(sqrt(least(1.0, pow(sin((radians({d}) - radians({b})) / 2), 2) + cos(radians({b})) * cos(radians({d})) * pow(sin((radians({c}) - radians({a})) / 2), 2))))"


def _km(a: str, b: str, c: str, d: str) -> str:
    return _KM.format(a=a, b=b, c=c, d=d)


_DISCARDS = f"""
SELECT event_id, mmsi, '{S.STRANDED}' AS reason FROM counted WHERE n = 1
UNION ALL SELECT event_id, mmsi, '{S.OUT_OF_RANGE}' FROM counted WHERE n > 1 AND (abs(latitude) > 90 OR abs(longitude) > 180)
UNION ALL SELECT event_id, mmsi, '{S.STRANDED}' FROM good WHERE m = 1
UNION ALL SELECT event_id, mmsi, 'Duplicate point/time (pt1''s)' FROM pairs WHERE dup
UNION ALL SELECT event2, mmsi, 'Duplicate point/time (pt2''s)' FROM pairs WHERE dup
UNION ALL SELECT event_id, mmsi, 'Time threshold exceeded (pt1''s)' FROM pairs WHERE NOT dup AND gap > {GAP_S}
UNION ALL SELECT event2, mmsi, 'Time threshold exceeded (pt2''s)' FROM pairs WHERE NOT dup AND gap > {GAP_S}
"""
_SEGMENTS = f"""
, lens AS (SELECT *, {_km("longitude", "latitude", "longitude2", "latitude2")} AS km FROM p2p),
segs AS (SELECT mmsi, segidx AS track_id, gap AS elp_sec, time AS st_date, time2 AS en_date, sog AS sogpt1, sog2 AS sogpt2, (sog + sog2) / 2 AS avg_sog, (km * 1000 / 1852) / (gap / 3600) AS distspdkts, km AS seg_len_km, longitude AS x1, latitude AS y1, longitude2 AS x2, latitude2 AS y2 FROM lens
  WHERE (km * 1000 / 1852) / (gap / 3600) > {S.MIN_KTS} AND (km * 1000 / 1852) / (gap / 3600) < {S.MAX_KTS})
"""
_POINT = "struct_pack(id := event_id, t := time, s := navigational_status, x := longitude, y := latitude)"


def _speed(a: str, b: str) -> str:
    """Speed in km/s between two points of the walk; no distance is no speed, no time a very fast one."""
    km, seconds = _km(f"{a}.x", f"{a}.y", f"{b}.x", f"{b}.y"), f"((epoch_us({b}.t) - epoch_us({a}.t)) / 1e6)"
    return f"CASE WHEN {km} = 0 THEN 0 WHEN {seconds} > 0 THEN {km} / {seconds} ELSE 999 END"


def _apart(a: str, b: str) -> str:
    return f"(epoch_us({b}.t) - epoch_us({a}.t)) / 1e6 >= {GAP_S}"


#: The older rules as walks over each vessel's reports: the last accepted report, and the one or two held ones.
_ACCEPTED = f"""
WITH RECURSIVE pings AS ({PINGS}),
o AS (SELECT *, {_POINT} AS p, row_number() OVER ({_ORDER}) AS rn FROM pings),
walk AS (
  SELECT mmsi, rn, abs(p.y) < 90 AS ok, CASE WHEN abs(p.y) < 90 THEN p END AS l FROM o WHERE rn = 1
  UNION ALL SELECT mmsi, rn, ok, CASE WHEN ok THEN p ELSE l END FROM
    (SELECT o.mmsi, o.rn, o.p, w.l, abs(o.p.y) < 90 AND coalesce(NOT (o.p.t = w.l.t OR (o.p.y = w.l.y AND o.p.x = w.l.x)), true) AS ok FROM walk w JOIN o ON o.mmsi = w.mmsi AND o.rn = w.rn + 1)),
acc AS (SELECT o.*, row_number() OVER (PARTITION BY o.mmsi ORDER BY o.rn) AS k FROM o JOIN walk w ON o.mmsi = w.mmsi AND o.rn = w.rn WHERE ok)
"""
_WALKED = f"""
, held AS (
  SELECT mmsi, k, p AS a, NULL::STRUCT(id BIGINT, t TIMESTAMP, s INTEGER, x DOUBLE, y DOUBLE) AS b, 0::BIGINT AS track, false AS grown, NULL::DOUBLE AS v, NULL::BIGINT AS out_id, 0::BIGINT AS out_track FROM acc WHERE k = 1
  UNION ALL SELECT mmsi, k,
    CASE move WHEN 'again' THEN p WHEN 'pair' THEN a WHEN 'skip' THEN a ELSE b END, CASE move WHEN 'again' THEN NULL ELSE p END,
    CASE move WHEN 'stop' THEN track + 1 ELSE track END, CASE move WHEN 'pair' THEN false WHEN 'stop' THEN false WHEN 'on' THEN true ELSE grown END, v,
    CASE WHEN move = 'on' OR (move = 'stop' AND grown AND v < {MAX_KPH / 3600!r}) THEN a.id END, track
  FROM (SELECT *, CASE WHEN b IS NULL THEN CASE WHEN {_apart("a", "p")} OR p.s IS DISTINCT FROM a.s THEN 'again' ELSE 'pair' END
      WHEN broken OR v < {L.STOP_KM_S!r} THEN 'stop' WHEN v < {MAX_KPH / 3600!r} THEN 'on' WHEN {_speed("a", "p")} > {MAX_KPH / 3600!r} THEN 'drop' ELSE 'skip' END AS move
    FROM (SELECT * REPLACE (CASE WHEN b IS NULL OR broken THEN v ELSE {_speed("a", "b")} END AS v)
      FROM (SELECT acc.mmsi, acc.k, acc.p, h.a, h.b, h.track, h.grown, h.v, h.b IS NOT NULL AND (h.a.s IS DISTINCT FROM h.b.s OR {_apart("h.a", "h.b")}) AS broken FROM held h JOIN acc ON acc.mmsi = h.mmsi AND acc.k = h.k + 1)))),
ends AS (FROM held h WHERE b IS NOT NULL AND NOT grown AND k = (SELECT max(k) FROM acc WHERE acc.mmsi = h.mmsi)),
taken AS (SELECT out_id AS id, out_track AS track FROM held WHERE out_id IS NOT NULL UNION ALL SELECT a.id, track FROM ends UNION ALL SELECT b.id, track FROM ends WHERE NOT ({_apart("a", "b")})),
steps AS (SELECT acc.mmsi, track, k, time, sog, longitude, latitude, {_km("lag(longitude) OVER w", "lag(latitude) OVER w", "longitude", "latitude")} AS km, (epoch_us(time) - epoch_us(lag(time) OVER w)) / 1e6 AS sec FROM acc JOIN taken ON acc.event_id = taken.id WINDOW w AS (PARTITION BY acc.mmsi, track ORDER BY k))
"""
_PLACED = f"""
, flags AS (SELECT *, coalesce(event2 IS NOT NULL AND NOT dup, false) AS first FROM pairs WHERE m >= 3),
ends AS (SELECT *, lag(first) OVER ({_ORDER}) AS was_first, max(first::INT) OVER ({_ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS later FROM flags),
kept AS (SELECT *, count(*) OVER (PARTITION BY mmsi) AS k FROM ends WHERE first OR (coalesce(was_first, false) AND later = 0)),
around AS (SELECT *, lag(time) OVER w AS ta, lag(longitude) OVER w AS xa, lag(latitude) OVER w AS ya, lead(time) OVER w AS tb, lead(longitude) OVER w AS xb, lead(latitude) OVER w AS yb FROM kept WHERE k >= 3 WINDOW w AS ({_ORDER})),
fasts AS (SELECT *, coalesce({_km("xa", "ya", "longitude", "latitude")} / ((epoch_us(time) - epoch_us(ta)) / 1e6) > {MAX_KPH / 3600!r} AND {_km("longitude", "latitude", "xb", "yb")} / ((epoch_us(tb) - epoch_us(time)) / 1e6) > {MAX_KPH / 3600!r}, false) AS fast FROM around),
left_ AS (SELECT * EXCLUDE (tb, xb, yb), count(*) OVER (PARTITION BY mmsi) AS l FROM fasts WHERE NOT fast),
onward AS (SELECT *, lead(time) OVER w AS tb, lead(longitude) OVER w AS xb, lead(latitude) OVER w AS yb FROM left_ WHERE l >= 3 WINDOW w AS ({_ORDER})),
stops AS (SELECT *, coalesce({_km("longitude", "latitude", "xb", "yb")} * 1000 / 1852 / ((epoch_us(tb) - epoch_us(time)) / 1e6 / 3600) < {S.MIN_KTS} OR (epoch_us(tb) - epoch_us(time)) / 1e6 > {GAP_S}, false) AS stop FROM onward),
prevs AS (SELECT *, coalesce(lag(stop) OVER ({_ORDER}), true) AS prev FROM stops),
placed AS (SELECT *, prev AND (stop OR tb IS NULL) AS stranded, coalesce(sum((stop AND NOT prev)::INT) OVER ({_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS segidx FROM prevs)
"""
_S = f"CAST({CELL} AS DOUBLE)"  # a plain number is a decimal there
#: Only cells of each segment's bounding box, and one around it, are tried.
_GRID = f"""
, b AS (SELECT min(longitude) - {_S} / 2 AS x0, max(longitude) + {_S} / 2 AS x9, min(latitude) - {_S} / 2 AS y0, max(latitude) + {_S} / 2 AS y9 FROM pings WHERE abs(latitude) <= 90 AND abs(longitude) <= 180),
n AS (SELECT *, ceil(abs(x9 - x0) / {_S})::BIGINT AS nx, ceil(abs(y9 - y0) / {_S})::BIGINT AS ny FROM b),
o AS (SELECT nx, ny, (x9 + x0) / 2 - nx * {_S} / 2 AS ox, (y9 + y0) / 2 - ny * {_S} / 2 AS oy FROM n),
cols AS (SELECT s.*, o.*, unnest(range(greatest(0, floor((least(x1, x2) - ox) / {_S})::BIGINT - 1), least(nx, floor((greatest(x1, x2) - ox) / {_S})::BIGINT + 2))) AS ix FROM segs s, o),
cells AS (SELECT *, unnest(range(greatest(0, floor((least(y1, y2) - oy) / {_S})::BIGINT - 1), least(ny, floor((greatest(y1, y2) - oy) / {_S})::BIGINT + 2))) AS iy FROM cols),
edges AS (SELECT *, ix * ny + iy AS grid_id, ox + ix * {_S} AS cx, oy + iy * {_S} AS cy FROM cells),
clip AS (SELECT *,
  greatest(0, CASE WHEN x1 = x2 THEN CASE WHEN x1 BETWEEN cx AND cx + {_S} THEN 0 ELSE 2 END ELSE least((cx - x1) / (x2 - x1), (cx + {_S} - x1) / (x2 - x1)) END, CASE WHEN y1 = y2 THEN CASE WHEN y1 BETWEEN cy AND cy + {_S} THEN 0 ELSE 2 END ELSE least((cy - y1) / (y2 - y1), (cy + {_S} - y1) / (y2 - y1)) END) AS t0,
  least(1, CASE WHEN x1 = x2 THEN 1 ELSE greatest((cx - x1) / (x2 - x1), (cx + {_S} - x1) / (x2 - x1)) END, CASE WHEN y1 = y2 THEN 1 ELSE greatest((cy - y1) / (y2 - y1), (cy + {_S} - y1) / (y2 - y1)) END) AS t1
  FROM edges),
inside AS (SELECT *, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) * (t1 - t0) / 1000 AS grd_len_km, sogpt1 * (1 - (t0 + t1) / 2) + sogpt2 * ((t0 + t1) / 2) AS interp,
  floor(round(epoch_us(st_date) / 1e6 + (epoch_us(en_date) - epoch_us(st_date)) / 1e6 * ((t0 + t1) / 2), 6)) AS interp_s, x1 + (x2 - x1) * t0 AS xa, y1 + (y2 - y1) * t0 AS ya, x1 + (x2 - x1) * t1 AS xb, y1 + (y2 - y1) * t1 AS yb FROM clip WHERE t0 <= t1)
"""


def _parts_sql(bits: int) -> str:
    return f"SELECT mmsi, track_id, grid_id, {', '.join(f'{_bits_sql(c, bits)} AS {c}' for c in ('xa', 'ya', 'xb', 'yb'))} FROM inside"


ORACLES = {
    "pings": f"WITH pings AS ({PINGS}) SELECT * FROM pings",
    "out_of_range": _BASE + f"SELECT event_id, mmsi, '{S.OUT_OF_RANGE}' AS reason FROM counted WHERE n > 1 AND (abs(latitude) > 90 OR abs(longitude) > 180)",
    "single_points": _BASE.replace("FROM pings)", f"FROM (SELECT * REPLACE ({_ALONE} AS mmsi) FROM pings))", 1) + f"SELECT event_id, mmsi, '{S.STRANDED}' AS reason FROM counted WHERE n = 1 UNION ALL SELECT event_id, mmsi, '{S.STRANDED}' FROM good WHERE m = 1",
    "duplicate_pairs": _BASE + "SELECT event_id, mmsi, 'Duplicate point/time (pt1''s)' AS reason FROM pairs WHERE dup UNION ALL SELECT event2, mmsi, 'Duplicate point/time (pt2''s)' FROM pairs WHERE dup",
    "p2p_pairs": _BASE + "SELECT event_id, mmsi, segidx, time, time2, latitude, latitude2, longitude, longitude2, sog, sog2 FROM p2p",
    "p2p_discards": _BASE + _DISCARDS,
    "discard_summary": _BASE + f"SELECT reason, count(*) AS n FROM ({_DISCARDS}) GROUP BY reason",
    "p2p_segments": _BASE + _SEGMENTS + "SELECT * REPLACE (round(avg_sog, 6) AS avg_sog, round(distspdkts, 6) AS distspdkts, round(seg_len_km, 6) AS seg_len_km) FROM segs",
    "threshold_points": _BASE + _PLACED + "SELECT event_id, mmsi, segidx FROM placed WHERE NOT stranded",
    "threshold_discards": _BASE
    + _PLACED
    + f"""SELECT event_id, mmsi, '{S.STRANDED}' AS reason FROM counted WHERE n = 1
UNION ALL SELECT event_id, mmsi, '{S.OUT_OF_RANGE}' FROM counted WHERE n > 1 AND (abs(latitude) > 90 OR abs(longitude) > 180)
UNION ALL SELECT event_id, mmsi, '{S.FEW}' FROM good WHERE m < 3
UNION ALL SELECT event_id, mmsi, 'Duplicate point/time (pt1''s)' FROM pairs WHERE m >= 3 AND dup
UNION ALL SELECT event2, mmsi, 'Duplicate point/time (pt2''s)' FROM pairs WHERE m >= 3 AND dup
UNION ALL SELECT event_id, mmsi, '{S.FEW}' FROM kept WHERE k < 3
UNION ALL SELECT event_id, mmsi, '{S.FAST}' FROM fasts WHERE fast
UNION ALL SELECT event_id, mmsi, '{S.FEW}' FROM left_ WHERE l < 3
UNION ALL SELECT event_id, mmsi, '{S.STOPPED}' FROM placed WHERE stranded""",
    "tracks": _BASE
    + _PLACED
    + f""", steps AS (SELECT *, {_km("lag(longitude) OVER w", "lag(latitude) OVER w", "longitude", "latitude")} AS km FROM placed WHERE NOT stranded WINDOW w AS (PARTITION BY mmsi, segidx ORDER BY time, message_id, latitude, longitude, cog, sog, heading, event_id)),
per AS (SELECT mmsi, segidx AS track_id, (epoch_us(max(time)) - epoch_us(min(time))) / 1e6 AS elp_sec, count(*)::INT AS seg_pts, min(time) AS st_date, max(time) AS en_date, avg(sog) AS avg_sog, median(sog) AS med_sog, coalesce(sum(km), 0) AS km FROM steps GROUP BY mmsi, segidx)
SELECT mmsi, track_id, elp_sec, seg_pts, st_date, en_date, round(avg_sog, 6) AS avg_sog, round(med_sog, 6) AS med_sog, round(CASE WHEN elp_sec = 0 THEN NULL ELSE km * 1000 / 1852 / (elp_sec / 3600) END, 6) AS dstspdkts, round(km, 6) AS seg_len_km FROM per""",
    "bearing_distance": _BASE
    + f"""SELECT event_id, round({_km("longitude", "latitude", "longitude2", "latitude2")}, 6) AS km,
round((degrees(atan2(sin(radians(longitude2) - radians(longitude)) * cos(radians(latitude2)), cos(radians(latitude)) * sin(radians(latitude2)) - sin(radians(latitude)) * cos(radians(latitude2)) * cos(radians(longitude2) - radians(longitude)))) + 360) % 360, 6) AS bearing FROM p2p""",
    "grid_cells": f"""WITH pings AS ({PINGS}), seen AS (SELECT * FROM pings WHERE abs(latitude) <= 90 AND abs(longitude) <= 180),
b AS (SELECT min(longitude) AS x0, max(longitude) AS x1, min(latitude) AS y0, max(latitude) AS y1 FROM seen),
g AS (SELECT *, ceil((x1 - x0) / 0.5)::INT AS nx, ceil((y1 - y0) / 0.5)::INT AS ny FROM b),
o AS (SELECT nx, ny, (x1 + x0) / 2 - nx * 0.5::DOUBLE / 2 AS ox, (y1 + y0) / 2 - ny * 0.5::DOUBLE / 2 AS oy FROM g),
c AS (SELECT ix::INT AS ix, iy::INT AS iy, ny, ox, oy FROM (SELECT *, unnest(range(nx)) AS ix FROM o) x, LATERAL (SELECT unnest(range(x.ny)) AS iy)),
n AS (SELECT floor((longitude - ox) / 0.5)::INT AS gx, floor((latitude - oy) / 0.5)::INT AS gy, count(*) AS n FROM seen, o GROUP BY 1, 2)
SELECT (ix * ny + iy)::BIGINT AS cell_id, ix, iy, round(ox + ix * 0.5::DOUBLE, 6) AS xmin, round(oy + iy * 0.5::DOUBLE, 6) AS ymin, round(ox + (ix + 1) * 0.5::DOUBLE, 6) AS xmax, round(oy + (iy + 1) * 0.5::DOUBLE, 6) AS ymax, coalesce(n, 0) AS n_pings FROM c LEFT JOIN n ON ix = gx AND iy = gy""",
    "grid_lengths": _BASE + _SEGMENTS + _GRID + f"SELECT mmsi, track_id, grid_id, {_bits_sql('grd_len_km', LENGTH_BITS)} AS grd_len_km FROM inside",
    "grid_interp": _BASE + _SEGMENTS + _GRID + f"SELECT mmsi, track_id, grid_id, {_bits_sql('interp', VALUE_BITS)} AS interp FROM inside",
    "grid_interp_time": _BASE + _SEGMENTS + _GRID + f"SELECT mmsi, track_id, grid_id, {_bits_sql('interp', VALUE_BITS)} AS interp, to_timestamp(interp_s) AT TIME ZONE 'UTC' AS interp_time, {_bits_sql('grd_len_km', LENGTH_BITS)} AS grd_len_km FROM inside WHERE t0 < t1",
    "grid_density": _BASE + _SEGMENTS + _GRID + f"SELECT grid_id, {_bits_sql('sum(grd_len_km)', SUM_BITS)} AS total_len_km, count(DISTINCT mmsi) AS n_vessels, count(*) AS n_lines, {_bits_sql('avg(interp)', VALUE_BITS)} AS avg_value FROM inside WHERE t0 < t1 GROUP BY grid_id",
    "grid_intersect": _BASE + _SEGMENTS + _GRID + _parts_sql(PLACE_BITS),
    "track_cells": _BASE + _PLACED + f""", edges_ AS (SELECT mmsi, segidx AS track_id, longitude AS x1, latitude AS y1, lead(longitude) OVER w AS x2, lead(latitude) OVER w AS y2, sog AS sogpt1, sog AS sogpt2, time AS st_date, time AS en_date
  FROM placed WHERE NOT stranded WINDOW w AS (PARTITION BY mmsi, segidx ORDER BY time, message_id, latitude, longitude, cog, sog, heading, event_id)), segs AS (SELECT * FROM edges_ WHERE x2 IS NOT NULL)""" + _GRID + f"SELECT mmsi, track_id, grid_id, {_bits_sql('sum(grd_len_km)', SUM_BITS)} AS grd_len_km, count(*) AS n_parts FROM inside GROUP BY mmsi, track_id, grid_id",
    "legacy_p2p": _ACCEPTED + f""", n AS (SELECT mmsi, k - 1 AS track_id, p, lead(p) OVER (PARTITION BY mmsi ORDER BY k) AS q FROM acc), m AS (SELECT *, (epoch_us(q.t) - epoch_us(p.t)) / 1e6 AS elp_sec, {_km("p.x", "p.y", "q.x", "q.y")} AS km FROM n WHERE q IS NOT NULL)
SELECT mmsi, track_id, elp_sec, round(km * 1000 / 1852 / (elp_sec / 3600), 6) AS distspdkts, round(km, 6) AS seg_len_km FROM m WHERE elp_sec > 0 AND elp_sec < {GAP_S} AND km * 1000 / 1852 / (elp_sec / 3600) > {L.LEGACY_MIN_KTS} AND km * 1000 / 1852 / (elp_sec / 3600) < {S.MAX_KTS}""",
    "legacy_tracks": _ACCEPTED + _WALKED + f"""SELECT mmsi, track AS track_id, count(*)::INT AS seg_pts, (epoch_us(max(time)) - epoch_us(min(time))) / 1e6 AS elp_sec, round(coalesce(sum(km), 0), 6) AS seg_len_km, max(coalesce(km / sec > {L.BAD_KM_S!r}, false)::INT) AS bad_spd FROM steps GROUP BY mmsi, track HAVING count(*) > 1""",
    "legacy_points": _ACCEPTED + _WALKED + f"""SELECT track AS track_id, mmsi, time, sog, max(coalesce(km / sec > {L.BAD_KM_S!r}, false)::INT) OVER (PARTITION BY mmsi, track ORDER BY k) AS bad_spd, printf('POINT (%.6f %.6f)', longitude, latitude) AS wkt FROM steps""",
    "polygon_intersect": _BASE + _SEGMENTS + _GRID + f"SELECT * FROM ({_parts_sql(CROSSING_BITS)}) WHERE xa <> xb OR ya <> yb",
}

QUERIES = {k[2:]: v for k, v in list(globals().items()) if k.startswith("q_")}
