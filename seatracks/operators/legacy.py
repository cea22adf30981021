"""The older rules for segments and tracks.

Cleaning compares with the last accepted report and the track split looks back three points, with a speed that lives on
from earlier steps; both are folds over a vessel's reports in order, whose memory does not depend on how many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import asin, cos, radians, sin, sqrt

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..schema import VESSEL_ORDER
from .segment import MAX_KTS

#: The slowest valid segment in knots, and speeds in km/s of a stopped and of a too fast vessel.
LEGACY_MIN_KTS, STOP_KM_S, BAD_KM_S = 1.0, 0.000257222222, 0.0444444444
INVALID, STATIONARY, ORPHAN = "Invalid position", "Stationary", "Orphaned"


class _Accepted:
    """Tells a vessel's invalid and stationary reports. ``held`` has the reports still undecided, each with its position
    in the current frame: none here."""

    def __init__(self) -> None:
        self.last, self.held = None, []

    def reason(self, point: tuple) -> str | None:
        t, _, lat, lon = point
        if pd.isna(lat) or abs(lat) >= 90:
            return INVALID
        if self.last and ((lat, lon) == self.last[1:] or t == self.last[0]):
            return STATIONARY
        self.last = (t, lat, lon)
        return None

    def feed(self, i: int, point: tuple) -> Iterator[tuple]:
        yield i, self.reason(point)

    def end(self) -> Iterator[tuple]:
        return iter(())


def _fold(pings: DataFrame, ties: Sequence[str], step: Callable, more: str) -> DataFrame:
    """A fold for each vessel's reports in order; it yields rows of (position, further values).

    Sorted rows come in batches, and only the open vessel's fold with the rows it holds goes on to the next one.
    """
    order = ["time", *[c for c in VESSEL_ORDER if c != "time"], *ties]
    names = [c.split()[0] for c in more.split(", ")]

    def taken(frame: pd.DataFrame, rows: list[tuple]) -> pd.DataFrame:
        out = frame.iloc[[r[0] for r in rows]].reset_index(drop=True)
        for k, name in enumerate(names, 1):
            out[name] = pd.Series([r[k] for r in rows], dtype=object)
        return out.astype({c: object for c in out.columns if isinstance(out[c].dtype, pd.StringDtype)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, fold, held = None, None, None
        for pdf in frames:
            frame = pdf if held is None or held.empty else pd.concat([held, pdf], ignore_index=True)
            status = pdf["navigational_status"].astype(object).where(pdf["navigational_status"].notna(), None)
            vessel = pdf["mmsi"].astype(object).where(pdf["mmsi"].notna(), None)
            rows = []
            for i, (mmsi, *point) in enumerate(zip(vessel, pdf["time"], status, pdf["latitude"], pdf["longitude"], strict=True), len(frame) - len(pdf)):
                if fold is None or mmsi != key:
                    rows += fold.end() if fold else ()
                    key, fold = mmsi, step()
                rows += fold.feed(i, tuple(point))
            if fold:
                held = frame.iloc[[i for i, _ in fold.held]]
                fold.held = [(n, point) for n, (_, point) in enumerate(fold.held)]
            yield taken(frame, rows)
        if fold:
            yield taken(held, list(fold.end()))

    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pings.schema.fields)
    return pings.repartition("mmsi").sortWithinPartitions("mmsi", *[F.col(c).asc_nulls_last() for c in order]).mapInPandas(run, f"{base}, {more}")


def legacy_clean(pings: DataFrame, ties: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Accepted reports, and the others with their reason."""
    out = _fold(pings, ties, _Accepted, "reason string")
    return out.where("reason is null").drop("reason"), out.where("reason is not null")


def legacy_point_to_point(accepted: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Pairs of following accepted reports, numbered from 0 for each vessel."""
    w = Window.partitionBy("mmsi").orderBy(*VESSEL_ORDER, *ties)
    nxt = [F.lead(c).over(w).alias(f"{c}2") for c in ("time", "sog", "latitude", "longitude")]
    return accepted.select("*", *nxt, (F.row_number().over(w) - 1).cast("long").alias("segidx")).where("time2 is not null")


def legacy_build_segments(pairs: DataFrame, max_elapsed_s: float, epsg: int = 4326) -> tuple[DataFrame, DataFrame]:
    """Segments with 0 < elapsed < ``max_elapsed_s`` and a speed between the bounds, and counts of the others."""
    out = pairs.withColumn("elp_sec", geo.elapsed_s("time", "time2")).withColumn("_m", geo.step_m("longitude", "latitude", "longitude2", "latitude2", epsg)).withColumn("distspdkts", geo.speed_kts("_m", "elp_sec"))
    timed = (F.col("elp_sec") > 0) & (F.col("elp_sec") < max_elapsed_s)
    why = F.when(~timed, "time").when(F.col("distspdkts") <= LEGACY_MIN_KTS, "slow").when(F.col("distspdkts") >= MAX_KTS, "fast")
    out = out.withColumn("_why", why)
    x1, y1 = geo.project_point("longitude", "latitude", epsg)
    x2, y2 = geo.project_point("longitude2", "latitude2", epsg)
    good = out.where("_why is null").select(F.col("segidx").alias("track_id"), "mmsi", "elp_sec", F.col("time").alias("st_date"), F.col("time2").alias("en_date"), F.col("sog").alias("sogpt1"), F.col("sog2").alias("sogpt2"), "distspdkts", (F.col("_m") / 1000).alias("seg_len_km"), geo.segment_wkt(x1, y1, x2, y2).alias("wkt"))
    return good, out.where("_why is not null").groupBy(F.col("_why").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _km(a: tuple, b: tuple) -> float:
    (_, _, lat1, lon1), (_, _, lat2, lon2) = a, b
    p, q = radians(lat1), radians(lat2)
    return 2 * geo.RADIUS_KM * asin(min(1.0, sqrt(sin((q - p) / 2) ** 2 + cos(p) * cos(q) * sin(radians(lon2 - lon1) / 2) ** 2)))


def _speed(a: tuple, b: tuple) -> float:
    km = _km(a, b)
    seconds = (b[0] - a[0]).total_seconds()
    return 0.0 if not km else km / seconds if seconds > 0 else 999.0


class _Tracks(_Accepted):
    """(position, reason, track) of each report of one vessel, from a two-point look-back.

    ``held`` has the report before (and the one before that). The decision about the oldest falls when the next report
    comes.
    """

    def __init__(self, separation_s: float, max_km_s: float) -> None:
        super().__init__()
        self.separation_s, self.max_km_s = separation_s, max_km_s
        self.track, self.grown, self.speed = 0, False, None

    def apart(self, a: tuple, b: tuple) -> bool:
        return (b[0] - a[0]).total_seconds() >= self.separation_s

    def feed(self, i: int, point: tuple) -> Iterator[tuple[int, str | None, int]]:
        held, new = self.held, (i, point)
        if reason := self.reason(point):
            yield i, reason, self.track
        elif not held:
            self.held = [new]
        elif len(held) == 1:
            at, first = held[0]
            if self.apart(first, point) or point[1] != first[1]:
                yield at, ORPHAN, self.track
                self.held = [new]
            else:
                self.held, self.grown = [held[0], new], False
        else:
            (old_at, old), (prev_at, prev) = held
            broken = old[1] != prev[1] or self.apart(old, prev)
            if not broken:
                self.speed = _speed(old, prev)
            if broken or self.speed < STOP_KM_S:
                if self.grown and self.speed < self.max_km_s:  # the speed may be from an earlier step
                    yield old_at, None, self.track
                self.track, self.held, self.grown = self.track + 1, [held[1], new], False
            elif self.speed < self.max_km_s:
                yield old_at, None, self.track
                self.held, self.grown = [held[1], new], True
            elif _speed(old, point) > self.max_km_s:
                yield old_at, ORPHAN, self.track
                self.held = [held[1], new]
            else:
                yield prev_at, ORPHAN, self.track
                self.held = [held[0], new]

    def end(self) -> Iterator[tuple[int, str | None, int]]:
        if len(self.held) == 2 and not self.grown:
            # two points are left: both stay unless they are apart in time (the older rule's speed test always passes)
            (old_at, old), (prev_at, prev) = self.held
            yield old_at, None, self.track
            yield prev_at, ORPHAN if self.apart(old, prev) else None, self.track
        elif len(self.held) == 1:
            yield self.held[0][0], ORPHAN, self.track


def legacy_tracks(pings: DataFrame, separation_s: float, max_kph: float, ties: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Points of tracks with ``segidx``, and invalid, stationary and orphaned reports with their reason."""
    limit = max_kph / 3600
    out = _fold(pings, ties, lambda: _Tracks(separation_s, limit), "reason string, segidx long")
    return out.where("reason is null").drop("reason"), out.where("reason is not null")


def legacy_layers(points: DataFrame, epsg: int = 4326, ties: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Lines for each track and its points, with ``bad_spd`` once a step of the track has been too fast."""
    w = Window.partitionBy("mmsi", "segidx").orderBy(*VESSEL_ORDER, *ties)
    before = [F.lag(c).over(w) for c in ("longitude", "latitude")]
    x, y = geo.project_point("longitude", "latitude", epsg)
    out = points.withColumn("_m", geo.step_m(*before, "longitude", "latitude", epsg)).withColumn("_s", geo.km_per_s(F.col("_m") / 1000, geo.elapsed_s(F.lag("time").over(w), "time")))
    out = out.withColumn("bad_spd", F.coalesce(F.max((F.col("_s") > BAD_KM_S).cast("int")).over(w), F.lit(0))).withColumn("_x", x).withColumn("_y", y)
    vertex = F.struct("time", *VESSEL_ORDER[1:], *ties, F.col("_x").alias("x"), F.col("_y").alias("y"))
    lines = out.groupBy("mmsi", "segidx").agg(F.count(F.lit(1)).cast("int").alias("seg_pts"), F.min("time").alias("st_date"), F.max("time").alias("en_date"), (F.coalesce(F.sum("_m"), F.lit(0.0)) / 1000).alias("seg_len_km"), F.max("bad_spd").alias("bad_spd"), F.array_sort(F.collect_list(vertex)).alias("_v"))
    lines = lines.where("seg_pts > 1").withColumn("elp_sec", geo.elapsed_s("st_date", "en_date")).withColumn("wkt", geo.line_wkt("_v")).withColumnRenamed("segidx", "track_id").drop("_v")
    dots = out.select(F.col("segidx").alias("track_id"), "mmsi", "time", "sog", "bad_spd", F.col("_x").alias("x"), F.col("_y").alias("y"))
    return lines, dots
