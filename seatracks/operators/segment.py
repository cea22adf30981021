"""Segments and tracks from position reports.

Everything is windows over one partitioning (the vessel) and one order, so a chain of cleaning steps costs one exchange.
Rejected reports are kept with their reason, in the same pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..schema import PING_COLUMNS, VESSEL_ORDER
from ..shared import shared_dir, written

#: Speeds of a valid segment, in knots (the upper is 160 km/h).
MIN_KTS, MAX_KTS = 0.5, 86.3930885411603
STRANDED, OUT_OF_RANGE = "Stranded single point", "Out of range"
DUPLICATE = ("Duplicate point/time (pt1's)", "Duplicate point/time (pt2's)")
LATE = ("Time threshold exceeded (pt1's)", "Time threshold exceeded (pt2's)")
FEW, FAST, STOPPED = "Not enough points for segmentation", "Excess speed", "Stranded stop"


class _Chain:
    """A vessel's reports in order, step by step; all rows stay, with ``_live`` (still in the chain) and ``_reasons``.

    Each step's values are windows over the live rows of a vessel (``_live`` is part of the partitioning, which costs a
    sort, but no exchange). With ``slice_s``, a vessel's time is cut into slices of so many seconds, which are the windows:
    what crosses their borders (counts, and the nearest live report on either side) comes from one small row for each
    slice, so a vessel with very many reports is spread over tasks. Each such step begins at a table in the shared folder:
    the rows are read twice, and a plan that held all steps would double with each.
    """

    def __init__(self, pings: DataFrame, ties: Sequence[str], slice_s: float | None):
        self.keep, self.order, self.sliced = pings.columns, [*VESSEL_ORDER, *ties], bool(slice_s)
        self.vessel = ["_v", "_live"]
        self.keys = [*self.vessel, "_slice"] if slice_s else self.vessel
        self.w = Window.partitionBy(*self.keys).orderBy(*self.order)
        df = pings.withColumns({"_v": F.col("mmsi"), "_live": F.lit(True), "_reasons": F.array().cast("array<string>")})
        if slice_s:
            self.home, self.steps = shared_dir(pings.sparkSession), 0
            # neither key may be null, as rows meet their slice's row by them
            df = df.withColumn("_v", F.coalesce("mmsi", F.lit(-(1 << 62)))).withColumn("_slice", F.coalesce(F.floor(F.unix_micros("time") / (slice_s * 1e6)), F.lit(-(1 << 62))))
            # a place for each of equal reports, the same in all steps
            df = df.withColumn("_place", F.row_number().over(self.w))
            self.order = [*self.order, "_place"]
            self.w = Window.partitionBy(*self.keys).orderBy(*self.order)
        self.df = df

    def add(self, shifts: dict[str, tuple[Column, int]] | None = None, totals: dict[str, Column] | None = None, before: dict[str, Column] | None = None) -> None:
        """Adds values of the report next (1) or previous (-1), totals over a vessel, and sums over the reports before."""
        shifts, totals, before = shifts or {}, totals or {}, before or {}
        whole, past = (self.w.rowsBetween(Window.unboundedPreceding, x) for x in (Window.unboundedFollowing, -1))
        if not self.sliced:
            values = {n: (F.lead if by > 0 else F.lag)(c).over(self.w) for n, (c, by) in shifts.items()}
            values |= {n: F.sum(c).over(whole) for n, c in totals.items()} | {n: F.coalesce(F.sum(c).over(past), F.lit(0)) for n, c in before.items()}
            self.df = self.df.withColumns(values)
            return
        self.df = written(self.df, f"{self.home}/{self.steps}")
        self.steps += 1
        order = F.struct(*self.order)
        parts = {f"_e{n}": (F.min_by if by > 0 else F.max_by)(F.struct(c.alias("v")), order) for n, (c, by) in shifts.items()}
        parts |= {f"_t{n}": F.sum(c) for n, c in totals.items()} | {f"_b{n}": F.sum(c) for n, c in before.items()}
        per = self.df.groupBy(*self.keys).agg(*[c.alias(n) for n, c in parts.items()])
        slices = Window.partitionBy(*self.vessel).orderBy("_slice")
        all_, earlier = (slices.rowsBetween(Window.unboundedPreceding, x) for x in (Window.unboundedFollowing, -1))
        per = per.select(
            *self.keys, *[(F.lead if by > 0 else F.lag)(f"_e{n}").over(slices).alias(f"_e{n}") for n, (_, by) in shifts.items()],
            *[F.sum(f"_t{n}").over(all_).alias(f"_t{n}") for n in totals], *[F.coalesce(F.sum(f"_b{n}").over(earlier), F.lit(0)).alias(f"_b{n}") for n in before],
        )
        values = {n: F.coalesce((F.lead if by > 0 else F.lag)(F.struct(c.alias("v"))).over(self.w), F.col(f"_e{n}"))["v"] for n, (c, by) in shifts.items()}
        values |= {n: F.col(f"_t{n}") for n in totals} | {n: F.col(f"_b{n}") + F.coalesce(F.sum(c).over(past), F.lit(0)) for n, c in before.items()}
        self.df = self.df.join(per, self.keys).withColumns(values).drop(*parts)

    def put(self, **columns: Column) -> None:
        self.df = self.df.withColumns(columns)

    def step(self, stays: Column, *reasons: Column) -> None:
        """Live rows get the reasons that aren't null, and stay in the chain or not; both are told before either changes."""
        live = F.col("_live")
        got = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
        self.put(_reasons=F.when(live, F.concat("_reasons", got)).otherwise(F.col("_reasons")), _live=live & F.coalesce(stays, F.lit(False)))

    def discards(self) -> DataFrame:
        return self.df.select(*self.keep, F.explode("_reasons").alias("reason"))

    def live(self, *columns: Column | str) -> DataFrame:
        return self.df.where("_live").select(*self.keep, *columns)


def _in_range() -> Column:
    return (F.abs("latitude") <= 90) & (F.abs("longitude") <= 180)


def _cleaned(pings: DataFrame, ties: Sequence[str], slice_s: float | None) -> _Chain:
    """Reports in range of vessels with more than one, their count ``_m``, the next one as ``_next``, and ``_dup``."""
    chain = _Chain(pings, ties, slice_s)
    one = F.lit(1).cast("long")
    chain.add(totals={"_n": one})
    chain.step((F.col("_n") > 1) & _in_range(), F.when(F.col("_n") == 1, STRANDED).when(~F.coalesce(_in_range(), F.lit(True)), OUT_OF_RANGE))
    chain.add(totals={"_m": one}, shifts={"_next": (F.struct(*PING_COLUMNS[1:]), 1)})
    chain.put(_dup=(F.col("time") == F.col("_next.time")) | ((F.col("latitude") == F.col("_next.latitude")) & (F.col("longitude") == F.col("_next.longitude"))))
    return chain


def point_to_point(pings: DataFrame, max_elapsed_s: float, ties: Sequence[str] = (), slice_s: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Pairs of following reports (columns of the second end in 2) numbered from 0 for each vessel, and the discards.

    A pair with equal times or equal places is a duplicate; one more than ``max_elapsed_s`` apart is cut. Both ends of
    such pairs are reported. A report that is alone, at first or once others are out of range, is stranded. ``slice_s``
    spreads a vessel over tasks, by slices of so many seconds; the result is the same, but the steps are run at once (see
    ``hot_vessels``).
    """
    chain = _cleaned(pings, ties, slice_s)
    chain.put(_late=~F.col("_dup") & (geo.elapsed_s("time", "_next.time") > max_elapsed_s))
    chain.add(shifts={"_was_dup": (F.col("_dup"), -1), "_was_late": (F.col("_late"), -1)})
    chain.step(
        F.col("_next").isNotNull() & ~F.col("_dup") & ~F.col("_late"),
        F.when(F.col("_m") == 1, STRANDED), F.when(F.col("_dup"), DUPLICATE[0]), F.when(F.col("_was_dup"), DUPLICATE[1]), F.when(F.col("_late"), LATE[0]), F.when(F.col("_was_late"), LATE[1]),
    )
    discards = chain.discards()
    chain.add(before={"segidx": F.lit(1).cast("long")})
    return chain.live("segidx", *[F.col(f"_next.{c}").alias(f"{c}2") for c in PING_COLUMNS[1:]]), discards


def hot_vessels(pings: DataFrame, run: Callable[[DataFrame, float | None], Sequence[DataFrame]], slice_s: float, share: int = 1 << 10) -> list[DataFrame]:
    """``run(reports, slice_s)`` with slices for vessels with more than 1 / ``share`` of all reports, and without (None) for
    the others; the union of both, result by result."""
    counts = pings.groupBy("mmsi").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") > total / share).select(F.col("mmsi").alias("_hot"))  # share vessels at most
    both = [run(pings.join(F.broadcast(hot), F.col("mmsi").eqNullSafe(F.col("_hot")), how), s) for how, s in (("left_anti", None), ("left_semi", slice_s))]
    return [a.unionByName(b) for a, b in zip(*both, strict=True)]


def build_segments(pairs: DataFrame, epsg: int = 4326, min_kts: float = MIN_KTS, max_kts: float = MAX_KTS, export: bool = False) -> DataFrame:
    """Two-point lines with length, elapsed time and implied speed; those at or outside the bounds are left out."""
    metres = geo.step_m("longitude", "latitude", "longitude2", "latitude2", epsg)
    x1, y1 = geo.project_point("longitude", "latitude", epsg)
    x2, y2 = geo.project_point("longitude2", "latitude2", epsg)
    out = pairs.withColumn("_m", metres).withColumn("elp_sec", geo.elapsed_s("time", "time2")).withColumn("distspdkts", geo.speed_kts("_m", "elp_sec"))
    out = out.where((F.col("distspdkts") > min_kts) & (F.col("distspdkts") < max_kts))
    out = out.select(
        F.col("segidx").alias("track_id"), "mmsi", "elp_sec", F.col("time").alias("st_date"), F.col("time2").alias("en_date"), F.col("sog").alias("sogpt1"), F.col("sog2").alias("sogpt2"),
        ((F.col("sog") + F.col("sog2")) / 2).alias("avg_sog"), "distspdkts", (F.col("_m") / 1000).alias("seg_len_km"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), geo.segment_wkt(x1, y1, x2, y2).alias("wkt"),
    )
    return _exported(out, ("sogpt1", "sogpt2", "avg_sog", "distspdkts"), ("seg_len_km",)) if export else out


def _exported(df: DataFrame, one: Sequence[str], six: Sequence[str]) -> DataFrame:
    """Rounded as a line layer stores them."""
    return df.withColumns({c: F.round(c, 1) for c in one} | {c: F.round(c, 6) for c in six} | {"elp_sec": F.col("elp_sec").cast("long")})


def threshold_points(pings: DataFrame, separation_s: float, max_kph: float, ties: Sequence[str] = (), slice_s: float | None = None, shifted_ends: bool = False) -> tuple[DataFrame, DataFrame]:
    """Points of tracks with ``segidx``, and the discards.

    Reports are cleaned of duplicates (both ends reported; a run's last report stays) and of middle points that are too
    fast to and from; then a track ends where the next report is slower than 0.5 knots away or later than
    ``separation_s``, and points between two such stops are stranded. Vessels with fewer than three points left at any
    step don't have enough.

    With ``shifted_ends``, the older rule for fast points at either end holds: the points kept are the good middle ones
    and the neighbours of the first and last of these. So a fast second point is reported and yet becomes the first, and
    the true first is lost without a report; the same at the end. A vessel without a good middle point doesn't have
    enough. ``slice_s`` as in ``point_to_point``.
    """
    chain = _cleaned(pings, ties, slice_s)
    one = F.lit(1).cast("long")
    # the first of each good pair, and the second of the last
    chain.put(_first=F.col("_next").isNotNull() & ~F.coalesce("_dup", F.lit(False)))
    first = F.col("_first").cast("long")
    chain.add(shifts={"_was_dup": (F.col("_dup"), -1), "_was_first": (F.col("_first"), -1)}, totals={"_firsts": first}, before={"_seen": first})
    enough = F.col("_m") >= 3
    end = F.coalesce("_was_first", F.lit(False)) & ~F.col("_first") & (F.col("_seen") == F.col("_firsts"))
    chain.step(enough & (F.col("_first") | end), F.when(~enough, FEW), F.when(enough & F.col("_dup"), DUPLICATE[0]), F.when(enough & F.col("_was_dup"), DUPLICATE[1]))
    place = F.struct("time", "longitude", "latitude")
    chain.add(totals={"_k": one}, shifts={"_a": (place, -1), "_b": (place, 1)})
    limit = max_kph / 3600
    speed = lambda a, b: geo.km_per_s(geo.haversine_km(f"{a}longitude", f"{a}latitude", f"{b}longitude", f"{b}latitude"), geo.elapsed_s(f"{a}time", f"{b}time"))
    chain.put(_fast=F.coalesce((speed("_a.", "") > limit) & (speed("", "_b.") > limit), F.lit(False)))
    enough, stays = F.col("_k") >= 3, ~F.col("_fast")
    if shifted_ends:
        chain.put(_good=F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("_fast"))
        good = F.col("_good").cast("long")
        chain.add(shifts={"_next_good": (F.col("_good"), 1), "_was_good": (F.col("_good"), -1)}, totals={"_goods": good}, before={"_had": good})
        head = F.coalesce("_next_good", F.lit(False)) & (F.col("_had") == 0)
        tail = F.coalesce("_was_good", F.lit(False)) & (F.col("_had") == F.col("_goods"))
        stays = F.when(F.col("_goods") == 0, stays).otherwise(F.col("_good") | head | tail)
    chain.step(enough & stays, F.when(~enough, FEW), F.when(enough & F.col("_fast"), FAST))
    chain.add(totals={"_left": one}, shifts={"_b": (place, 1)})
    gap = geo.elapsed_s("time", "_b.time")
    slow = geo.speed_kts(geo.haversine_m("longitude", "latitude", "_b.longitude", "_b.latitude"), gap) < MIN_KTS
    chain.put(_stop=F.coalesce(slow | (gap > separation_s), F.lit(False)))
    chain.add(shifts={"_was_stop": (F.col("_stop"), -1)})
    chain.put(_prev=F.coalesce("_was_stop", F.lit(True)))
    chain.add(before={"segidx": (F.col("_stop") & ~F.col("_prev")).cast("long")})
    enough = F.col("_left") >= 3
    stranded = F.col("_prev") & (F.col("_stop") | F.col("_b").isNull())
    chain.step(enough & ~stranded, F.when(~enough, FEW), F.when(enough & stranded, STOPPED))
    return chain.live("segidx"), chain.discards()


def build_tracks(points: DataFrame, epsg: int = 4326, ties: Sequence[str] = (), export: bool = False) -> DataFrame:
    """A row for each vessel and segidx (as track_id), with counts, times, speeds and length. NaN speeds are left out of the
    means. No row holds a track's points: geometry is in ``track_chunks``, and ``track_lines`` joins it for export."""
    w = Window.partitionBy("mmsi", "segidx").orderBy(*VESSEL_ORDER, *ties)
    sog = F.nullif(F.col("sog"), F.lit(float("nan")))
    steps = points.withColumn("_step", geo.step_m(F.lag("longitude").over(w), F.lag("latitude").over(w), "longitude", "latitude", epsg))
    out = steps.groupBy("mmsi", "segidx").agg(F.count(F.lit(1)).cast("int").alias("seg_pts"), F.min("time").alias("st_date"), F.max("time").alias("en_date"), F.avg(sog).alias("avg_sog"), F.median(sog).alias("med_sog"), F.coalesce(F.sum("_step"), F.lit(0.0)).alias("_m"))
    out = out.withColumn("elp_sec", geo.elapsed_s("st_date", "en_date"))
    out = out.select(F.col("segidx").alias("track_id"), "mmsi", "elp_sec", "seg_pts", "st_date", "en_date", "avg_sog", "med_sog", geo.speed_kts("_m", "elp_sec").alias("dstspdkts"), (F.col("_m") / 1000).alias("seg_len_km"))
    return _exported(out, ("avg_sog", "med_sog", "dstspdkts"), ("seg_len_km",)) if export else out


#: Edges of a chunk of a track.
CHUNK = 4096


def track_chunks(points: DataFrame, epsg: int = 4326, ties: Sequence[str] = (), size: int = CHUNK) -> DataFrame:
    """mmsi, track_id, chunk (from 0) and ``vertices`` (x, y): a track in pieces of ``size`` edges.

    A piece ends in the vertex that the next one begins with, so the pieces' edges are the track's, each once. A track
    of one point is a piece of one vertex.
    """
    w = Window.partitionBy("mmsi", "segidx").orderBy(*VESSEL_ORDER, *ties)
    x, y = geo.project_point("longitude", "latitude", epsg)
    placed = points.select("mmsi", "segidx", (F.row_number().over(w) - 1).alias("_i"), x.alias("x"), y.alias("y"))
    own = F.floor(F.col("_i") / size).cast("int")
    placed = placed.withColumn("_last", F.lead("_i").over(Window.partitionBy("mmsi", "segidx").orderBy("_i")).isNull())
    # a piece's first vertex is also the last of the one before; a track's last vertex begins none
    both = F.when((F.col("_i") % size == 0) & (F.col("_i") > 0), F.when(F.col("_last"), F.array(own - 1)).otherwise(F.array(own - 1, own))).otherwise(F.array(own))
    pieces = placed.withColumn("chunk", F.explode(both)).groupBy("mmsi", F.col("segidx").alias("track_id"), "chunk")
    return pieces.agg(F.sort_array(F.collect_list(F.struct("_i", "x", "y"))).alias("_v")).select("mmsi", "track_id", "chunk", F.transform("_v", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("vertices"))


def track_lines(tracks: DataFrame, chunks: DataFrame) -> DataFrame:
    """The tracks with their line's text, for export: here a row does hold all of a track's points, as the format asks."""
    text = F.array_join(F.transform("vertices", lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))), ", ")
    rest = F.when(F.col("chunk") > 0, F.expr("slice(vertices, 2, size(vertices))")).otherwise(F.col("vertices"))
    lines = chunks.withColumn("vertices", rest).select("mmsi", "track_id", F.struct("chunk", text.alias("t")).alias("_c"))
    lines = lines.groupBy("mmsi", "track_id").agg(F.concat(F.lit("LINESTRING ("), F.array_join(F.sort_array(F.collect_list("_c"))["t"], ", "), F.lit(")")).alias("wkt"))
    return tracks.join(lines, ["mmsi", "track_id"])


def discard_summary(discards: DataFrame) -> DataFrame:
    return discards.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
