"""Queries that write files of every kind and read them back, over rows made from the reports of ``pings``; and the same in
DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decode as D
from ..operators import normalize as N
from ..operators import segment as S
from ..schema import PING_COLUMNS
from ..shared import shared_dir
from ..sources import readers as R
from ..sources import writers as W
from .messages import _GOOD, _dsv, _ee, _packets
from .pings import PINGS, pings
from .tracks import _BASE, _DISCARDS, _GRID, _SEGMENTS, GAP_S, TIES, VALUE_BITS, _bits_sql, _interp_time, _lines, _to_bits

#: A station's prefix of the tower's ids.
STATION, DAY = "H", "20150101"


def q_ee_csv_rows(spark: SparkSession, d: str) -> DataFrame:
    """The provider's CSV written and read: all groups' rows. Empty, None and none are no values."""
    home = f"{shared_dir(spark)}/ee"
    none = F.when(F.col("line_no") % 3 == 0, "None").when(F.col("line_no") % 3 == 1, "none").otherwise("NS, \"east\"")
    _ee(spark, d).withColumns({"region": none, "country": F.lit(None).cast("string")}).drop("path", "line_no").write.option("header", True).option("quote", '"').option("escape", '"').csv(home)
    rows = N.ee_rows(R.read_ee_csv(spark, home))
    return rows.select("msg_group", "mmsi", "time", "message_id", "region", "country", "sog", "longitude", "latitude", "errorflag")


def q_dsv_file_pings(spark: SparkSession, d: str) -> DataFrame:
    """The decoder's output written as text and read; reports of it, short rows with what they have."""
    home = f"{shared_dir(spark)}/dsv"
    _dsv(spark, d).select(F.col("line").alias("value")).write.text(home)
    return N.to_pings(R.read_dsv(spark, home), "dsv").select(*PING_COLUMNS)


def _tower(spark: SparkSession, d: str) -> DataFrame:
    return N.normalize_dsv(_dsv(spark, d), "tower", DAY, STATION)[0]


def q_tower_packed(spark: SparkSession, d: str) -> DataFrame:
    """A tower's rows with their packed text; short rows have the raw one."""
    return _tower(spark, d).select("id", "packed", "errorflag")


def q_base_export_pings(spark: SparkSession, d: str) -> DataFrame:
    """A tower's good rows exported with tabs, read, and turned into reports by the packed text."""
    home = f"{shared_dir(spark)}/export"
    fields = ["id", "mmsi", "lon", "lat", "time", "message_id", "errorflag", "packed"]
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields])
    _tower(spark, d).where("errorflag = 0").select(line.alias("value")).write.text(home)
    return N.to_pings(R.read_base_export(spark, home), "base").select(*PING_COLUMNS)


def q_pings_csv(spark: SparkSession, d: str) -> DataFrame:
    """Reports as CSV with a time zone after the time, and a column that nothing reads."""
    home = f"{shared_dir(spark)}/pings"
    time = F.concat(F.date_format("time", "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))
    pings(spark, d).withColumn("time", time).select("event_id", *reversed(PING_COLUMNS)).write.option("header", True).csv(home)
    return R.read_pings_csv(spark, home).select(*PING_COLUMNS)


def q_voyage_rows(spark: SparkSession, d: str) -> DataFrame:
    """The provider's rows of static voyage data."""
    return N.voyages(N.ee_rows(_ee(spark, d))).select("lineno", "mmsi", "message_id", "time")


def q_vessel_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose vessel number is one, and the others; every seventeenth has a text there."""
    given = F.when(F.col("event_id") % 17 == 0, F.concat(F.lit("n/a/"), F.col("mmsi"))).otherwise(F.col("mmsi").cast("string"))
    good, bad = N.split_valid_mmsi(pings(spark, d).select("event_id", given.alias("mmsi")))
    return good.select("event_id", F.col("mmsi").cast("string").alias("name"), F.lit(1).alias("valid")).unionByName(bad.select("event_id", F.col("mmsi").alias("name"), F.lit(0).alias("valid")))


def q_vessel_files(spark: SparkSession, d: str) -> DataFrame:
    """Reports written by vessel; of each vessel, how many files it is in, its rows, and whether they are in order of time."""
    home = f"{shared_dir(spark)}/vessels"
    W.write_by_vessel(pings(spark, d), home)
    rows = spark.read.parquet(home)
    return rows.groupBy("mmsi").agg(F.count_distinct("_metadata.file_path").alias("files"), F.count(F.lit(1)).alias("n"), F.min("time").alias("first"), F.max("time").alias("last"), F.sum("event_id").alias("ids"))


def q_segment_files(spark: SparkSession, d: str) -> DataFrame:
    """Points and discards written and read."""
    home = f"{shared_dir(spark)}/segments"
    W.write_segments(*S.point_to_point(pings(spark, d), GAP_S, TIES), home)
    points, discards = (spark.read.parquet(f"{home}/{k}") for k in ("points", "discards"))
    return points.select("event_id", "mmsi", F.lit("kept").alias("reason")).unionByName(discards.select("event_id", "mmsi", "reason"))


def q_line_files(spark: SparkSession, d: str) -> DataFrame:
    """Segments written as GeoJSON lines and read: ends and properties."""
    home = f"{shared_dir(spark)}/lines"
    lines = _lines(spark, d).select("mmsi", "track_id", "vertices")
    W.as_geojson(lines, vertices="vertices").write.text(home)
    feature = F.from_json("value", "type string, geometry struct<type: string, coordinates: array<array<double>>>, properties struct<mmsi: bigint, track_id: bigint>")
    f = spark.read.text(home).select(feature.alias("f")).select("f.*")
    at = lambda i, j: F.get(F.get("geometry.coordinates", F.lit(i)), F.lit(j))
    return f.select("type", F.col("geometry.type").alias("shape"), "properties.mmsi", "properties.track_id", F.size("geometry.coordinates").alias("points"), at(0, 0).alias("x1"), at(0, 1).alias("y1"), at(1, 0).alias("x2"), at(1, 1).alias("y2"))


def q_message_files(spark: SparkSession, d: str) -> DataFrame:
    """Decoded messages written by type as JSON and read: the group of types and the text."""
    home = f"{shared_dir(spark)}/messages"
    tables = D.decode(_packets(spark, d), types=(1, 5, 18))
    for layout in ("cnb", "type18", "type5"):
        W.write_by_message(tables[layout].select("date", "msgtype", "mmsi"), home, "json")
    return spark.read.text(home).select(F.col("msg_group").cast("string").alias("msg_group"), "value")


def q_overlay_files(spark: SparkSession, d: str) -> DataFrame:
    """The overlay's values and times written as CSV with a header and read."""
    home = f"{shared_dir(spark)}/overlay"
    W.write_overlay(_interp_time(spark, d).select("mmsi", "track_id", "grid_id", "interp", "interp_time"), home)
    rows = spark.read.option("header", True).schema("mmsi long, track_id long, grid_id long, interp double, interp_time timestamp").csv(home)
    return _to_bits(rows, interp=VALUE_BITS)


_WITH = f"WITH pings AS ({PINGS}) "
_DATE = "strftime(time, '%Y%m%dT%H%M%S') || '.000Z'"
_NAV = "coalesce(navigational_status::VARCHAR, '')"
_COLUMNS = ", ".join(PING_COLUMNS)
_HEAD = f"mmsi || '|' || message_id || '|0|' || {_DATE} || '|' || repeat('|', 9)"
_PACKED = f"""CASE WHEN message_id = 1 THEN {_HEAD} || {_NAV} || '|0|' || sog || '|1|' || longitude || '|' || latitude || '|' || cog || '|' || heading || '|0|1|7|30|'
ELSE {_HEAD} || repeat('|', 6) || sog || '|1|' || longitude || '|' || latitude || '|' || cog || '|' || heading || '||0||0|30|||0|0|0|0|0|0|0|0' END"""
_RAW = f"""CASE WHEN message_id = 1 THEN {_DATE} || '|1|0|' || mmsi || '|' || {_NAV} || '|0|' || sog || '|1|' || longitude
ELSE {_DATE} || '|18|0|' || mmsi || '|0|' || sog || '|1|' || longitude || '|' || latitude END"""

ORACLES = {
    "ee_csv_rows": _WITH + """SELECT CASE WHEN k IN (1, 2, 3) THEN '1_2_3' WHEN k IN (5, 18, 24, 27) THEN k::VARCHAR ELSE 'other' END AS msg_group, mmsi, time, k::VARCHAR AS message_id,
CASE WHEN event_id % 3 = 2 AND k IN (1, 2, 3, 5, 18, 24, 27) THEN 'NS, "east"' END AS region, NULL::VARCHAR AS country, CASE WHEN k IN (1, 2, 3, 18, 27) THEN sog END AS sog,
CASE WHEN event_id % 31 <> 0 AND k IN (1, 2, 3, 18, 27) THEN longitude END AS longitude, CASE WHEN k IN (1, 2, 3, 18, 27) THEN latitude END AS latitude, (event_id % 31 = 0)::INT AS errorflag
FROM (SELECT *, event_id % 27 + 1 AS k FROM pings)""",
    "dsv_file_pings": _WITH + """, s AS (SELECT *, event_id % 13 = 0 AS short FROM pings)
SELECT mmsi, time, message_id, CASE WHEN message_id = 1 THEN navigational_status END AS navigational_status, sog, CASE WHEN short THEN 360.0::DOUBLE ELSE cog END AS cog, CASE WHEN short THEN 511.0::DOUBLE ELSE heading END AS heading,
CASE WHEN NOT short OR message_id = 18 THEN latitude END AS latitude, longitude FROM s""",
    "tower_packed": _WITH + f"SELECT 'T{STATION}{DAY}_' || event_id AS id, CASE WHEN event_id % 13 = 0 THEN {_RAW} ELSE {_PACKED} END AS packed, (event_id % 13 = 0)::INT AS errorflag FROM pings",
    "base_export_pings": _WITH + f"SELECT {_COLUMNS} FROM pings WHERE event_id % 13 <> 0",
    "pings_csv": _WITH + f"SELECT {_COLUMNS} FROM pings",
    "voyage_rows": _WITH + "SELECT event_id AS lineno, mmsi, '5' AS message_id, time FROM pings WHERE event_id % 27 = 4",
    "vessel_numbers": _WITH + "SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'n_a_' ELSE '' END || mmsi AS name, (event_id % 17 <> 0)::INT AS valid FROM pings",
    "vessel_files": _WITH + "SELECT mmsi, 1::BIGINT AS files, count(*) AS n, min(time) AS first, max(time) AS last, sum(event_id)::BIGINT AS ids FROM pings GROUP BY mmsi",
    "segment_files": _BASE + f"SELECT event_id, mmsi, 'kept' AS reason FROM p2p UNION ALL ({_DISCARDS})",
    "message_files": _WITH + f"""SELECT CASE message_id WHEN 1 THEN '1_2_3' ELSE '18' END AS msg_group, '{{"date":"' || {_DATE} || '","msgtype":' || message_id || ',"mmsi":' || mmsi || '}}' AS value FROM pings WHERE {_GOOD}
UNION ALL SELECT '5', '{{"date":"' || {_DATE} || '","msgtype":5,"mmsi":' || mmsi || '}}' FROM pings WHERE event_id % 20 = 0""",
    "overlay_files": _BASE + _SEGMENTS + _GRID + f"SELECT mmsi, track_id, grid_id, {_bits_sql('interp', VALUE_BITS)} AS interp, to_timestamp(interp_s) AT TIME ZONE 'UTC' AS interp_time FROM inside WHERE t0 < t1",
    "line_files": _BASE + _SEGMENTS + "SELECT 'Feature' AS type, 'LineString' AS shape, mmsi, track_id, 2::INT AS points, x1, y1, x2, y2 FROM segs",
}

QUERIES = {k[2:]: v for k, v in list(globals().items()) if k.startswith("q_")}
