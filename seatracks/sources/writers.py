"""Writers: messages, base tables, reports by vessel, lines and overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators.normalize import group_columns


def format_messages(df: DataFrame, form: str = "json") -> DataFrame:
    """One text column ``value``: JSON, or fields delimited by | with the date first."""
    fields = [c for c in df.columns if c not in ("path", "line_no", "raw")]
    if form == "json":
        return df.select(F.to_json(F.struct(*fields)).alias("value"))
    if form != "dsv":
        raise ValueError("form is json or dsv")
    return df.select(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]).alias("value"))


def message_group(msgtype: Column) -> Column:
    """Types with one layout share a group."""
    return F.when(msgtype.isin(1, 2, 3), "1_2_3").when(msgtype.isin(4, 11), "4_11").when(msgtype.isin(7, 13), "7_13").otherwise(msgtype.cast("string"))


def write_by_message(df: DataFrame, path: str, form: str = "dsv", map_similar: bool = True) -> None:
    group = message_group(F.col("msgtype")) if map_similar else F.col("msgtype").cast("string")
    fields = [c for c in df.columns if c not in ("path", "line_no", "raw")]
    value = F.to_json(F.struct(*fields)) if form == "json" else F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields])
    df.select(value.alias("value"), group.alias("msg_group")).write.partitionBy("msg_group").mode("append").text(path)


def write_base_rows(rows: DataFrame, path: str, cluster: bool = True) -> None:
    """All groups of ``ee_rows`` by group and month in one pass; ``cluster`` deals and orders rows by place (whole degrees,
    then line), so that a range of coordinates skips files and row groups."""
    out = rows.withColumn("month", F.coalesce(F.date_format("time", "yyyy-MM"), F.lit("none")))
    if cluster:
        order = ("msg_group", "month", "_x", "_y", "longitude", "lineno")
        out = out.withColumns({"_x": F.floor("longitude"), "_y": F.floor("latitude")}).repartitionByRange(*order).sortWithinPartitions(*order).drop("_x", "_y")
    out.write.partitionBy("msg_group", "month").mode("append").parquet(path)


def read_base_rows(spark: SparkSession, path: str, group: str, first_month: str | None = None, last_month: str | None = None, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """A group's base table from ``write_base_rows``: months as yyyy-MM, both inclusive, and a box of least and greatest
    longitude and latitude. Other groups and months aren't listed, other places' row groups not read."""
    out = spark.read.parquet(path).where(F.col("msg_group") == group)
    if first_month:
        out = out.where(F.col("month") >= first_month)
    if last_month:
        out = out.where(F.col("month") <= last_month)
    if box:
        out = out.where(F.col("longitude").between(box[0], box[1]) & F.col("latitude").between(box[2], box[3]))
    return out.select(*[F.col(f"`{c}`") for c in group_columns(group)])


def write_base_tables(tables: dict[str, DataFrame], path: str, form: str = "parquet", cluster: bool = True) -> None:
    """Each table by month, in a folder of its own; ``cluster`` orders the files by place, so that ranges of coordinates skip
    row groups. ``form="csv"`` has the delimiters that the loaders of such tables expect."""
    for name, df in tables.items():
        out = df.withColumn("month", F.date_format("time", "yyyy-MM"))
        if cluster and "longitude" in out.columns:
            lon, lat = (F.round(F.col(c).try_cast("double")) for c in ("longitude", "latitude"))
            out = out.withColumn("_x", lon).withColumn("_y", lat).repartitionByRange("month", "_x", "_y").sortWithinPartitions("month", "_x", "_y", "lineno").drop("_x", "_y")
        writer = out.write.partitionBy("month").mode("append")
        if form == "parquet":
            writer.parquet(f"{path}/{name}")
        else:
            writer.option("sep", "\t" if name == "other" else "|").option("quote", "~" if name in ("5", "24") else '"').option("header", True).csv(f"{path}/{name}")


def write_by_vessel(df: DataFrame, path: str) -> None:
    """Files hold whole vessels in order of time, many to a file."""
    df.repartition("mmsi").sortWithinPartitions("mmsi", "time").write.mode("append").parquet(path)


def write_segments(points: DataFrame, discards: DataFrame, path: str) -> None:
    points.write.mode("append").parquet(f"{path}/points")
    discards.write.mode("append").parquet(f"{path}/discards")


def as_geojson(df: DataFrame, wkt: str = "wkt", vertices: str | None = None) -> DataFrame:
    """A feature for each line, as text column ``value``."""
    v = F.col(vertices) if vertices else geo.wkt_to_vertices(wkt)
    geometry = F.struct(F.lit("LineString").alias("type"), F.transform(v, lambda p: F.array(p["x"], p["y"])).alias("coordinates"))
    properties = F.struct(*[c for c in df.columns if c not in (wkt, vertices)])
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))).alias("value"))


def write_lines(df: DataFrame, path: str, fmt: str = "parquet_wkt") -> None:
    if fmt == "parquet_wkt":
        df.write.mode("append").parquet(path)
    elif fmt == "geojsonl":
        as_geojson(df).write.mode("append").text(path)
    else:
        raise ValueError("fmt is parquet_wkt or geojsonl")


def track_points(df: DataFrame) -> DataFrame:
    """The vertices of the older layers as points: ``wkt`` of x and y, null where one is missing."""
    return df.select("track_id", "mmsi", "time", "sog", "bad_spd", F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), geo.point_wkt("x", "y")).alias("wkt"))


def write_overlay(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("append").csv(path)
