"""Provider rows to base tables and to position reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import as_pings

#: Where the fields of the neutral order come from in the decoder's output; - is always empty.
_NONE = "- - - - - - - - -"
REPACK = {
    (1, 2, 3): (16, f"3 1 2 0 {_NONE} 4 5 6 7 8 9 10 11 13 14 15 12 -"),
    (5,): (21, f"3 1 2 0 {_NONE} 7 6 5 8 9 10 11 12 18 19 4 13 - 14 15 16 17 - 20 - - -"),
    (18,): (21, f"3 1 2 0 {_NONE} - - - - - - 5 6 7 8 9 10 - 19 - 20 11 - - 18 13 14 15 16 17 4 12"),
}
#: Columns of the base tables of each group, after the row's identity and the columns all share.
SHARED = "mmsi message_id repeat_indicator time millisecond region country base_station online_data group_code sequence_id channel data_length".split()
GROUPS = {
    "1_2_3": ((1, 2, 3), "navigational_status rot sog accuracy longitude latitude cog heading maneuver raim_flag communication_state utc_second spare"),
    "5": ((5,), "vessel_name call_sign imo ship_type dimension_to_bow dimension_to_stern dimension_to_port dimension_to_starboard draught destination ais_version fixing_device transmission_control eta_month eta_day eta_hour eta_minute sequence data_terminal mode spare spare2"),
    "18": ((18,), "sog accuracy longitude latitude cog heading utc_second unit_flag display dsc band msg22 mode raim_flag communication_flag communication_state spare spare2"),
    "24": ((24,), "vessel_name call_sign imo ship_type dimension_to_bow dimension_to_stern dimension_to_port dimension_to_starboard fixing_device part_number vendor_id mother_ship_mmsi spare"),
    "27": ((27,), "navigational_status sog accuracy longitude latitude cog raim_flag gnss_status spare"),
}
#: What follows the shared columns in the packed text of the other types.
PACKED = {
    (4, 11): "accuracy longitude latitude raim_flag communication_state utc_year utc_month utc_day utc_hour utc_minute utc_second fixing_device transmission_control spare",
    (6,): "sequence destination_id retransmit_flag country_code functional_id data spare",
    (7, 13): "destination_id_1 sequence_1 destination_id_2 sequence_2 destination_id_3 sequence_3 destination_id_4 sequence_4 spare",
    (8,): "country_code functional_id data spare",
    (9,): "sog accuracy longitude latitude cog raim_flag communication_flag communication_state utc_second altitude altitude_sensor data_terminal mode spare",
    (10,): "regional destination_id spare",
    (12,): "sequence destination_id retransmit_flag safety_text non-standard_bits spare",
    (14,): "safety_text non-standard_bits name_extension spare spare2",
    (15,): "destination_id_1 destination_id_2 message_id_1_1 offset_1_1 message_id_1_2 offset_1_2 message_id_2_1 offset_2_1 spare",
    (16,): "destination_id_a offset_a increment_a destination_id_b offsetb incrementb spare",
    (17,): "longitude latitude regional data data_msg_type station_id z_count num_data_words health spare",
    (19,): "vessel_name ship_type dimension_to_bow dimension_to_stern dimension_to_port dimension_to_starboard sog accuracy longitude latitude cog heading regional raim_flag communication_flag communication_state utc_second fixing_device data_terminal mode unit_flag display dsc band msg22 spare spare2",
    (20,): "offset1 num_slots1 timeout1 increment_1 offset_2 number_slots_2 timeout_2 increment_2 offset_3 number_slots_3 timeout_3 increment_3 offset_4 number_slots_4 timeout_4 increment_4 spare",
    (21,): "dimension_to_bow dimension_to_stern dimension_to_port dimension_to_starboard accuracy longitude latitude raim_flag utc_second fixing_device mode name_extension name_extension_padding aton_type aton_name off_position aton_status virtual_aton channel_a spare spare2",
    (22,): "channel_a channel_b tx_rx_mode power message_indicator channel_a_bandwidth channel_b_bandwidth transzone_size longitude_1 latitude_1 longitude_2 latitude_2 spare",
    (23,): "ship_type tx_rx_mode longitude_1 latitude_1 longitude_2 latitude_2 station_type report_interval quiet_time spare",
    (25,): "destination_id country_code functional_id data destination_indicator binary_flag",
    (26,): "communication_flag communication_state destination_id country_code functional_id data destination_indicator binary_flag",
}


def is_int32(c: Column) -> Column:
    return c.try_cast("long").isNotNull() & (F.abs(c.try_cast("long")) < 2**31)


def is_float(c: Column) -> Column:
    return c.try_cast("double").isNotNull()


def fix_exponent(c: Column) -> Column:
    """``1.2E+1.0`` is ``1.2E+1``."""
    return F.regexp_replace(c, r"(E\+[12])\.0$", "$1")


def parse_ais_time(c: Column, fmt: str = "T") -> Column:
    """``T``: yyyyMMddTHHmmss.SSSZ of exactly 20 characters; ``_``: yyyyMMdd_HHmmss; ``round``: either, to the nearest
    second. Null otherwise."""
    if fmt == "T":
        return F.when((F.length(c) == 20) & c.rlike(r"^\d{8}.\d{6}"), F.try_to_timestamp(F.concat(F.substring(c, 1, 8), F.substring(c, 10, 6)), F.lit("yyyyMMddHHmmss")))
    if fmt == "_":
        return F.try_to_timestamp(F.regexp_extract(c, r"^(\d{8}_\d{6})", 1), F.lit("yyyyMMdd_HHmmss"))
    whole = F.try_to_timestamp(F.concat(F.substring(c, 1, 8), F.substring(c, 10, 6)), F.lit("yyyyMMddHHmmss"))
    part = F.coalesce(F.regexp_extract(c, r"(\.\d+)", 1).try_cast("double"), F.lit(0.0))
    return F.timestamp_seconds(F.unix_timestamp(whole) + F.round(part).cast("long"))


def ewkt(lon: Column, lat: Column) -> Column:
    """Null out of range."""
    return F.when(lon.between(-180, 180) & lat.between(-90, 90), F.concat(F.lit("SRID=4326;POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")))


def _tok(i: int) -> Column:
    return F.get("tok", F.lit(i))


def normalize_dsv(df: DataFrame, source: str, datafile_date: str, station: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (id, mmsi, lon, lat, time, message_id, errorflag, packed) of the decoder's output, and rejects.

    Types 1-3, 5 and 18 are kept; rows too short for their type keep their raw text with an error flag. An id is the
    source's prefix with the line number.
    """
    if source == "tower":
        if station not in tuple("CDGHMR"):
            raise ValueError("a tower's station is one of C, D, G, H, M, R")
        prefix = f"T{station}{datafile_date}_"
    elif source == "onc":
        prefix = f"OV{datafile_date}_"
    else:
        raise ValueError("source is onc or tower")
    t = _tok(1).try_cast("int")
    need = reduce(lambda a, k: a.when(t.isin(*k), REPACK[k][0]), REPACK, F.when(F.lit(False), F.lit(0)))
    packed = reduce(lambda a, k: a.when(t.isin(*k), F.concat_ws("|", *[F.lit("") if i == "-" else F.coalesce(_tok(int(i)), F.lit("")) for i in REPACK[k][1].split()])), REPACK, F.when(F.lit(False), F.lit("")))
    out = df.withColumn("_t", t).withColumn("_need", need)
    rejects = out.where("_need is null").select("path", "line_no", "line", F.when(F.col("_t").isNull(), "unreadable type").otherwise("unhandled type").alias("reject_reason"))
    out = out.where("_need is not null").withColumn("_short", F.size("tok") < F.col("_need"))
    whole = lambda c: F.when(~F.col("_short"), c)
    at = lambda a, b: F.when(F.col("_t") == 18, fix_exponent(_tok(b))).when(F.col("_t") != 5, fix_exponent(_tok(a))).try_cast("double")
    lon, lat, mmsi, time = at(8, 7), at(9, 8), F.when(is_int32(_tok(3)), _tok(3).try_cast("long")), parse_ais_time(_tok(0))
    bad = F.col("_short") | mmsi.isNull() | time.isNull() | ((F.col("_t") != 5) & (lon.isNull() | lat.isNull()))
    return out.select(
        F.concat(F.lit(prefix), F.col("line_no").cast("string")).alias("id"), whole(mmsi).alias("mmsi"), whole(lon).alias("lon"), whole(lat).alias("lat"), whole(time).alias("time"), whole(F.col("_t")).alias("message_id"),
        F.coalesce(bad, F.lit(True)).cast("int").alias("errorflag"), F.when(F.col("_short"), F.trim("line")).otherwise(packed).alias("packed"),
    ), rejects


def ee_rows(df: DataFrame) -> DataFrame:
    """The provider's rows in one pass: ``msg_group``, identity (unq_id_prefix, lineno, errorflag), all columns of any group
    (null where a group lacks them), the point as ``WKT`` and for the other types the packed text.

    Coordinates that can't be read are null, with an error flag.
    """
    date = F.regexp_replace(F.regexp_extract("path", r"(\d{4}-?\d{2}-?\d{2})[^/]*$", 1), "-", "")
    t = F.col("message_id").try_cast("int")
    lon, lat = (fix_exponent(F.col(c)).try_cast("double") for c in ("longitude", "latitude"))
    group = reduce(lambda a, g: a.when(t.isin(*GROUPS[g][0]), g), GROUPS, F.when(F.lit(False), F.lit(""))).otherwise("other")
    ready = df.withColumns({"_t": t, "msg_group": group, "orig_date": F.col("time"), "unq_id_prefix": F.concat(F.lit("SE"), date), "lineno": F.col("line_no")})
    ready = ready.withColumn("errorflag", ((F.col("longitude").isNotNull() & lon.isNull()) | (F.col("latitude").isNotNull() & lat.isNull())).cast("int"))
    ready = ready.withColumns({"longitude": lon, "latitude": lat, "mmsi": F.col("mmsi").try_cast("long"), "time": parse_ais_time(F.col("time"), "_")})
    other, columns = F.col("msg_group") == "other", []
    for name in dict.fromkeys([*SHARED, *(c for _, own in GROUPS.values() for c in own.split())]):
        has = [g for g, (_, own) in GROUPS.items() if name in SHARED or name in own.split()]
        c = F.col(f"`{name}`").try_cast("double") if name in ("rot", "sog", "cog", "heading") else F.col(f"`{name}`")
        kept = F.col("msg_group").isin(*has) | other if name in ("mmsi", "time", "message_id") else F.col("msg_group").isin(*has)
        columns.append(F.when(kept, c).alias(name))
    placed = [g for g, (_, own) in GROUPS.items() if "longitude" in own.split()]
    point = F.when(F.col("msg_group").isin(*placed), ewkt(F.col("longitude"), F.col("latitude")))
    return ready.select("msg_group", "unq_id_prefix", "lineno", "errorflag", *columns, point.alias("WKT"), F.when(other, pack_other(F.col("_t"), ready.drop("msg_group").columns)).alias("ais_msg_eecsv"))


def group_columns(group: str) -> list[str]:
    """The columns of a group's base table."""
    if group == "other":
        return ["unq_id_prefix", "lineno", "errorflag", "mmsi", "time", "message_id", "ais_msg_eecsv"]
    own = GROUPS[group][1].split()
    return ["unq_id_prefix", "lineno", "errorflag", *SHARED, *own, *(["WKT"] if "longitude" in own else [])]


def split_ee(df: DataFrame) -> dict[str, DataFrame]:
    """A table for each message group of the provider's rows, as views of ``ee_rows``: identity, shared and own columns, and
    the point. To write all of them in one pass, give ``ee_rows`` to the writer."""
    rows = ee_rows(df)
    return {g: rows.where(F.col("msg_group") == g).select(*[F.col(f"`{c}`") for c in group_columns(g)]) for g in (*GROUPS, "other")}


def pack_other(t: Column, columns: list[str]) -> Column:
    """The packed text of a row by its type; all of the provider's columns for an unknown one; nulls are empty."""
    def text(names: list[str]) -> Column:
        return F.concat_ws("|", *[F.coalesce(F.when(F.col(f"`{c}`").cast("string") != "nan", F.col(f"`{c}`").cast("string")), F.lit("")) for c in names])

    shared = ["orig_date" if c == "time" else c for c in SHARED]
    skip = {"path", "line_no", "_t", "orig_date", "unq_id_prefix", "lineno", "errorflag", *SHARED}
    out = F.when(F.lit(False), F.lit(""))
    for types, own in PACKED.items():
        out = out.when(t.isin(*types), text([*shared, *own.split()]))
    return out.otherwise(text([*shared, *[c for c in columns if c not in skip]]))


#: Of each source and message types, the tokens of time, type, mmsi, status, sog, cog, heading, latitude, longitude.
POSITIONS = {
    "base": {(1, 2, 3): "3 1 0 13 15 19 20 18 17", (18, 19): "3 1 0 - 19 23 24 22 21", (27,): "3 1 0 13 14 18 - 17 16"},
    "dsv": {(1, 2, 3): "0 1 3 4 6 10 11 9 8", (18, 19): "0 1 3 - 5 9 10 8 7", (27,): "0 1 3 6 9 10 - 8 7"},
}


def parse_sog(c: Column) -> Column:
    return F.when(c.isNull() | c.isin("n/a", "None", ""), 102.3).when(c == "fast", 102.2).otherwise(c.try_cast("double"))


def parse_cog(c: Column) -> Column:
    return F.when(c.isNull() | c.isin("n/a", "None", ""), 360.0).otherwise(c.try_cast("double"))


def parse_heading(c: Column) -> Column:
    return F.when(c.isNull() | c.isin("n/a", "None", ""), 511.0).otherwise(c.try_cast("double"))


def to_pings(df: DataFrame, source: str) -> DataFrame:
    """Position reports of token rows (``tok``) of a base export or of the decoder's output; rows with eight fields or
    fewer are left out."""
    out = None
    for types, spec in POSITIONS[source].items():
        time, kind, mmsi, status, sog, cog, heading, lat, lon = (F.lit(None).cast("string") if i == "-" else F.trim(_tok(int(i))) for i in spec.split())
        part = df.where((F.size("tok") > 8) & kind.try_cast("int").isin(*types)).select(
            mmsi.try_cast("long").alias("mmsi"), F.coalesce(parse_ais_time(time, "round"), F.try_to_timestamp(time)).alias("time"), kind.try_cast("int").alias("message_id"), status.try_cast("int").alias("navigational_status"),
            parse_sog(sog).alias("sog"), parse_cog(cog).alias("cog"), parse_heading(heading).alias("heading"), fix_exponent(lat).try_cast("double").alias("latitude"), fix_exponent(lon).try_cast("double").alias("longitude"),
        )
        out = part if out is None else out.unionByName(part)
    return as_pings(out)


def voyages(df: DataFrame) -> DataFrame:
    """Rows of static voyage data."""
    return df.where(F.col("message_id").try_cast("int") == 5)


def split_valid_mmsi(df: DataFrame, column: str = "mmsi") -> tuple[DataFrame, DataFrame]:
    """Rows whose vessel number is one, and the others (with / replaced, as it can't be in a name)."""
    number = F.col(column).cast("string").try_cast("long")
    return df.where(number.isNotNull()).withColumn(column, number), df.where(number.isNull()).withColumn(column, F.regexp_replace(F.col(column).cast("string"), "/", "_"))
