"""Readers: sentence logs, provider CSV, decoder output, base-table exports and position reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.carry import BLOCK, last_known
from ..schema import PING_COLUMNS, as_pings
from ..shared import shared_dir, written

#: The provider's columns, in order.
EE_COLUMNS = (
    "mmsi message_id repeat_indicator time millisecond region country base_station online_data group_code sequence_id channel data_length vessel_name call_sign imo ship_type dimension_to_bow dimension_to_stern "
    "dimension_to_port dimension_to_starboard draught destination ais_version navigational_status rot sog accuracy longitude latitude cog heading regional maneuver raim_flag communication_flag communication_state "
    "utc_year utc_month utc_day utc_hour utc_minute utc_second fixing_device transmission_control eta_month eta_day eta_hour eta_minute sequence destination_id retransmit_flag country_code functional_id data "
    "destination_id_1 sequence_1 destination_id_2 sequence_2 destination_id_3 sequence_3 destination_id_4 sequence_4 altitude altitude_sensor data_terminal mode safety_text non-standard_bits name_extension "
    "name_extension_padding message_id_1_1 offset_1_1 message_id_1_2 offset_1_2 message_id_2_1 offset_2_1 destination_id_a offset_a increment_a destination_id_b offsetb incrementb data_msg_type station_id z_count "
    "num_data_words health unit_flag display dsc band msg22 offset1 num_slots1 timeout1 increment_1 offset_2 number_slots_2 timeout_2 increment_2 offset_3 number_slots_3 timeout_3 increment_3 offset_4 number_slots_4 "
    "timeout_4 increment_4 aton_type aton_name off_position aton_status virtual_aton channel_a channel_b tx_rx_mode power message_indicator channel_a_bandwidth channel_b_bandwidth transzone_size longitude_1 latitude_1 "
    "longitude_2 latitude_2 station_type report_interval quiet_time part_number vendor_id mother_ship_mmsi destination_indicator binary_flag gnss_status spare spare2 spare3 spare4"
).split()


def numbered(df: DataFrame, *cols: str | Column) -> DataFrame:
    """``path``, ``line_no`` (from 1 in each file) and the given columns of a file-based table, in file order.

    The files are scanned once, into a table in the shared folder with each row's split and its order there. A row's place
    in its split plus the rows of the splits before it give the number; only counts of splits are shuffled.
    """
    rows = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"), *cols)
    rows = written(rows, f"{shared_dir(df.sparkSession)}/lines")
    per = rows.groupBy("path", "_b").agg(F.min("_i").alias("_i0"), F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("path").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("path").alias("_p2"), F.col("_b").alias("_b2"), (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_i0") + 1).alias("_add"))
    # a row for each split: 100 TB have less than a million of 128 MB
    out = rows.join(F.broadcast(per), (F.col("path") == F.col("_p2")) & (F.col("_b") == F.col("_b2")))
    return out.withColumn("line_no", F.col("_i") + F.col("_add")).drop("_b", "_i", "_p2", "_b2", "_add")


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, line_no and line of text files."""
    return numbered(spark.read.text(paths), F.rtrim(F.regexp_replace("value", "\r$", "")).alias("line"))


def sentences(lines: DataFrame, style: str = "dmas") -> DataFrame:
    """``date`` and ``sentence`` of each line: ``dmas`` has a date up to the first blank, ``ee`` a prefix up to the second
    backslash (whose time, if there is one, is the date)."""
    if style == "dmas":
        out = lines.withColumn("date", F.substring_index("line", " ", 1)).withColumn("sentence", F.trim(F.expr("substring(line, length(substring_index(line, ' ', 1)) + 2)")))
    elif style == "ee":
        prefix = F.substring_index("line", "\\", 2)
        out = lines.withColumn("date", F.regexp_replace(prefix, r"^\\", "")).withColumn("sentence", F.trim(F.substring_index("line", "\\", -1)))
    else:
        raise ValueError("style is dmas or ee")
    return out.drop("line")


def read_nm4(spark: SparkSession, paths: str | Sequence[str], style: str = "dmas") -> DataFrame:
    """path, line_no, date and sentence of NM4 files."""
    return sentences(read_lines(spark, paths), style)


def receiver_dates(lines: DataFrame, tz: str = "America/Halifax", block: int = BLOCK) -> DataFrame:
    """path, line_no, date and sentence of a receiver's log; a header line gives the local time of those after it.

    Where clocks are set back, an ambiguous hour is read as standard time. Lines before a file's first header have no
    date. Blank lines are left out. A file is taken in blocks of so many lines.
    """
    header = F.when(F.col("line").rlike(r"data:\s*$"), F.regexp_replace("line", r"\s*data:\s*$", ""))
    part = lambda i: F.trim(F.get(F.split(header, ","), F.lit(i)))
    local = F.try_to_timestamp(F.concat_ws(" ", F.concat_ws("-", part(0), part(1), part(2)), F.concat_ws(":", part(3), part(4), part(5))), F.lit("d-M-yy H:m:s"))
    first = F.to_utc_timestamp(local, tz)
    later = first + F.expr("INTERVAL 1 HOUR")
    utc = F.when(F.from_utc_timestamp(later, tz) == local, later).otherwise(first)
    out = lines.where(F.length(F.trim("line")) > 0).withColumn("_h", F.date_format(utc, "yyyyMMdd'T'HHmmss'.000Z'")).withColumn("_is", header.isNotNull())
    return last_known(out, ["path"], "line_no", F.col("_h"), "date", block).where("not _is").select("path", "line_no", "date", F.trim("line").alias("sentence"))


def read_receiver_raw(spark: SparkSession, paths: str | Sequence[str], tz: str = "America/Halifax") -> DataFrame:
    return receiver_dates(read_lines(spark, paths), tz)


def _no_value(c: Column) -> Column:
    return F.when(~c.isin("None", "none", ""), c)


def read_ee_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The provider's columns as text with path and line_no; None, none and empty are null. A quote within quotes is doubled."""
    schema = ", ".join(f"`{c}` string" for c in EE_COLUMNS)
    df = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(paths)
    return numbered(df, *[_no_value(F.col(f"`{c}`")).alias(c) for c in EE_COLUMNS])


def read_dsv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, line_no, line and ``tok``, the fields of the decoder's delimited output."""
    return read_lines(spark, paths).withColumn("tok", F.split("line", "\\|"))


def read_base_export(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, line_no, line, the tab-separated fields and ``tok``, those of the packed text in the eighth."""
    t = F.split("line", "\t")
    return read_lines(spark, paths).withColumn("message_id", F.get(t, F.lit(5)).try_cast("int")).withColumn("tok", F.split(F.trim(F.get(t, F.lit(7))), "\\|"))


def read_pings_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Position reports of a CSV with a header; other columns are not read, a time zone after the time is ignored."""
    raw = spark.read.option("header", True).csv(path).select(*PING_COLUMNS)
    return as_pings(raw.withColumn("time", F.coalesce(F.try_to_timestamp(F.regexp_extract("time", r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d+)?)", 1)), F.try_to_timestamp("time"))))


#: Of the columns that a database's table can be read by: what gives a row's range in SQL, and a range's first value.
RANGES = {"time": ('CAST("time" AS DATE)', lambda v: f"{{ts '{v} 00:00:00'}}"), "mmsi": ('"mmsi" / 100000', lambda v: str(int(v) * 100000))}


def even_ranges(counts: list[tuple[object, int]], parts: int) -> list[object]:
    """The first values of ranges with about equal counts, but for the first range; values come with their counts, in order."""
    total, seen, out = sum(n for _, n in counts), 0, []
    for value, n in counts:
        if seen and seen >= (len(out) + 1) * total / parts and len(out) < parts - 1:
            out.append(value)
        seen += n
    return out


def read_pings_jdbc(spark: SparkSession, url: str, table: str, by: str = "time", partitions: int | None = None, fetch: int = 10_000, **options: str) -> DataFrame:
    """Position reports of a database table, read in ranges of ``time`` (days) or ``mmsi`` with about equal rows.

    The database counts its rows by day (or by 100,000 vessel numbers), which is all that the driver gets: some thousands
    of counts. Each range is a query of its own, rows without a value go with the first. Spark pushes columns and filters
    down; the order is left to the windows.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    expression, text = RANGES[by]
    counts = reader.option("query", f"SELECT {expression} AS r, COUNT(*) AS n FROM {table} GROUP BY {expression}").load()
    known = sorted((r[0], int(r[1])) for r in counts.collect() if r[0] is not None)
    firsts = even_ranges(known, partitions or spark.sparkContext.defaultParallelism)
    column, edges = f'"{by}"', [text(v) for v in firsts]
    where = [" AND ".join([f"{column} >= {lo}"] * (lo is not None) + [f"{column} < {hi}"] * (hi is not None)) for lo, hi in zip([None, *edges], [*edges, None], strict=True)]
    where[0] = f"({where[0]}) OR {column} IS NULL" if where[0] else "1 = 1"
    return as_pings(spark.read.jdbc(url, table, predicates=where, properties={"fetchsize": str(fetch), **options}))
