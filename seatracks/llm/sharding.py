"""Contiguous shards of near-equal bytes, by DataFrame expressions only.

The slim rows (id, size, checksum) are range partitioned by id once. Each partition's total goes into a prefix sum over
partitions, each row's size into a running sum inside its partition; together they give each row's place in the global
sequence of bytes, and equal targets cut that sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) for each row.

    Rows stand in ascending doc_id order (null first; ties by checksum and size, so equal rows are interchangeable). A
    row belongs to the shard that the middle of its bytes falls into: each shard differs from total / shards by at most
    the largest row. Null text: size 1, checksum of no bytes. Rows of equal text need not share a shard.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    order = ("doc_id", "text_crc32", "size")
    home = common.shared_dir(spark)
    ranged = common.written(slim.repartitionByRange(common.buckets(spark), *order).withColumn("_part", F.spark_partition_id()), f"{home}/ranged")
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    # one row for each partition: as few as there are partitions, whatever the data
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_b0"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_r0"))
    total = totals.agg(F.sum("_bytes").alias("t")).first()["t"] or 1
    inside = Window.partitionBy("_part").orderBy(*order)
    placed = (
        ranged.withColumn("_end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_row", F.row_number().over(inside).cast("long") - 1)
        .join(F.broadcast(offsets), "_part")  # a row for each partition of the range exchange above
        .withColumn("_at", F.col("_r0") + F.col("_row"))
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor((2 * (F.col("_b0") + F.col("_end")) - F.col("size")) * F.lit(shards) / F.lit(2 * total)).cast("int")))
        .select("doc_id", "size", "text_crc32", "shard", "_at")
    )
    placed = common.written(placed, f"{home}/placed")
    firsts = placed.groupBy("shard").agg(F.min("_at").alias("_first"))  # at most ``shards`` rows
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("_at") - F.col("_first")).alias("slot"))
