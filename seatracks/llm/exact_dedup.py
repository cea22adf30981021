"""Exact duplicates by an extendible-hash index on shared files, by DataFrame expressions only.

A text's key is a 64-bit hash of its normal form. The directory has an entry for each prefix of ``depth`` bits; a bucket
that is overfull is split by one more bit, for which the directory is doubled where needed, so a bucket is a contiguous
range of keys. Owner tasks take whole buckets: they chain texts whose hashes collide and compare them byte by byte. The
index is a folder of generations, each a directory and its entries; a batch makes the next one from the last.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Runs of white space but for the single space, which stays as it is.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: Bits of the longest directory: it has at most 2**18 entries, so it can be broadcast. Beyond, buckets grow instead.
MAX_DEPTH = 18
#: Buckets that the texts of one generation may fill at most, on average; and rows that make a group hot: a share of all.
MOST_BUCKETS, HOT_SHARE = 1 << 16, 1 << 12


def normal_form(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), RUNS, " ")


def _prefix(bits: int) -> Column:
    """The first bits of a key, as a number; no bits are 0."""
    return F.shiftrightunsigned("_h", 64 - bits) if bits else F.lit(0).cast("long")


def directory(loads: DataFrame, capacity: int) -> DataFrame:
    """cell, bucket (its first cell) and depth, for cells of ``MAX_DEPTH`` bits with their load and number of keys.

    Bucket by bucket: the one of no bits holds all; one that holds more than ``capacity`` and two keys or more becomes
    two of one bit more, and so on. Doubling the directory only repeats entries, so all its sizes are laid out at once:
    a bucket is in the directory if it isn't overfull and the one it was split from is.
    """
    depth = F.explode(F.sequence(F.lit(0), F.lit(MAX_DEPTH))).alias("depth")
    sizes = loads.select("cell", "load", "n", depth).groupBy("depth", F.expr(f"shiftright(cell, {MAX_DEPTH} - depth)").alias("prefix")).agg(F.sum("load").alias("load"), F.sum("n").alias("n"))
    full = sizes.select("depth", "prefix", ((F.col("load") > capacity) & (F.col("n") > 1) & (F.col("depth") < MAX_DEPTH)).alias("full"))
    split = full.where("full").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
    fits = full.where("not full").withColumn("up", F.expr("shiftright(prefix, 1)"))
    held = fits.where("depth = 0").select("depth", "prefix").unionByName(fits.join(split, ["depth", "up"], "left_semi").select("depth", "prefix"))
    first = F.expr(f"shiftleft(prefix, {MAX_DEPTH} - depth)")
    return held.select(F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {MAX_DEPTH} - depth)") - 1)).alias("cell"), first.alias("bucket"), "depth")


class ExtendibleIndex:
    """An index of all texts added so far, in a folder that all machines share.

    ``capacity`` is a bucket's load in bytes of text (a text counts as a sixteenth of it at most, as splitting can't
    part a text). ``key_bits`` shortens the hashes, for tests of collisions. A generation is there once its entries are
    whole: a session that stops halfway leaves the last one as it was, and any later session goes on from that.
    """

    def __init__(self, spark: SparkSession, path: str, capacity: int = 4 << 20, key_bits: int = 64):
        self.spark, self.path, self.capacity, self.key_bits = spark, path, capacity, key_bits

    def generations(self) -> list[int]:
        """Numbers of the generations that are whole, in ascending order."""
        return [n for n, whole in self._found() if whole]

    def _found(self) -> list[tuple[int, bool]]:
        home = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = home.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(home)] if fs.exists(home) else []
        done = lambda n: fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/entries/_SUCCESS"))
        return sorted((int(n[1:]), done(n)) for n in names if re.fullmatch(r"g\d+", n))

    def entries(self) -> DataFrame | None:
        """bucket, key, chain (number in the chain of its key), chained (the chain's length), text, size, keep_id,
        group_size and text_sha256 of each text of the last generation; none before the first batch."""
        found = self.generations()
        return self.spark.read.parquet(f"{self.path}/g{found[-1]}/entries") if found else None

    def prune(self) -> None:
        """Removes all generations but the last whole one."""
        last = max(self.generations(), default=None)
        for n, _ in self._found():
            if n != last:
                common.removed(self.spark, f"{self.path}/g{n}")

    def _keyed(self, docs: DataFrame) -> DataFrame:
        text = normal_form(F.col("text"))
        return docs.select(F.col("doc_id").cast("long").alias("_id"), text.alias("_t")).withColumn("_h", F.xxhash64("_t").bitwiseAND(F.lit(-1 << (64 - self.key_bits) if self.key_bits else 0)))

    def add(self, docs: DataFrame) -> DataFrame:
        """Adds documents; returns doc_id, keep_id, group_size, kept and text_sha256 of each of them.

        The one with the smallest doc_id of all equal texts so far stays; rows that share it stay alike. Null text is
        empty; a null doc_id comes after all others (a group of such rows alone has no keep_id, and all stay). An empty
        table gives no rows. Other columns are ignored, whatever their names.
        """
        found = self._found()
        old, home = self.entries(), f"{self.path}/g{max((n for n, _ in found), default=-1) + 1}"
        keys = common.written(self._keyed(docs).select("_id", "_h", F.octet_length("_t").cast("long").alias("_size")), f"{home}/keys")
        counted = keys.groupBy("_h").agg(F.count(F.lit(1)).alias("_rows"), F.max("_size").alias("_size"), F.sum("_size").alias("_all"))
        if old is not None:
            counted = counted.unionByName(old.select(F.col("key").alias("_h"), F.lit(0).cast("long").alias("_rows"), F.col("size").alias("_size"), F.col("size").alias("_all")))
            counted = counted.groupBy("_h").agg(F.sum("_rows").alias("_rows"), F.max("_size").alias("_size"), F.sum("_all").alias("_all"))
        counted = common.written(counted, f"{home}/counted")
        total = counted.agg(F.sum("_all").alias("bytes"), F.sum("_rows").alias("rows")).first()
        capacity = max(self.capacity, (total["bytes"] or 0) // MOST_BUCKETS)
        loads = counted.groupBy(_prefix(MAX_DEPTH).alias("cell")).agg(F.sum(F.least(F.col("_size") + 1, F.lit(capacity // 16))).alias("load"), F.count(F.lit(1)).alias("n"))
        cells = common.written(directory(loads, capacity), f"{home}/directory").select("cell", "bucket")
        # of these groups there are at most total / capacity and HOT_SHARE
        hot = counted.where((F.col("_rows") > 1) & ((F.col("_all") > capacity) | (F.col("_rows") > F.lit((total["rows"] or 0) // HOT_SHARE)))).select("_h")
        one = lambda df: df.groupBy("_h", "_t").agg(F.min("_id").alias("_keep"), F.sum("_n").alias("_n"))
        rows = self._keyed(docs).withColumns({"_keep": F.col("_id"), "_n": F.lit(1).cast("long")})
        # the copies of a hot group meet before they are sent; the others go straight to their bucket's owner
        light = rows.join(F.broadcast(hot), "_h", "left_anti").select("_h", "_t", "_keep", "_n")
        texts = light.unionByName(one(rows.join(F.broadcast(hot), "_h", "left_semi")))
        if old is not None:
            texts = texts.unionByName(old.select(F.col("key").alias("_h"), F.col("text").alias("_t"), F.col("keep_id").alias("_keep"), F.col("group_size").alias("_n")))
        owners = common.buckets(self.spark, total["bytes"], 128 << 20)
        # at most 2**MAX_DEPTH entries of two numbers
        owned = texts.join(F.broadcast(cells), _prefix(MAX_DEPTH) == F.col("cell")).select("bucket", "_h", "_t", "_keep", "_n").repartition(owners, "bucket")
        owned = owned.groupBy("bucket", "_h", "_t").agg(F.min("_keep").alias("keep_id"), F.sum("_n").alias("group_size"))
        chain = Window.partitionBy("bucket", "_h")
        owned = owned.select(
            "bucket", F.col("_h").alias("key"), F.row_number().over(chain.orderBy(F.asc_nulls_last("keep_id"), "_t")).alias("chain"), F.count(F.lit(1)).over(chain).alias("chained"),
            F.col("_t").alias("text"), F.octet_length("_t").cast("long").alias("size"), "keep_id", "group_size", F.sha2("_t", 256).alias("text_sha256"),
        )
        entries = common.written(owned.sortWithinPartitions("bucket", "key", "chain"), f"{home}/entries")
        return self._decided(docs, keys, entries, hot)

    def _decided(self, docs: DataFrame, keys: DataFrame, entries: DataFrame, hot: DataFrame) -> DataFrame:
        """Each document's group. A key whose chain has one text stands for it, so only the key is joined; hot ones are
        broadcast. Documents with other keys are compared with all texts of the chain."""
        group = ("keep_id", "group_size", "text_sha256")
        single = entries.where("chained = 1").select(F.col("key").alias("_h"), *group)
        slim = keys.select("_id", "_h")
        out = slim.join(F.broadcast(single.join(F.broadcast(hot), "_h", "left_semi")), "_h").select("_id", *group)
        out = out.unionByName(slim.join(F.broadcast(hot), "_h", "left_anti").join(single, "_h").select("_id", *group))
        longer = entries.where("chained > 1").select(F.col("key").alias("_h"), F.col("text").alias("_t"), *group)
        if not longer.isEmpty():
            out = out.unionByName(self._keyed(docs).join(longer, ["_h", "_t"]).select("_id", *group))
        return out.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, capacity: int = 4 << 20, key_bits: int = 64) -> DataFrame:
    """The groups of equal texts of one table, by an index of its own in the shared folder; see ``add``."""
    spark = docs.sparkSession
    return ExtendibleIndex(spark, common.shared_dir(spark), capacity, key_bits).add(docs)
