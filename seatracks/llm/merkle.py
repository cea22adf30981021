"""A Merkle manifest of a table: leaves by group and id, runs of three, a tree of the groups' roots above.

Where a leaf stands comes from bitmaps, not from a sort. Each group's ids are a compressed bitmap: 64-bit words, of which
only those with a bit are kept, merged over partitions by ``or``. A directory of popcounts over them has levels of 1,024
children, however dense or sparse the ids are; the rank of an id is its word's base and the bits below its own. Nodes
are then keyed by place, and each step puts 81 neighbours into one array of slots, whose four levels are reduced in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Children of a node of the tree; levels that one step reduces; bits of a directory level.
ARITY, LEVELS, RADIX = 3, 4, 10
BLOCK = ARITY**LEVELS
PATH = "array<struct<l:string,r:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the texts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the value's UTF-8 bytes as a count, a colon and the text."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def bitmaps(leaves: DataFrame) -> DataFrame:
    """_g, _z, _w, bits and n (rows) of each word that has a row. ``bits`` counts each id once."""
    bit = F.expr("shiftleft(1L, cast(_k & 63 as int))")
    return leaves.groupBy("_g", "_z", F.shiftright("_k", 6).alias("_w")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))


def ranked(words: DataFrame) -> DataFrame:
    """The words with ``base``, the rows of the group before them, and ``_m``, all rows of the group.

    Counts are summed up level by level until a group has one node, and bases handed down again; a window never holds
    more than the 1,024 children of a node. Rows without an id stand before the others of their group.
    """
    least, most = words.agg(F.min("_w"), F.max("_w")).first() or (None, None)
    span = (most or 0) - (least or 0)
    levels = [words.withColumn("_c", F.col("_w") - F.lit(least or 0))]
    while span:
        span >>= RADIX
        levels.append(levels[-1].groupBy("_g", "_z", F.shiftright("_c", RADIX).alias("_c")).agg(F.sum("n").alias("n")))
    group = Window.partitionBy("_g")
    ordered = group.orderBy(F.desc("_z")).rowsBetween(Window.unboundedPreceding, -1)  # two rows at most
    based = levels[-1].select(*levels[-1].columns, F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("base"), F.sum("n").over(group).alias("_m"))
    for level in levels[-2::-1]:
        siblings = Window.partitionBy("_g", "_z", "_p").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("_p", F.shiftright("_c", RADIX)).withColumn("_before", F.coalesce(F.sum("n").over(siblings), F.lit(0)))
        above = based.select("_g", "_z", F.col("_c").alias("_p"), F.col("base").alias("_up"), "_m")
        based = level.join(above, ["_g", "_z", "_p"]).withColumn("base", F.col("_up") + F.col("_before")).drop("_p", "_before", "_up")
    return based.select("_g", "_z", "_w", "bits", "n", "base", "_m")


def placed(leaves: DataFrame, words: DataFrame) -> DataFrame:
    """The leaves with their place ``_at`` in the group, and its size ``_m``.

    Words in which an id occurs more than once are no bitmap: there, equal rows are counted together, and the counts of
    the different rows of 64 ids summed up in order of id and leaf.
    """
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(_k & 63 as int)))")
    joined = leaves.withColumn("_w", F.shiftright("_k", 6)).join(words, ["_g", "_z", "_w"])
    columns = ("_g", "_id", "_h", "_x", "_m", "_at")
    out = joined.where(F.col("n") == F.bit_count("bits")).withColumn("_at", F.col("base") + below).select(*columns)
    if words.where(F.col("n") != F.bit_count("bits")).isEmpty():
        return out
    alike = joined.where(F.col("n") != F.bit_count("bits")).groupBy("_g", "_z", "_w", "_k", "_h").agg(F.first("_id").alias("_id"), F.first("_x").alias("_x"), F.first("base").alias("base"), F.first("_m").alias("_m"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g", "_z", "_w").orderBy("_k", "_h").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("base") + F.coalesce(F.sum("_n").over(before), F.lit(0))
    return out.unionByName(alike.withColumn("_first", first).withColumn("_at", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1))).select(*columns))


def _reduced(level: Column) -> Column:
    """The digests of a level's runs."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(level, i * ARITY + 1, F.lit(ARITY)), "")))


def _step(nodes: DataFrame) -> DataFrame:
    """_g, _b, the slots (_s), the hashes of each level (_h0 to _h4), the levels reduced (_l) and the nodes left (_m).

    A group of one node is not reduced further; a last run of one node is hashed as any other.
    """
    slots = F.sort_array(F.collect_list(F.struct("_at", "_h", *[c for c in nodes.columns if c not in ("_g", "_at", "_h", "_m")])))
    blocks = nodes.groupBy("_g", F.expr(f"_at div {BLOCK}").alias("_b")).agg(slots.alias("_s"), F.first("_m").alias("_m"))
    powers = F.array(*[F.lit(ARITY**k) for k in range(LEVELS)])
    blocks = blocks.withColumn("_l", F.size(F.filter(powers, lambda p: p < F.col("_m")))).withColumn("_h0", F.col("_s._h"))
    for k in range(LEVELS):
        below = F.col(f"_h{k}")
        blocks = blocks.withColumn(f"_h{k + 1}", F.when(F.col("_l") > k, _reduced(below)).otherwise(below))
    return blocks.withColumn("_m", F.expr(f"(_m + {BLOCK - 1}) div {BLOCK}"))


def _siblings(at: Column) -> Column:
    """The siblings left and right of a slot, level by level."""
    out = []
    for k in range(LEVELS):
        x = F.floor(at / ARITY**k).cast("int")
        first = x - x % ARITY
        part = lambda start, n, k=k: F.array_join(F.slice(F.col(f"_h{k}"), start, n), "")
        out.append(F.struct(part(first + 1, x - first).alias("l"), part(x + 2, first + ARITY - 1 - x).alias("r")))
    return F.slice(F.array(*out), F.lit(1), F.col("_l"))


class Tree:
    """The steps from nodes (_g, _at, _h, _m and what else they carry) up to one for each group; each step is written."""

    def __init__(self, nodes: DataFrame, most: int, home: str):
        self.steps: list[DataFrame] = []
        while not self.steps or most > 1:
            self.steps.append(common.written(_step(nodes), f"{home}/{len(self.steps)}"))
            nodes, most = self.steps[-1].select("_g", F.col("_b").alias("_at"), F.get(f"_h{LEVELS}", F.lit(0)).alias("_h"), "_m"), -(-most // BLOCK)
        self.tops = nodes

    def paths(self, above: DataFrame) -> DataFrame:
        """Each node with its siblings up to the top and on: ``above`` has _g, _at, _path and what else it hands down."""
        more = [c for c in above.columns if c not in ("_g", "_at", "_path")]
        for blocks in reversed(self.steps):
            slots = blocks.join(above.withColumnRenamed("_at", "_b"), ["_g", "_b"]).withColumn("_i", F.sequence(F.lit(0), F.size("_s") - 1))
            each = F.arrays_zip(F.col("_s").alias("s"), F.transform("_i", lambda i: F.concat(_siblings(i), F.col("_path"))).alias("p"))
            rows = slots.select("_g", *more, F.explode(each).alias("_n")).select("_g", *more, "_n.s.*", F.col("_n.p").alias("_path"))
            above = rows.select("_g", "_at", "_path", *more)
        return rows


def _numbered(tops: DataFrame, home: str) -> DataFrame:
    """The groups' roots in order of group, as nodes of one group."""
    spark = tops.sparkSession
    ranged = common.written(tops.select("_g", "_h").repartitionByRange(common.buckets(spark), "_g").withColumn("_part", F.spark_partition_id()), f"{home}/ranged")
    # one row for each partition: as few as there are partitions, whatever the data
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_g"))
    return ranged.withColumn("_row", inside).join(F.broadcast(offsets.select("_part", "_first")), "_part").select(F.lit("").alias("_g"), (F.col("_first") + F.col("_row") - 1).alias("_at"), "_h", F.struct(F.col("_g").alias("g")).alias("_top"))


def manifest(docs: DataFrame, leaf: Column, group: Column, extra: Column) -> DataFrame:
    """doc_id, leaf, extra, subroot, root and path (the siblings left and right of each level) of each row.

    Rows of a group stand in order of doc_id: null ids first, then ties, both by leaf; equal rows have a place each.
    Groups are ordered by their UTF-8 bytes, null first. A group of one row has its leaf as subroot, and a table of one
    group its subroot as root. An empty table gives no rows. ``extra`` is any text of a row that is to come along, and
    must be the same for rows of equal id and leaf. Other columns are ignored, whatever their names.
    """
    home = common.shared_dir(docs.sparkSession)
    row = docs.select(F.col("doc_id").cast("long").alias("_id"), leaf.alias("_h"), F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("_g"), extra.cast("string").alias("_x"))
    row = common.written(row, f"{home}/leaves")
    # rows without an id are told apart by their leaf's first 60 bits
    leaves = row.withColumn("_z", F.col("_id").isNull()).withColumn("_k", F.coalesce("_id", F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")))
    words = common.written(ranked(common.written(bitmaps(leaves), f"{home}/words")), f"{home}/directory")
    nodes = common.written(placed(leaves, words), f"{home}/placed")
    most = words.agg(F.max("_m")).first()[0] or 0
    groups = Tree(nodes, most, f"{home}/group")
    tops = _numbered(groups.tops, home)
    n = tops.count()
    over = Tree(tops.withColumn("_m", F.lit(n).cast("long")), n, f"{home}/root")
    root = over.tops.select("_h").first()
    start = over.tops.select("_g", "_at", F.array().cast(PATH).alias("_path"))
    above = over.paths(start).select(F.col("_top.g").alias("_g"), F.lit(0).cast("long").alias("_at"), "_path", F.col("_h").alias("_sub"))
    return groups.paths(above).select(F.col("_id").alias("doc_id"), F.col("_h").alias("leaf"), F.col("_x").alias("extra"), F.col("_sub").alias("subroot"), F.lit(root["_h"] if root else None).cast("string").alias("root"), F.col("_path").alias("path"))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, from the leaf upwards, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["l"], p["r"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda h, p: digest(p["l"], h, p["r"]))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampering_found(docs: DataFrame) -> DataFrame:
    """Each row's leaf, subroot, root, proof_sha256, folded_root and whether that equals the root, after the texts of
    rows whose id has an even checksum have lost their line feeds (null texts and rows without an id stay as they are).
    """
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    plain = [field(F.col(c)) for c in FIELDS]
    leaf = digest(*plain)
    changed = digest(*plain[:-1], field(tampered))
    rows = manifest(docs, leaf, F.col("source"), F.when(changed != leaf, changed))
    out = rows.withColumn("folded_root", folded(F.coalesce("extra", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

