"""Near-duplicate documents by b-bit MinHash.

Documents with equal shingle sets form one class. Each class keeps the low bits of its minima, packed into bit planes,
and bands of whole minima give candidate pairs. A pair's similarity is estimated by counting equal bits, corrected for
chance collisions; what the estimate cannot rule out is confirmed on the full sets.

Within a band's bucket no pairs of all members are made: in a few rounds each class that is outside its buckets' largest
components is compared with the likeliest of a few of their members; then only what is still in different components
meets, by longer signatures first. Components come from min-label propagation over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Words in a shingle; least similarity in percent.
SHINGLE, PERCENT = 5, 75
#: 32 bands of 4 minima: a pair of similarity 0.75 shares no band with probability 5e-6.
BANDS, ROWS = 32, 4
K = BANDS * ROWS
#: Low bits kept of each minimum.
B_BITS = 2
#: Estimates below this are ruled out: at similarity 0.75 that is more than four standard deviations off.
LEAST_ESTIMATE = 0.55
#: Rounds in which a class outside its buckets' largest components meets one member of those, before it meets all.
ROUNDS = 3
#: Up to so many bytes, counted by rows, a table is broadcast; beyond it the join is shuffled.
SMALL = 48 << 20

#: What still has to meet many others gets longer signatures; estimates from those have a fifth of the variance or less.
FINE_K, LEAST_FINE = 1024, 0.67
#: Of buckets with more members than this, a round draws one in so many.
LARGE, ONE_IN = 8, 4

_rng = np.random.default_rng(20240501)
MULTIPLY = (_rng.integers(0, 1 << 32, FINE_K, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
FLIP = _rng.integers(0, 1 << 32, FINE_K, dtype=np.uint64).astype(np.uint32)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; with fewer words than that, of the whole sequence."""
    h = common.word_hashes(common.words_of(text, lower=True))
    return np.unique(common.windows(h, SHINGLE if len(h) >= SHINGLE else max(1, len(h))))


def minima(s: np.ndarray, k: int = K) -> np.ndarray:
    """The k minima of a set, in blocks, so long texts take no more memory than short ones."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out, flip, multiply = np.full(k, 0xFFFFFFFF, np.uint32), FLIP[:k], MULTIPLY[:k]
    step = 512 * K // k
    for i in range(0, len(x), step):
        np.minimum(out, ((x[i : i + step, None] ^ flip) * multiply).min(axis=0), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row of minima; the band's number is part of it."""
    rows = m.reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * common.MIX1, rows.shape[:2]).copy()
    for j in range(ROWS):
        out = common.mix(out ^ rows[:, :, j])
    return out.view(np.int64)


def packed_bits(m: np.ndarray) -> np.ndarray:
    """The low bits of the minima, a bit plane after the other, as 64-bit numbers."""
    bits = (m[:, None, :] >> np.arange(B_BITS, dtype=np.uint32)[:, None]) & np.uint32(1)
    return np.packbits(bits.reshape(len(bits), -1).astype(np.uint8), axis=1, bitorder="little").view("<i8")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, set_id (128-bit hash of the set; null without words), n_shingles, bits and bands of each document."""
    schema = "doc_id long, set_id binary, n_shingles long, bits array<long>, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            texts = batch.column(1)
            for lo in range(0, batch.num_rows, 1024):
                part = texts.slice(lo, 1024)
                names, sizes, m = [], [], np.zeros((len(part), K), np.uint32)
                for i, t in enumerate(part):
                    s = shingles(t.as_py())
                    sizes.append(len(s))
                    names.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    if len(s):
                        m[i] = minima(s)
                lists = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32)), pa.array(a.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 1024), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), lists(packed_bits(m)), lists(band_keys(m))], ["doc_id", "set_id", "n_shingles", "bits", "bands"])

    return common.id_text(docs).mapInArrow(common.tidy(run), schema)


def estimate(a: str, b: str, k: int = K) -> Column:
    """Similarity of two columns of bits: the share of minima with equal low bits, corrected for chance."""
    longs = k // 64
    differ = F.lit(0)
    for i in range(longs):
        odd = F.lit(0).cast("long")
        for p in range(B_BITS):
            odd = odd.bitwiseOR(F.get(a, F.lit(p * longs + i)).bitwiseXOR(F.get(b, F.lit(p * longs + i))))
        differ = differ + F.bit_count(odd)
    chance = 0.5**B_BITS
    return ((F.lit(k) - differ) / F.lit(float(k)) - F.lit(chance)) / F.lit(1 - chance)


def _few(df: DataFrame, most: int = SMALL) -> DataFrame:
    """A written table of numbers, marked for broadcast if all its rows, with what a hash table takes besides, are small."""
    return F.broadcast(df) if df.count() * (32 + 8 * len(df.columns)) <= most else df


def components(edges: DataFrame, home: str) -> DataFrame:
    """node, label (the smallest node reachable) for all nodes of a table of edges (a, b).

    Each round takes the smallest label around and then the label's own label, and is written; rounds are about the
    logarithm of the longest shortest path.
    """
    both = common.written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{home}/edges")
    labels = common.written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), f"{home}/labels-0")
    for k in count(1):  # labels only fall, so it ends
        small = _few(labels)
        near = both.join(small, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = near.join(small, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = small.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        labels = common.written(step.join(jump, F.col("label") == F.col("n2"), "left").select("node", "old", F.least("label", F.coalesce("l2", "label")).alias("label")), f"{home}/labels-{k}")
        if not labels.where("old <> label").take(1):
            break
        labels = labels.select("node", "label")
    return labels.select("node", "label")


def fine_bits(docs: DataFrame, ids: DataFrame, home: str) -> DataFrame:
    """n, fine: the longer signatures of the documents whose id is in ``ids`` (column node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                m = np.array([minima(shingles(t.as_py()), FINE_K) for t in batch.column(1).slice(lo, 256)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), pa.array(list(packed_bits(m)), pa.list_(pa.int64()))], ["n", "fine"])

    found = common.id_text(docs).join(_few(ids), F.col("doc_id") == F.col("node"), "left_semi")
    return common.written(found.mapInArrow(common.tidy(run), "n long, fine array<long>"), f"{home}/fine")


def sets_of(docs: DataFrame, ids: DataFrame, home: str) -> DataFrame:
    """node, set (its shingle hashes as bytes) of the documents whose id is in ``ids`` (column node)."""
    schema = "node long, set binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 512), pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1).slice(lo, 512)], pa.binary())], ["node", "set"])

    found = common.id_text(docs).join(_few(ids), F.col("doc_id") == F.col("node"), "left_semi")
    return common.written(found.mapInArrow(common.tidy(run), schema), f"{home}/sets")


def confirmed(docs: DataFrame, pairs: DataFrame, home: str) -> DataFrame:
    """The components (a, b) that a pair with similar enough full sets links; pairs are (a, b) of components (la, lb)."""
    pairs = common.written(pairs.select("a", "b", "la", "lb"), f"{home}/pairs")
    ids = common.written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), f"{home}/ids")
    sets = sets_of(docs, ids, home)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["la", "lb"]).filter(pa.array(good, pa.bool_()))

    first = sets.select(F.col("node").alias("set_a"), F.col("set").alias("x")).join(_few(pairs), F.col("a") == F.col("set_a"))
    both = first.join(sets.select(F.col("node").alias("set_b"), F.col("set").alias("y")), F.col("b") == F.col("set_b")).select("la", "lb", "x", "y")
    linked = both.mapInArrow(common.tidy(run), "la long, lb long").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
    return common.written(linked.where("a <> b").distinct(), f"{home}/links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each document.

    Null, empty or blank text: an empty set, linked with nothing. A row without doc_id is linked with nothing and kept.
    Rows of one doc_id are one document. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    home = common.shared_dir(spark)
    each = common.written(signatures(docs), f"{home}/signatures")
    known = each.where("set_id is not null and doc_id is not null")
    classes = common.written(
        known.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"), F.first("bands").alias("bands")), f"{home}/classes"
    )
    labels = _few(_labels(spark, docs, classes, home))
    named = classes.select("set_id", "node").join(labels.select(F.col("node").alias("n"), "label"), F.col("node") == F.col("n"), "left").select(F.col("set_id").alias("s"), F.coalesce("label", "node").alias("label"))
    named = common.written(named, f"{home}/named")
    out = each.select("doc_id", "set_id", "n_shingles").join(named, F.col("set_id") == F.col("s"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _likely(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and estimates don't rule out, with the estimate as e."""
    x = bits.select(F.col("n").alias("na"), F.col("size").alias("sa"), F.col("bits").alias("x"))
    y = bits.select(F.col("n").alias("nb"), F.col("size").alias("sb"), F.col("bits").alias("y"))
    both = x.join(_few(pairs), F.col("a") == F.col("na")).join(y, F.col("b") == F.col("nb"))
    return both.select("a", "b", "la", "lb", estimate("x", "y").alias("e"), (100 * F.least("sa", "sb") >= PERCENT * F.greatest("sa", "sb")).alias("fit")).where(F.col("fit") & (F.col("e") >= LEAST_ESTIMATE))


def _labels(spark: SparkSession, docs: DataFrame, classes: DataFrame, home: str) -> DataFrame:
    """node and label of the classes that are linked with any."""
    rows = classes.select("node", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select(F.col("key").alias("k"))
    members = common.written(rows.join(shared, F.col("key") == F.col("k"), "left_semi"), f"{home}/members")
    n_members = members.count()
    bits = classes.select(F.col("node").alias("n"), F.col("n_shingles").alias("size"), "bits")
    placed, labels = members.withColumn("label", F.col("node")), None
    for k in range(ROUNDS + 1):
        # of each bucket that holds several components, the largest and how many pairs would meet it
        per = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(F.xxhash64("node", "key", F.lit(k)), "node")).alias("lead"))
        mixed = per.groupBy("key").agg(F.max(F.struct("c", F.xxhash64("key", "label"), "label", "lead.node")).alias("m"), F.sum("c").alias("all"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
        mixed = common.written(mixed.select(F.col("key").alias("k"), F.col("m.label").alias("most"), F.col("m.node").alias("lead"), (F.col("all") > LARGE).alias("large"), ((F.col("all") - F.col("m.c")) * F.col("all")).alias("work")), f"{home}/mixed-{k}")
        last = k == ROUNDS or (k > 0 and (mixed.agg(F.sum("work").alias("w")).first()["w"] or 0) <= n_members)
        rest = placed.join(_few(mixed), F.col("key") == F.col("k"))
        if not last:  # each class outside it with the likeliest of one member of it for each bucket
            drawn = ~F.col("large") | (F.pmod(F.xxhash64("key", F.lit(k)), F.lit(ONE_IN)) == 0)
            pairs = rest.where(drawn & (F.col("label") != F.col("most"))).select(F.col("node").alias("a"), F.col("lead").alias("b"), F.col("label").alias("la"), F.col("most").alias("lb"))
            pairs = _likely(common.written(pairs.distinct(), f"{home}/drawn-{k}"), bits)
            pairs = pairs.groupBy("a").agg(F.max(F.struct("e", "b", "la", "lb")).alias("m")).select("a", "m.b", "m.la", "m.lb")
        else:  # what has stayed outside meets all of other components
            rest = common.written(rest.select("key", "node", "label", "most"), f"{home}/rest")
            fine = fine_bits(docs, common.written(rest.select("node").distinct(), f"{home}/rest-ids"), home)
            whole = classes.select(F.col("node").alias("n2"), F.col("n_shingles").alias("size"), "bands")
            rest = rest.join(fine, F.col("node") == F.col("n")).join(whole, F.col("node") == F.col("n2")).select("key", "node", "label", "most", "size", "bands", "fine")
            rest = common.written(rest, f"{home}/rest-bits")
            x = rest.where("label <> most").select("key", F.col("node").alias("a"), F.col("label").alias("la"), F.col("size").alias("sa"), F.col("bands").alias("bx"), F.col("fine").alias("x"))
            y = rest.select(F.col("key").alias("k"), F.col("node").alias("b"), F.col("label").alias("lb"), F.col("most").alias("mb"), F.col("size").alias("sb"), F.col("bands").alias("by"), F.col("fine").alias("y"))
            meet = (F.col("key") == F.col("k")) & (F.col("la") != F.col("lb")) & ((F.col("lb") == F.col("mb")) | (F.col("a") < F.col("b"))) & (100 * F.least("sa", "sb") >= PERCENT * F.greatest("sa", "sb")) & (estimate("x", "y", FINE_K) >= LEAST_FINE)
            # a pair that shares several buckets is taken in the one with the smallest key
            once = F.array_min(F.array_intersect("bx", "by")) == F.col("key")
            pairs = x.join(y, meet & once).select("a", "b", "la", "lb")
        found = confirmed(docs, pairs, f"{home}/round-{k}")
        if labels is None:
            labels = components(found, f"{home}/round-{k}")
        elif found.take(1):  # components join components: their labels get new ones
            new = _few(components(found, f"{home}/round-{k}")).select(F.col("node").alias("l2"), F.col("label").alias("to"))
            old = labels.join(new, F.col("label") == F.col("l2"), "left").select("node", F.coalesce("to", "label").alias("label"))
            alone = new.join(labels, F.col("l2") == F.col("node"), "left_anti").select(F.col("l2").alias("node"), F.col("to").alias("label"))
            labels = common.written(old.union(alone), f"{home}/labels-{k}")
        if last:
            break
        of = _few(labels).select(F.col("node").alias("n"), "label")
        placed = common.written(members.join(of, F.col("node") == F.col("n"), "left").select("key", "node", F.coalesce("label", "node").alias("label")), f"{home}/placed-{k}")
    return labels


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents with their columns, without all but the first of each component.

    Documents without text or words and rows without doc_id stay; repeated rows of a kept document stay, too. An empty
    table gives none. Other columns may have any names.
    """
    (name,) = common.free(docs, "_gone")
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(_few(common.written(gone, common.shared_dir(docs.sparkSession))), F.col("doc_id") == F.col(name), "left_anti")
