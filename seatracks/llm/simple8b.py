"""Simple-8b coding of token ids, and token files of coded blocks.

A word of 64 bits holds a selector (top 4 bits) and as many ids of equal width as fit into 60 bits. Selector 0 is an
escape: the next word is one id of up to 64 bits. Ids are coded in runs of ``RUN``, each of which begins with a word of
its own; the words before each run are its offset, so runs decode apart from each other and all words of a selector at
once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Fixed values of the format (``RUN`` is a power of two): ids in a word and bits of each, by selector; 0 is the escape.
COUNTS = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
RUN = 1024
#: Ids of a block of a token file, about.
BLOCK = 1 << 18
#: Bytes of the encoder's memos, half of which are for words; bytes of texts that are encoded at once.
MEMO, SLICE = 512 << 20, 16 << 20
_COUNTS, _BITS = np.array(COUNTS, np.int32), np.array(BITS, np.int32)


def _starts(ends: np.ndarray) -> np.ndarray:
    """Where words begin, if a word that begins at i ends at ``ends[i]``: a walk through all runs side by side."""
    n = len(ends)
    at = np.arange(0, n, RUN, dtype=np.int32)
    stop = np.minimum(at + RUN, n)
    walked, ends = [], np.append(ends, n).astype(np.int32)
    while (at < stop).any():
        walked.append(at)
        at = np.where(at < stop, ends[at], at)
    every = np.stack(walked, axis=1)
    return every[every < stop[:, None]]


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and, for each run, the number of words before it."""
    ids = np.asarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, "<u8"), np.zeros(0, "<u4")
    bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    bits[ids >= 1 << 50] = 60  # beyond what doubles tell apart
    bits[ids >= 1 << 60] = 64
    # the selector that packs the most ids from each place on, by the largest width in windows of each count
    best = np.zeros(n, np.uint8)
    widest, width = bits.copy(), 1
    for s in range(len(COUNTS) - 1, 0, -1):
        while width < COUNTS[s]:
            step = min(width, COUNTS[s] - width)
            widest[:-step] = np.maximum(widest[:-step], widest[step:])
            width += step
        best -= (best - np.uint8(s)) * (widest <= BITS[s]).view(np.uint8)
    place_of = np.arange(n, dtype=np.int32)
    ends = np.minimum(np.minimum(place_of + _COUNTS[best], (place_of | (RUN - 1)) + 1), n)
    first = _starts(ends)
    sel = best[first]
    size = 1 + (sel == 0)
    place = np.cumsum(size) - size
    held = np.diff(first, append=n)
    shift = (place_of - np.repeat(first.astype(np.int32), held)) * np.repeat(_BITS[sel], held)
    value = np.add.reduceat(ids << shift.astype(np.uint64), first)
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = np.where(sel == 0, np.uint64(0), value | sel.astype(np.uint64) << np.uint64(60))
    words[place[sel == 0] + 1] = value[sel == 0]
    offsets = place[np.searchsorted(first, np.arange(0, n, RUN))]
    return words.astype("<u8"), offsets.astype("<u4")


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n ids of a coded block."""
    words = np.asarray(words, dtype=np.uint64)
    if not n:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    if (sel == 0).any():  # the word after an escape has no selector; after another raw word it may look like one
        raw, at = np.zeros(len(words), bool), 0
        for i in np.flatnonzero(sel == 0):
            if i >= at and not raw[i]:
                raw[i + 1], at = True, i + 2
        head = np.flatnonzero(~raw)
    else:
        head = np.arange(len(words))
    kind = sel[head]
    count = _COUNTS[kind]
    # each run's last word may hold fewer ids than its selector allows
    run = np.searchsorted(offsets, head, side="right") - 1
    before = np.cumsum(count) - count
    at = before - before[np.searchsorted(head, offsets)][run] + run * RUN
    count = np.minimum(count, np.minimum((run + 1) * RUN, n) - at)
    bits = _BITS[kind]
    shift = (np.arange(n) - np.repeat(at, count)) * np.repeat(bits, count)
    mask = (np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1)
    word = words[head]
    if (kind == 0).any():
        word, mask = word.copy(), mask.copy()
        word[kind == 0], mask[kind == 0] = words[head[kind == 0] + 1], np.uint64(0xFFFFFFFFFFFFFFFF)
    return np.repeat(word, count) >> shift.astype(np.uint64) & np.repeat(mask, count)


BLOCKS = "part int, block int, n_docs long, n_ids long, doc_ids binary, doc_null binary, lengths binary, offsets binary, words binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Tokenizes whole texts and writes coded blocks in ascending doc_id order (null first, ties by a hash of the text).

    One range exchange by id moves the texts; each task then encodes its range by slices of texts and writes it block by
    block, in constant memory. ``path`` may be in any store that Spark writes to. A file's rows are its blocks: the ids
    of their documents, the documents' lengths, and Simple-8b words with run offsets. Null and empty texts are their end
    id alone. Repeated rows are written one by one; other columns, whatever their names, are ignored; an empty table
    gives no blocks.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, block = common.chunks(tokenizer, MEMO), TaskContext.get().partitionId(), 0
        names: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal names, lengths, ids, held, block
            doc, sizes, flat = pa.concat_arrays(names), np.concatenate(lengths), np.concatenate(ids)
            words, offsets = encode(flat)
            row = {
                "part": part, "block": block, "n_docs": len(doc), "n_ids": len(flat),
                "doc_ids": doc.fill_null(0).to_numpy().astype("<i8").tobytes(), "doc_null": doc.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                "lengths": sizes.astype("<u4").tobytes(), "offsets": offsets.tobytes(), "words": words.tobytes(),
            }
            names, lengths, ids, held, block = [], [], [], 0, block + 1
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), *[(k, pa.binary()) for k in ("doc_ids", "doc_null", "lengths", "offsets", "words")]]))

        for batch in batches:
            for lo, hi in common.text_slices(batch.column(1), SLICE):
                flat, counts = coder.several(batch.column(1)[lo:hi])
                ends = np.cumsum(counts + 1)
                flat = np.insert(flat, np.cumsum(counts), end_id)
                at = used = 0
                while at < len(ends):  # a block ends with the document that fills it
                    stop = min(int(np.searchsorted(ends, used + BLOCK - held)) + 1, len(ends))
                    names.append(batch.column(0)[lo + at : lo + stop])
                    lengths.append(counts[at:stop] + 1)
                    ids.append(flat[used : ends[stop - 1]])
                    held += len(ids[-1])
                    at, used = stop, int(ends[stop - 1])
                    if held >= BLOCK:
                        yield flush()
        if names:
            yield flush()

    ranged = common.id_text(docs).repartitionByRange(common.buckets(docs.sparkSession), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ranged.mapInArrow(common.tidy(run), BLOCKS).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of each document, from the files alone.

    The starts come from the blocks' totals: a prefix sum over parts (a row each) and one over each part's blocks.
    ``with_ids`` adds the ids themselves.
    """
    files = spark.read.schema(BLOCKS).parquet(path)
    slim = files.select("part", "block", "n_ids")
    parts = slim.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_p0"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = slim.withColumn("_b0", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select(F.col("part").alias("_part"), F.col("block").alias("_block"), (F.col("_p0") + F.col("_b0")).alias("_start"))
    schema = "_p int, _b int, doc_id long, _at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                flat = decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<u4"), row["n_ids"]).astype("<u4")
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                at = np.cumsum(lengths) - lengths
                raw = memoryview(flat.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), lengths.tolist(), strict=True)]
                null = np.frombuffer(row["doc_null"], np.uint8).astype(bool)
                cols = [
                    pa.array(np.full(len(at), row["part"], np.int32)), pa.array(np.full(len(at), row["block"], np.int32)), pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=null),
                    pa.array(at), pa.array(lengths), pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    cols.append(pa.array([flat[a : a + n].astype(np.int64) for a, n in zip(at, lengths, strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, ["_p", "_b", "doc_id", "_at", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    docs = files.mapInArrow(common.tidy(run), schema)
    return docs.join(starts, (F.col("_p") == F.col("_part")) & (F.col("_b") == F.col("_block"))).select("doc_id", (F.col("_start") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
