"""Best-fit packing by length patterns.

The histogram of lengths (a number for each length, however many documents there are) is fitted by non-negative least
squares with patterns of few lengths that fill a sequence; their repeat counts are rounded down and exact lengths are chosen for each. A sequence that these fill to the
last token stays; the documents of the others return to the rest, which is packed best-fit decreasing. The plan is then joined to the pieces: each piece's rank among those of its length gives its place.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Lengths are fitted in so many steps of a sequence, by patterns of so many documents at most.
STEPS, PARTS = 128, 4
#: Patterns hold no document of fewer steps: small ones fill what is left open.
LEAST = 8
#: Bytes of the encoder's memos, half of which are for words.
MEMO = 512 << 20


def patterns(steps: int = STEPS, parts: int = PARTS) -> np.ndarray:
    """All non-increasing tuples of 1 to ``parts`` step counts that sum to ``steps``; rows padded with 0."""
    out = []
    for k in range(1, parts + 1):
        for head in itertools.combinations_with_replacement(range(1, steps), k - 1) if k > 1 else [()]:
            last = steps - sum(head)
            if last >= (head[-1] if head else 1):
                out.append((last, *reversed(head), *[0] * (parts - k)))
    return np.array(out, dtype=np.int64)


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by active sets; at most as many entries as rows are positive."""
    x, free = np.zeros(a.shape[1]), []
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(6 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[free] = -1
        j = int(gain.argmax())
        if gain[j] <= 1e-9 * scale:
            break
        free.append(j)
        while True:
            s = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = s <= 1e-12 * scale
            if not low.any():
                x[:] = 0
                x[free] = s
                break
            now = x[free]
            ratio = np.where(low, now / np.maximum(now - s, 1e-300), np.inf)
            now = now + min(1.0, float(ratio.min())) * (s - now)
            x[:] = 0
            x[free] = np.maximum(now, 0)
            stay = [f for f, v, l in zip(free, now, low, strict=True) if v > 1e-12 * scale and not (l and v <= 1e-12 * scale)]
            if len(stay) == len(free):  # no progress in floating point: drop the worst
                stay.remove(free[int(s.argmin())])
            free = stay
            if not free:
                break
    return x


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, repeats); all lengths of the histogram, each as often as counted."""
    left = np.zeros(size + 1, dtype=np.int64)
    for n, c in histogram.items():
        left[n] = c
    groups: list[tuple[tuple[int, ...], int]] = []
    step = -(-size // STEPS)
    full = int(left[size])
    left[size] = 0
    if full:
        groups.append(((size,), full))
    binned = np.zeros(STEPS + 1)
    np.add.at(binned, -(-np.arange(size + 1) // step), left)
    rows = patterns()
    a = np.zeros((STEPS + 1, len(rows)))
    for col in rows.T:
        np.add.at(a, (col, np.arange(len(rows))), col > 0)
    keep = (a[1:][binned[1:] == 0] == 0).all(axis=0)  # patterns of lengths that occur
    keep &= np.where(rows > 0, rows, STEPS).min(axis=1) >= LEAST
    rows, a = rows[keep], a[1:, keep]
    counts = np.floor(nnls(a, binned[1:]) + 1e-6).astype(np.int64) if len(rows) else np.zeros(0, np.int64)

    def take(lo: int, hi: int, want: int) -> Iterator[tuple[int, int]]:
        """Up to ``want`` documents with lengths of lo to hi, longest first."""
        for n in range(hi, lo - 1, -1):
            if want and left[n]:
                got = min(want, int(left[n]))
                left[n] -= got
                want -= got
                yield n, got

    for row, repeats in sorted(zip(rows.tolist(), counts.tolist(), strict=True), key=lambda x: x[0], reverse=True):
        if not repeats:
            continue
        parts = [p for p in row if p]
        open_groups = [((), int(repeats))]
        for k, p in enumerate(parts):
            last, nxt = k == len(parts) - 1, []
            for lens, c in open_groups:
                room = size - sum(lens)
                hi, lo = (room, max(1, (p - 2) * step + 1)) if last else (min(p * step, room), (p - 1) * step + 1)
                for n, got in take(lo, hi, c):
                    nxt.append(((*lens, n), got))
                    c -= got
                if c:
                    nxt.append((lens, c))
            open_groups = nxt
        for lens, c in open_groups:
            if sum(lens) == size:
                groups.append((lens, c))
            else:
                for n in lens:
                    left[n] += c
    # best-fit decreasing for the rest
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for lens, c in groups:
        by_room[size - sum(lens)].append((lens, c))
    rooms = np.zeros(size + 1, dtype=bool)
    for r, g in by_room.items():
        rooms[r] = bool(g)
    for n in range(size, 0, -1):
        c = int(left[n])
        while c:
            fits = np.flatnonzero(rooms[n:])
            if len(fits):
                r = n + int(fits[0])
                lens, have = by_room[r].pop()
                got = min(c, have)
                if got < have:
                    by_room[r].append((lens, have - got))
                rooms[r] = bool(by_room[r])
                by_room[r - n].append(((*lens, n), got))
                rooms[r - n] = True
                c -= got
            else:
                each = size // n
                whole, rest = divmod(c, each)
                for k, times in ((each, whole), (rest, 1)):
                    if k and times:
                        by_room[size - k * n].append(((n,) * k, times))
                        rooms[size - k * n] = True
                c = 0
    return [g for r in sorted(by_room) for g in by_room[r]]


def places(groups: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: where the pieces of a length go, by rank."""
    out, used, sequence = [], defaultdict(int), 0
    for lens, c in groups:
        at = 0
        for n in lens:
            out.append((n, used[n], sequence, at))
            used[n] += c
            at += n
        sequence += c
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 4)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Each document's ids with the end id, cut after every ``size``; a row for each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = common.chunks(tokenizer, MEMO)
        for batch in batches:
            for lo, hi in common.text_slices(batch.column(1)):
                flat, counts = coder.several(batch.column(1)[lo:hi])
                ends = np.cumsum(counts + 1)
                ids = np.full(len(flat) + len(counts), end_id, "<u4")
                mine = np.ones(len(ids), bool)
                mine[ends - 1] = False
                ids[mine] = flat
                n = -(-(counts + 1) // size)
                doc = np.repeat(np.arange(hi - lo), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                length = np.minimum(size, counts[doc] + 1 - start)
                at = ends[doc] - counts[doc] - 1 + start
                raw = memoryview(ids.view(np.uint8))
                crc = [zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(at.tolist(), length.tolist(), strict=True)]
                names = batch.column(0)[lo:hi].take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([names, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return common.id_text(docs).mapInArrow(common.tidy(run), PIECES)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048) -> DataFrame:
    """The pieces with sequence_id and offset. Null and empty texts are one piece of the end id alone.

    What reaches the driver is a count for each length (``size`` numbers); the plan it makes is bounded by those. The
    pieces' ranks come from counts by bucket and length, so no length's pieces meet in one task. Repeated rows are
    packed one by one; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = common.written(pieces(docs, tokenizer, size), common.shared_dir(spark))
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(4 * common.buckets(spark))))
    counts = cut.groupBy("_bucket", "length").agg(F.count(F.lit(1)).alias("_c"))
    histogram = {r["length"]: r["c"] for r in counts.groupBy("length").agg(F.sum("_c").alias("c")).collect()}
    where = places(plan(histogram, size))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_bucket").alias("_b"), F.col("length").alias("_l"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    ranked = cut.withColumn("_k", F.row_number().over(Window.partitionBy("_bucket", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(offsets, (F.col("_bucket") == F.col("_b")) & (F.col("length") == F.col("_l"))).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_k")).alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = np.int64(1) << np.int64(48)
        keys = where[:, 0] * span + where[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(k)) for k in ("length", "_rank"))
            i = np.searchsorted(keys, length * span + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(where[i, 2] + rank - where[i, 1]), pa.array(where[i, 3])], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(common.tidy(run), f"{PIECES}, sequence_id long, offset long")
