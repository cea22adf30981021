"""Substring dedup with a log-structured index of window fingerprints.

The index is a list of immutable runs, each a table bucketed by ranges of hashes, with sorted fingerprints (a 64-bit hash
and a 16-bit check from another hash) and the smallest doc_id that has the window. A batch's windows are sorted and cut
into the same buckets inside each task; what a task itself finds to be repeated needs no exchange of its fingerprint. One
exchange brings a bucket's slices to where the runs lie: these are read in place, not shuffled. There batch and runs are
merged, a match counts only if the check agrees too, and the batch's own sorted fingerprints come out as the next run.
Before a batch, the newest runs are compacted while there are two of one level, so a window is rewritten as often as the
logarithm of the number of batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Words of a window; windows that a task sorts at once; batches of a one-off pass; bytes of text for each bucket.
WINDOW, CHUNK, BATCHES, BUCKET_BYTES = 13, 1 << 20, 4, 8 << 20

SLICE = "kind int, bucket int, docs binary, keys binary, docs_of binary, hashes binary, checks binary, places binary"
_NAMES = [x.split()[0] for x in SLICE.split(", ")]
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), *[(n, pa.binary()) for n in _NAMES[2:]]])
#: What merging gives: matches of documents by home (ids, keys and places), and a run's slice (hashes, checks and owners).
MERGED = "kind int, bucket int, home int, x binary, y binary, z binary"
_MERGED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("home", pa.int32()), *[(n, pa.binary()) for n in "xyz"]])
#: Kinds of rows: slices of a batch, matches, slices of a run.
BATCH, MATCH, RUN = range(3)


def fingerprints(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    other = common.windows(common.mix(h ^ common.MIX2), WINDOW)
    return common.windows(h, WINDOW), (other >> np.uint64(48)).astype("<u2")


def _edges(n: int) -> np.ndarray:
    """The least hash of each bucket but the first; buckets are equal ranges of hashes."""
    return np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def _by_home(doc: np.ndarray, key: np.ndarray, place: np.ndarray, homes: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Matches in one piece for each home of documents, in order of document and place."""
    home = _home(doc, key, homes)
    by = np.lexsort((place, doc, home))
    cut = [0, *(np.flatnonzero(np.diff(home[by])) + 1).tolist(), len(by)] if len(by) else [0]
    for i, j in zip(cut, cut[1:], strict=False):
        k = by[i:j]
        yield int(home[k[0]]), common.packed(doc[k]), common.packed(key[k]), common.packed(place[k].astype("<u4"))


def slices(docs: DataFrame, buckets: int) -> DataFrame:
    """The sorted window fingerprints of a batch (doc_id, text, key), a row for each chunk of documents and bucket.

    A window that a document of the chunk with a smaller id has is a match at once. So of a window that is everywhere a
    chunk sends one document's places only, and no bucket grows with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(buckets)
        ids: list[int] = []
        keys: list[int] = []
        hs: list[np.ndarray] = []
        cs: list[np.ndarray] = []
        held = 0

        def flush() -> pa.Table:
            nonlocal ids, keys, hs, cs, held
            starts = np.cumsum([0, *map(len, hs)])[:-1]
            h, c, doc, key = np.concatenate(hs), np.concatenate(cs), np.array(ids, "<i8"), np.array(keys, "<i8")
            ids, keys, hs, cs, held = [], [], [], [], 0
            order = np.argsort(h)
            h, c = h[order], c[order]
            local = np.repeat(np.arange(len(doc)), np.diff(starts, append=len(h)))[order]
            owner = doc[local]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            hit = owner > np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1]
            at = local[hit]
            rows = [(MATCH, home, x, y, None, None, None, z) for home, x, y, z in _by_home(doc[at], key[at], order[hit] - starts[at], buckets)]
            h, c, local, place = h[~hit], c[~hit], local[~hit], (order[~hit] - starts[local[~hit]]).astype("<u4")
            cut = [0, *np.searchsorted(h, edges).tolist(), len(h)]
            for b, (i, j) in enumerate(zip(cut, cut[1:], strict=False)):
                if j > i:  # with the documents of this slice alone
                    mine, of = np.unique(local[i:j], return_inverse=True)
                    rows.append((BATCH, b, *map(common.packed, (doc[mine], key[mine], of.astype("<u4"), h[i:j], c[i:j], place[i:j]))))
            return _table(rows, _SCHEMA)

        for batch in batches:
            for doc, text, key in zip(*batch.columns, strict=True):
                h, c = fingerprints(common.word_hashes(common.words_of(text.as_py())))
                if len(h):
                    ids.append(doc.as_py())
                    keys.append(key.as_py())
                    hs.append(h)
                    cs.append(c)
                    held += len(h)
                    if held >= CHUNK:
                        yield from flush().to_batches()
        if ids:
            yield from flush().to_batches()

    return docs.mapInArrow(common.tidy(run), SLICE)


def _merged(h: np.ndarray, c: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """order, group of each sorted entry, and hash, check and smallest doc of each group of equal fingerprints."""
    order = np.argsort(h)
    if ((h[order][1:] == h[order][:-1]) & (c[order][1:] != c[order][:-1])).any():  # hashes that collide
        order = np.lexsort((c, h))
    h, c, doc = h[order], c[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(new)
    return order, np.cumsum(new) - 1, h[first], c[first], np.minimum.reduceat(doc, first) if len(first) else doc


def _merge_join(table: pa.Table, runs: pa.Table, buckets: int) -> pa.Table:
    """One bucket: the matches of the batch's documents with the batch and the runs, and the batch's slice of its run."""
    get = {n: table.column(n).to_pylist() for n in _NAMES}
    of_runs = runs.to_pylist()[0]
    bucket = of_runs["bucket"]
    # runs come first, then the batch's slices
    parts = [(common.unpacked(of_runs[f"x{k}"], "<u8"), common.unpacked(of_runs[f"y{k}"], "<u2"), common.unpacked(of_runs[f"z{k}"], "<i8")) for k in range((len(of_runs) - 1) // 3)]
    before = sum(len(x) for x, _, _ in parts)
    rows, ids, keys, doc_of, place, n_docs = [], [np.zeros(0, "<i8")], [np.zeros(0, "<i8")], [np.full(before, -1, np.int64)], [np.zeros(before, np.int64)], 0
    for i, kind in enumerate(get["kind"]):
        if kind == MATCH:
            rows.append((MATCH, bucket, bucket, get["docs"][i], get["keys"][i], get["places"][i]))
            continue
        docs, local = common.unpacked(get["docs"][i], "<i8"), common.unpacked(get["docs_of"][i], "<u4").astype(np.int64)
        parts.append((common.unpacked(get["hashes"][i], "<u8"), common.unpacked(get["checks"][i], "<u2"), docs[local]))
        doc_of.append(local + n_docs)
        place.append(common.unpacked(get["places"][i], "<u4").astype(np.int64))
        ids.append(docs)
        keys.append(common.unpacked(get["keys"][i], "<i8"))
        n_docs += len(docs)
    h, c, owner = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, t) for t in ("<u8", "<u2", "<i8"))
    order, group, gh, gc, least = _merged(h, c, owner)
    doc = np.concatenate(doc_of)[order]
    own = doc >= 0
    hit = own & (owner[order] > least[group])
    at = doc[hit]
    rows += [(MATCH, bucket, *x) for x in _by_home(np.concatenate(ids)[at], np.concatenate(keys)[at], np.concatenate(place)[order][hit], buckets)]
    mine = np.zeros(len(gh), bool)
    mine[group[own]] = True
    # of a window in a run too, the run keeps the smallest owner of all
    rows.append((RUN, bucket, None, common.packed(gh[mine]), common.packed(gc[mine]), common.packed(least[mine].astype("<i8"))))
    return _table(rows, _MERGED)


def _home(doc_ids: np.ndarray, keys: np.ndarray, homes: int) -> np.ndarray:
    return (common.mix(doc_ids.astype(np.uint64) ^ keys.astype(np.uint64)) % np.uint64(homes)).astype(np.int64)


def _gather(table: pa.Table) -> pa.Table:
    """One home: the places of repeated windows of each of its documents."""
    doc, key = (np.concatenate([common.unpacked(x, "<i8") for x in table.column(n).to_pylist()]) for n in "xy")
    place = np.concatenate([common.unpacked(x, "<u4") for x in table.column("z").to_pylist()])
    order = np.lexsort((place, key, doc))
    doc, key, place = doc[order], key[order], place[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]))
    places = [place[i:j].tobytes() for i, j in zip(first.tolist(), [*first[1:].tolist(), len(place)], strict=True)]
    return pa.Table.from_arrays([pa.array(doc[first]), pa.array(key[first]), pa.array(places, pa.binary())], ["doc_id", "key", "places"])


def _compact(one: dict) -> tuple:
    """One bucket of some runs as one run."""
    n = (len(one) - 1) // 3
    h, c, o = (np.concatenate([common.unpacked(one[f"{v}{k}"], t) for k in range(n)]) for v, t in (("x", "<u8"), ("y", "<u2"), ("z", "<i8")))
    _, _, gh, gc, least = _merged(h, c, o)
    return RUN, one["bucket"], None, common.packed(gh), common.packed(gc), common.packed(least.astype("<i8"))


class FingerprintIndex:
    """The runs of an index in a shared folder. A batch is matched with all that came before and within itself.

    A run is an external table bucketed by ``bucket``, with a row for each bucket, so runs are joined and met in place.
    """

    def __init__(self, spark: SparkSession, home: str, buckets: int):
        self.spark, self.home, self.buckets = spark, home, buckets
        self.runs: list[tuple[str, int]] = []  # tables and their levels, oldest first
        empty = common.packed(np.zeros(0, "<u8"))
        every = spark.range(buckets).select(F.lit(RUN).alias("kind"), F.col("id").cast("int").alias("bucket"), F.lit(None).cast("int").alias("home"), *[F.lit(empty).alias(v) for v in "xyz"])
        self.start = self._saved(every)

    def _saved(self, df: DataFrame) -> str:
        name = f"seatracks_{uuid.uuid4().hex}"
        with common.cleaned(self.spark):
            df.write.partitionBy("kind").bucketBy(self.buckets, "bucket").option("path", f"{self.home}/{name}").option("compression", "zstd").saveAsTable(name)
        return name

    def _run(self, name: str, k: int) -> DataFrame:
        return self.spark.table(name).where(F.col("kind") == RUN).select("bucket", *[F.col(v).alias(f"{v}{k}") for v in "xyz"])

    def _side_by_side(self, names: list[str]) -> DataFrame:
        """A row for each bucket with its slices of all the runs; none is shuffled."""
        return reduce(lambda a, b: a.join(b.hint("merge"), "bucket", "left"), [self._run(n, k) for k, n in enumerate(names)])

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        common.removed(self.spark, f"{self.home}/{name}/kind={RUN}")

    def add(self, docs: DataFrame) -> DataFrame:
        """Matches a batch (doc_id, text, key), which becomes the next run; returns the places of windows that also start
        in a document with a smaller doc_id, packed, for ``gathered``."""
        while len(self.runs) > 1 and self.runs[-1][1] == self.runs[-2][1]:
            self.compact(2)
        buckets = self.buckets
        held = self._side_by_side([self.start, *[n for n, _ in self.runs]])
        name = self._saved(slices(docs, buckets).groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(lambda a, b: _merge_join(a, b, buckets), MERGED))
        self.runs.append((name, 0))
        return self.spark.read.schema(MERGED.replace("kind int, ", "")).parquet(f"{self.home}/{name}/kind={MATCH}") if self._matched(name) else self.spark.createDataFrame([], MERGED)

    def _matched(self, name: str) -> bool:
        return bool(self.spark.table(name).where(F.col("kind") == MATCH).take(1))

    def compact(self, newest: int) -> None:
        """The newest runs into one of the next level; what they were is removed once that is written."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for one in batch.to_pylist():
                    yield from _table([_compact(one)], _MERGED).to_batches()

        old = self.runs[-newest:]
        name = self._saved(self._side_by_side([self.start, *[n for n, _ in old]]).mapInArrow(common.tidy(run), MERGED))
        self.runs = [*self.runs[:-newest], (name, max(level for _, level in old) + 1)]
        for n, _ in old:
            self._drop(n)

    def drop(self) -> None:
        """Removes all runs."""
        for n in (self.start, *[n for n, _ in self.runs]):
            self._drop(n)
        self.runs = []


def gathered(found: DataFrame) -> DataFrame:
    """doc_id, key and places of all documents of the matches of one or more batches."""
    return found.groupBy("home").applyInArrow(_gather, "doc_id long, key long, places binary")


def repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, key and the places of repeated windows of the documents that have any.

    The table is taken in even batches of rising doc_id, each of which becomes a run of an index; as nothing asks that
    index afterwards, it is removed.
    """
    spark = docs.sparkSession
    home = common.shared_dir(spark)
    rows = common.id_text(docs).where("doc_id is not null and text is not null").withColumn("key", F.xxhash64("text"))
    marks = sorted(set(rows.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01))) if batches > 1 else []
    index = FingerprintIndex(spark, home, common.buckets(spark, rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"], BUCKET_BYTES))
    found = None
    for lo, hi in zip([None, *marks], [*marks, None], strict=True):
        batch = rows if lo is None else rows.where(F.col("doc_id") > F.lit(int(lo)))
        batch = batch if hi is None else batch.where(F.col("doc_id") <= F.lit(int(hi)))
        part = index.add(batch).select("home", "x", "y", "z")
        found = part if found is None else found.union(part)
    out = common.written(gathered(found).select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), F.col("places").alias("_places")), f"{home}/repeats")
    index.drop()
    return out


def kept_words(text: str | None, places: bytes | None) -> tuple[list[bytes], int]:
    """The words outside the repeated windows, and the number of all words."""
    words = common.words_of(text)
    if not places:
        return words, len(words)
    at = np.unique(np.frombuffer(places, "<u4")).astype(np.int64)
    edge = np.zeros(len(words) + WINDOW + 1, np.int64)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    keep = np.cumsum(edge)[: len(words)] == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k], len(words)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words, joined by one space, in UTF-8) of each document.

    Null and short texts keep all they have. A row without doc_id is neither changed nor a source. Rows of one doc_id
    don't count as each other's source. Other columns are ignored; an empty table gives an empty result.
    """
    joined = common.id_text(docs).withColumn("_k", F.xxhash64("text")).join(repeats(docs), (F.col("doc_id") == F.col("_doc")) & (F.col("_k") == F.col("_key")), "left").select("doc_id", "text", "_places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                ids, texts, places = (batch.column(k).slice(lo, 512) for k in range(3))
                rows = [(n, n - len(w), b" ".join(w)) for w, n in (kept_words(t.as_py(), p.as_py()) for t, p in zip(texts, places, strict=True))]
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)]], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(common.tidy(run), "doc_id long, n_words long, n_removed long, kept binary")


def deduped_documents(docs: DataFrame) -> DataFrame:
    """The same rows and columns; a text that loses words becomes its kept words joined by one space, and ``n_chars``
    (if there) is counted anew; other texts stay as they are. Null texts and rows without doc_id stay; repeated rows lose
    the same words; an empty table gives none. Other columns may have any names."""
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    width = len(docs.columns)
    k, doc, key, places = common.free(docs, "_k", "_doc", "_key", "_places")
    found = repeats(docs).toDF(doc, key, places)
    joined = docs.withColumn(k, F.xxhash64(F.col("text").cast("string"))).join(found, (F.col("doc_id").cast("long") == F.col(doc)) & (F.col(k) == F.col(key)), "left").drop(k, doc, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() if p.as_py() is None else b" ".join(kept_words(t.as_py(), p.as_py())[0]).decode("utf-8", "surrogatepass") for t, p in zip(batch.column(at), batch.column(width), strict=True)]
            cols = list(batch.columns[:width])
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            if chars is not None:
                changed = [n.as_py() if p.as_py() is None else len(t) for n, t, p in zip(batch.column(chars), texts, batch.column(width), strict=True)]
                cols[chars] = pa.array(changed, batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names[:width])

    return joined.mapInArrow(common.tidy(run), docs.schema)

