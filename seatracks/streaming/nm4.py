"""Continuous decoding with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.decode import decode_positions, type_histogram, verify_sentences
from ..sources.readers import sentences


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line's place: its block's first byte and its number in the block. As a line has a byte at least, places grow
    with the order of lines and none occurs twice."""
    last, seen = None, 0
    for batch in batches:
        paths, starts = batch.column("path").dictionary_encode(), batch.column("_start").to_numpy()
        if not len(starts):
            continue
        path = paths.indices.to_numpy()
        cut = [0, *(np.flatnonzero((path[1:] != path[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist(), len(starts)]
        place = starts.copy()
        for i, j in zip(cut, cut[1:], strict=False):
            block = (paths.dictionary[int(path[i])].as_py(), int(starts[i]))
            seen = seen if block == last else 0
            place[i:j] += np.arange(seen, seen + j - i)
            last, seen = block, seen + j - i
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(place), batch.column("line")], ["path", "line_no", "line"])


def stream_nm4(spark: SparkSession, path: str, style: str = "dmas", **options: str) -> DataFrame:
    """path, line_no, date and sentence of new files in a folder. Files are read in blocks; ``line_no`` grows with the
    order of a file's lines, with gaps."""
    files = spark.readStream.options(**options).text(path)
    out = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), F.rtrim("value").alias("line"))
    return sentences(out.mapInArrow(_placed, "path string, line_no long, line string"), style)


def stream_packets(stream: DataFrame) -> DataFrame:
    """Messages of a single sentence; no state."""
    ok, _ = verify_sentences(stream)
    return ok.where("fragments <= 1").select("path", "line_no", F.col("sentence").alias("raw"), "payload", "pad", "date")


def stream_positions(stream: DataFrame) -> DataFrame:
    return decode_positions(stream_packets(stream))


def stream_histogram(packets: DataFrame) -> DataFrame:
    """Running counts by type, for output mode ``complete``."""
    return type_histogram(packets)


PART = "source string, channel string, path string, line_no long, raw string, payload string, pad int, date string, reject_reason string"
OPEN = "n int, have int, expires long, path string, line_no long, raw string, payload string, date string"
#: Why parts don't make a message.
ORPHAN, BROKEN, RESTARTED, EXPIRED = "no first part", "part out of turn", "another first part", "expired"


#: Rows that are Python objects at a time.
ROWS = 10_000
_PARTS = pa.schema([("path", pa.dictionary(pa.int32(), pa.string())), ("line_no", pa.int64()), ("sentence", pa.large_string()), ("payload", pa.large_string()), ("pad", pa.int32()), ("date", pa.large_string()), ("fragments", pa.int32()), ("fragment", pa.int32())])


def _in_order(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Parts by file and line. They are kept as Arrow columns; only so many rows at a time become Python objects."""
    parts = pa.Table.from_batches((pa.RecordBatch.from_pandas(f, _PARTS, preserve_index=False) for f in frames), _PARTS).unify_dictionaries().combine_chunks()
    path = parts["path"].combine_chunks() if parts.num_rows else pa.DictionaryArray.from_arrays(pa.array([], pa.int32()), pa.array([], pa.string()))
    rank = np.argsort(np.argsort(path.dictionary.to_numpy(zero_copy_only=False).astype(object))) if len(path.dictionary) else np.zeros(0, np.int64)
    order = np.lexsort((parts["line_no"].to_numpy(), rank[path.indices.to_numpy()]))
    for i in range(0, len(order), ROWS):
        yield from parts.take(pa.array(order[i : i + ROWS])).to_pandas().astype({"path": object}).itertuples(index=False)


class _Assembly(StatefulProcessor):
    """Parts of one source and channel in order; the state is the open message, whose timer is set anew by each part.

    As in a batch: parts belong to the first part before them, and a message is whole once its parts are 1 to the number
    that its first one states.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.open = handle, handle.getValueState("open", OPEN)

    def _frame(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(*key, *r) for r in rows], columns=[c.split()[0] for c in PART.split(", ")])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(self.open.get()) if self.open.exists() else None
        held, out = before, []
        lost = lambda m, why: out.append((m[3], m[4], m[5], m[6], None, m[7], why))
        for row in _in_order(rows):
            if len(out) >= ROWS:
                yield self._frame(key, out)
                out.clear()
            if row.fragment == 1:
                if held:
                    lost(held, RESTARTED)
                held = (row.fragments, 1, 0, row.path, row.line_no, row.sentence, row.payload, row.date)
            elif held and row.fragment == held[1] + 1:
                held = (held[0], held[1] + 1, 0, row.path, row.line_no, f"{held[5]}\n{row.sentence}", held[6] + row.payload, held[7])
            else:
                if held:
                    lost(held, BROKEN)
                lost((0, 0, 0, row.path, row.line_no, row.sentence, row.payload, row.date), BROKEN if held else ORPHAN)
                held = None
            if held and held[1] == held[0]:
                out.append((*held[3:7], row.pad, held[7], None))
                held = None
        if held != before:
            if before:
                self.handle.deleteTimer(int(before[2]))
                self.open.clear()
            if held:
                expires = int(timerValues.getCurrentProcessingTimeInMs()) + self.ttl_ms
                self.handle.registerTimer(expires)
                self.open.update((int(held[0]), int(held[1]), expires, held[3], int(held[4]), *held[5:]))
        yield self._frame(key, out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = tuple(self.open.get()) if self.open.exists() else None
        self.open.clear()
        yield self._frame(key, [(*held[3:7], None, held[7], EXPIRED)] if held else [])

    def close(self) -> None:
        pass


def stream_parts(stream: DataFrame, ttl_s: float = 3600, source: Column | None = None) -> DataFrame:
    """Messages of several sentences, and with a ``reject_reason`` the parts that make none.

    A message may lie in several files and triggers: the open one of each source and channel is state, and expires
    ``ttl_s`` after its last part, at the first trigger after that. A source is a folder of files unless a column is
    given; within a trigger its files count in order of their names. A trigger's parts of one source and channel are
    sorted by one task, so held there as Arrow columns; ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound its memory. Needs the RocksDB state store
    (``run_available`` sets it).
    """
    ok, _ = verify_sentences(stream)
    folder = F.regexp_replace("path", "/[^/]*$", "") if source is None else source
    parts = ok.where("fragments > 1").withColumn("source", folder).select("source", "channel", "path", "line_no", "sentence", "payload", "pad", "date", "fragments", "fragment")
    return parts.groupBy("source", "channel").transformWithStateInPandas(_Assembly(int(ttl_s * 1000)), PART, "append", "processingTime")


def stream_assembled(stream: DataFrame, ttl_s: float = 3600, source: Column | None = None) -> DataFrame:
    """Whole messages of several sentences; see ``stream_parts``."""
    return stream_parts(stream, ttl_s, source).where("reject_reason is null").select("path", "line_no", "raw", "payload", "pad", "date")


#: What assembly needs; and empty batches, which state with timers would otherwise ask for for ever.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def run_available(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there now, into a table at ``path``; in mode ``complete`` each trigger replaces it."""
    writer = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{path}/_progress")
    out = f"{path}/table"
    if mode == "complete":
        writer = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
    else:
        writer = writer.format("parquet").option("path", out)
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in SETTINGS}
    try:
        for key, value in SETTINGS.items():
            conf.set(key, value)
        writer.start().awaitTermination()
    finally:
        for key, value in before.items():
            conf.set(key, value)
    return df.sparkSession.read.schema(df.schema).parquet(out)
