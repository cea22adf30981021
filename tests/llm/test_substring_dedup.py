import re

import pytest
from pyspark.sql import functions as F

from seatracks.llm import substring_dedup as S

from .corpus import SCHEMA, rows


def brute(data):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in data]
    least = {}
    for d, w in words:
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            if d is not None:
                least[key] = min(least.get(key, d), d)
    out = []
    for d, w in words:
        gone = {i + j for i in range(len(w) - 12) if d is not None and least[tuple(w[i : i + 13])] < d for j in range(13)}
        out.append((-1 if d is None else d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone).encode()))
    return sorted(out)


@pytest.mark.parametrize("data", [rows(), [*rows(4), (None, rows(4)[3][1], "en", "h", 1, "", ""), (5000, rows(4)[7][1], "en", "h", 1, "", ""), (5000, "other text", "en", "h", 1, "", "")]])
def test_equals_brute_force(spark, data):
    docs = spark.createDataFrame(data, SCHEMA)
    got = S.substring_dedup(docs).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == brute(data)
    clean = S.deduped_documents(docs)
    assert clean.columns == docs.columns
    want = {d: k for d, _, n, k in brute(data) if n and d != 5000}
    assert all(r.text.encode() == want[r.doc_id] and r.n_chars == len(r.text) for r in clean.collect() if r.doc_id in want)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert S.substring_dedup(docs).count() == 0 and S.deduped_documents(docs).count() == 0
    short = spark.createDataFrame([(1, None, None, None, None, None, None), (2, "a b", None, None, None, None, None)], SCHEMA)
    assert {(r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in S.substring_dedup(short).collect()} == {(1, 0, 0, b""), (2, 2, 0, b"a b")}


def test_index_over_many_batches_in_any_order(spark, tmp_path):
    data = [r for r in rows(6) if r[0] is not None and r[1] is not None]
    docs = spark.createDataFrame(data, SCHEMA).select("doc_id", "text").withColumn("key", F.xxhash64("text"))
    index = S.FingerprintIndex(spark, str(tmp_path), 4)
    index.add(docs.where("doc_id < 20"))
    index.add(docs.where("doc_id between 20 and 50"))
    index.add(docs.where("doc_id between 51 and 70"))
    assert [level for _, level in index.runs] == [1, 0]  # two of one level were compacted
    found = S.gathered(index.add(docs.where("doc_id > 70")).select("home", "x", "y", "z")).collect()
    assert [level for _, level in index.runs] == [1, 0, 0]
    text = {r[0]: r[1] for r in data}
    got = {r.doc_id: len(S.common.words_of(text[r.doc_id])) - len(S.kept_words(text[r.doc_id], r.places)[0]) for r in found}
    assert got == {d: n for d, _, n, _ in brute(data) if d > 70 and n}
    index.drop()
    assert not [f for f in tmp_path.rglob("kind=2/*") if f.is_file()]


def test_runs_are_read_in_place(spark, tmp_path):
    docs = spark.createDataFrame(rows(6), SCHEMA).where("doc_id is not null and text is not null").select("doc_id", "text").withColumn("key", F.xxhash64("text"))
    index = S.FingerprintIndex(spark, str(tmp_path), 4)
    for k in range(2):
        index.add(docs.where(F.col("doc_id") % 2 == k))
    plan = index._side_by_side([index.start, *[n for n, _ in index.runs]])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 3
    index.drop()


def test_window_that_is_everywhere_is_sent_once_for_each_chunk(spark):
    docs = spark.createDataFrame([(i, " ".join(map(str, range(20)))) for i in range(100)], "doc_id long, text string").withColumn("key", F.lit(0).cast("long")).coalesce(1)
    got = S.slices(docs, 4).collect()
    sent = sum(len(S.common.unpacked(r.hashes, "<u8")) for r in got if r.kind == S.BATCH)
    assert sent == 8 and sum(len(S.common.unpacked(r.places, "<u4")) for r in got if r.kind == S.MATCH) == 8 * 99
