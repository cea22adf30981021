"""Inputs that once stopped a task: doubling constants, clashing names, null and broken media."""

import time

from pyspark.sql import functions as F

from seatracks.llm import gif_media, near_dedup, secret_scan, substring_dedup

from .corpus import SCHEMA, rows


def test_constants_that_double_each_line():
    text = 'a0 = "Zk3Qp9Lm2Xv8Rt5W"\n' + "".join(f"a{i + 1} = a{i} + a{i}\n" for i in range(60)) + "password = a60\n"
    began = time.time()
    found = secret_scan.spans(text)
    assert time.time() - began < 1 and [(text[a:b], k) for a, b, k, _ in found] == [("Zk3Qp9Lm2Xv8Rt5W", "lexed")]


def test_long_sums_are_read_in_time():
    text = "".join(f'k{i} = k{i - 1} + "q8Zr5Tn1Lw0Xc7Vb{i}"\ntoken = k{i}\n' for i in range(1, 20_000))
    began = time.time()
    found = [s for s in secret_scan.spans(text) if s[2] == "lexed"]
    assert time.time() - began < 5 and len(found) == 20_000 - 1 + 1  # and the first name, which stands for nothing known


def test_names_that_clash(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    odd = docs.withColumns({c: F.lit(3) for c in ("_k", "_doc", "_key", "_places", "_gone", "_K_")})
    for run in (substring_dedup.deduped_documents, near_dedup.kept_documents):
        got = run(odd)
        assert got.columns == odd.columns
        assert sorted(map(repr, got.select(docs.columns).collect())) == sorted(map(repr, run(docs).collect()))


def test_null_and_broken_media(spark):
    good = gif_media.stored_all([gif_media.padded("some text"), gif_media.padded("another " * 200)])
    media = [(0, 9, bytes(good[0])), (1, 9, None), (2, 9, bytes(good[1])[:200]), (3, 9, b""), (4, 9, b"GIF89a\x01\x00\x01\x00\x00\x00\x00,"), (5, 9, bytes(good[1]))]
    got = {r.doc_id: r for r in gif_media.media_features(spark.createDataFrame(media, "doc_id long, n_bytes long, media binary").coalesce(1)).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5] and got[0].n_frames == 1 and got[5].n_frames > 1
    assert got[1].media_bytes is None and got[1].frames is None and got[3].media_bytes == 0
    alone = {r.doc_id: r for r in gif_media.media_features(spark.createDataFrame([media[0], media[5]], "doc_id long, n_bytes long, media binary")).collect()}
    assert all(alone[k] == got[k] for k in (0, 5))
    frames = gif_media.timed_frames(spark.createDataFrame(media, "doc_id long, n_bytes long, media binary")).groupBy("doc_id").count().collect()
    assert {r.doc_id for r in frames} >= {0, 5} and 1 not in {r.doc_id for r in frames}
