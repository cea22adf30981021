"""Exact duplicates against brute force: collisions, splits, batches, interrupted batches."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from seatracks.llm import common
from seatracks.llm.exact_dedup import MAX_DEPTH, ExtendibleIndex, directory, exact_duplicates

from .corpus import SCHEMA, rows

LAST = 1 << 62


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(data):
    groups = defaultdict(list)
    for d, t, *_ in data:
        groups[normal(t)].append(LAST if d is None else d)
    low = lambda t: min(groups[normal(t)])
    return sorted((LAST if d is None else d, low(t), len(groups[normal(t)]), (LAST if d is None else d) == low(t), hashlib.sha256(normal(t).encode()).hexdigest()) for d, t, *_ in data)


def got(df):
    null = lambda x: LAST if x is None else x
    return sorted((null(r.doc_id), null(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in df.collect())


def table():
    data = rows()
    more = [(1000 + i, t, "en", "h1", 1, "x", "y") for i, t in enumerate(["a  b", "a b", "a\tb", "a\n b", "a\xa0b", " a b", "a b ", None, "", " ", "\x0b", "\x1c"])]
    hot = [(2000 + i, "the same " * 3, "en", "h1", 1, "x", "y") for i in range(60)]
    return data + more + hot + [(None, "a b", None, None, None, None, None), (None, "only null", None, None, None, None, None), (None, "only null", None, None, None, None, None), (-5, "the same " * 3, "", "", 0, "", "")]


@pytest.mark.parametrize("bits", [64, 4, 0])
def test_equals_brute_force(spark, bits):
    """With few bits, almost all keys collide; with none, all texts are one chain."""
    data = table()
    assert got(exact_duplicates(spark.createDataFrame(data, SCHEMA), capacity=2000, key_bits=bits)) == brute(data)


def test_long_text_and_names_that_clash(spark):
    long = "word " * 400_000
    data = [(3, long), (1, long.replace(" ", "\n\n")), (2, long + "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("_h", "_t", "_id", "bucket", "keep_id", "cell", "key")})
    assert got(exact_duplicates(docs)) == brute(data)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_batches_equal_all_at_once_and_an_interrupted_one_is_no_part(spark):
    data = [r for r in table() if r[0] is not None]
    path = common.shared_dir(spark)
    for k in range(3):
        ExtendibleIndex(spark, path, capacity=1500).add(spark.createDataFrame(data[k::3], SCHEMA))
        spark.createDataFrame([(1,)], "x int").write.parquet(f"{path}/g{k * 2 + 1}/keys")  # as a session leaves it that stops
    index = ExtendibleIndex(spark, path, capacity=1500)
    assert index.generations() == [0, 2, 4]
    want = {(k, n, h) for _, k, n, _, h in brute(data)}
    assert {(r.keep_id, r.group_size, r.text_sha256) for r in index.entries().collect()} == want and index.entries().count() == len(want)
    index.prune()
    assert index.generations() == [4] and index.entries().count() == len(want)


def test_directory_splits_overfull_buckets_only(spark):
    cell = lambda bits: int(bits.ljust(MAX_DEPTH, "0"), 2)
    loads = [(cell("0"), 3, 1), (cell("100"), 5, 2), (cell("101"), 5, 2), (cell("11"), 4, 1), (cell("1111"), 90, 1)]
    held = directory(spark.createDataFrame(loads, "cell long, load long, n long"), 10).groupBy("bucket", "depth").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {(r.bucket, r.depth, r.n) for r in held} == {(cell(p), len(p), 1 << (MAX_DEPTH - len(p))) for p in ("0", "10", "110", "111")}


def test_no_python_and_owners_take_whole_buckets(spark):
    df = exact_duplicates(spark.createDataFrame(table(), SCHEMA), capacity=1500)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
