"""Checksums, words and payloads against plain Python; a log's sentences are made and checked once."""

from functools import reduce

from pyspark.sql import functions as F

from seatracks.operators import decode as D
from seatracks.operators import encode as E
from seatracks.plans import messages


def test_checksums(spark):
    texts = [None, "", "!", "!*", "*!", "!AIVDM,1,1,,A,x,0*55", "AIVDM*00", "!é\U0001f600ß*1*2", "!no star", "!a*", "", "!AI\nV*77", None]
    want = [None if t is None else "00" if not (t.startswith("!") and "*" in t) else f"{reduce(int.__xor__, t[1 : t.index('*')].encode(), 0):02X}" for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    got = df.select("i", D.checksum(F.col("s")).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == want
    assert df.limit(0).select(D.checksum(F.col("s"))).collect() == []


def words(payload, pad):
    value = lambda c: 0 if not "0" <= c <= "w" else ord(c) - 48 - (8 if ord(c) - 48 > 40 else 0)
    kept = max(len(payload) * 6 - pad, 0)
    bits = "".join(f"{value(c):06b}" for c in payload)[:kept]
    n = max(-(-len(bits) // 48), 4)
    bits = bits.ljust(n * 48, "0")
    return kept, [int(bits[i : i + 48], 2) for i in range(0, n * 48, 48)]


def test_words(spark):
    cases = [("", 0), ("", 5), ("w", 0), ("w", 3), ("15MgK45P3@G?fl0E`JbR0OwT0@MS", 0), ("w" * 9, 1), ("w" * 16, 5), ("5" * 71, 2), ("wéX\U0001f600_w/x" * 9, 4), ("ww", 9), ("0W`w" * 20, 0)]
    df = spark.createDataFrame([(i, p, n) for i, (p, n) in enumerate(cases)] + [(99, None, 0)], "i int, payload string, pad int").coalesce(1)
    got = D.to_words(df).orderBy("i").collect()
    assert [(r.bitlen, r.words) for r in got[:-1]] == [words(*c) for c in cases] and got[-1].words is None


def test_payloads(spark):
    texts = ["1" * 10, None, "0111100101"]
    value = lambda b: "".join(E.ARMOUR[int(b.ljust(12, "0")[i : i + 6], 2)] for i in (0, 6))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, b string").coalesce(1)
    assert [r.p for r in df.select("i", E.armour(F.col("b"), 10)[0].alias("p")).orderBy("i").collect()] == [None if t is None else value(t) for t in texts]


def test_sentences_are_made_once(spark):
    packets = messages._packets(spark, "/root/testdata/sf0.001")
    assert packets.count() > 0 and not [f for f in packets.inputFiles() if "events.parquet" in f]
