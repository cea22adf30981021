import random
import re

import numpy as np
import pytest

from seatracks.llm import near_dedup as N

from .corpus import SCHEMA, rows


def brute(data):
    sets = {}
    for d, t, *_ in data:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = sorted(sets)
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


def chain(seed):
    """Documents that drift word by word: neighbours are similar, the ends are not."""
    rng = random.Random(seed)
    words = [f"c{seed}w{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for k in range(25):
        words[(4 * k) % 120] = f"n{seed}{k}"
        out.append((1000 * seed + 900 - k, " ".join(words), "en", "h", 1, "", ""))
    return out


@pytest.mark.parametrize("data", [rows(), rows(2) + chain(1) + chain(2)])
def test_components_equal_brute_force(spark, data):
    got = N.near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()
    want = brute(data)
    assert len(got) == len(data)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_empty_and_null(spark):
    assert N.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f", None, None, None, None, None), (7, "a b c d e f", None, None, None, None, None)], SCHEMA)
    assert {(r.doc_id, r.component_id, r.kept) for r in N.near_duplicates(docs).collect()} == {(None, None, True), (7, 7, True)}
    assert N.kept_documents(docs).columns == docs.columns and N.kept_documents(docs).count() == 2


def test_estimate_is_near_the_similarity(spark):
    rng = np.random.default_rng(1)
    data = []
    for share in range(0, 1000, 50):
        pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
        m = np.array([N.minima(pool[:1000]), N.minima(pool[1000 - share : 2000 - share])])
        bits = N.packed_bits(m).tolist()
        data.append((share / (2000 - share), bits[0], bits[1]))
    got = spark.createDataFrame(data, "j double, x array<long>, y array<long>").select("j", N.estimate("x", "y").alias("e")).collect()
    assert all(abs(r.e - r.j) < 0.2 for r in got) and abs(sum(r.e - r.j for r in got)) / len(got) < 0.04
