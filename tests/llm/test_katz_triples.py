import math
import zlib
from collections import Counter

import numpy as np
import pytest

from seatracks.llm import katz_lm as L
from seatracks.llm import llm_queries as Q

from .corpus import SCHEMA, rows
from .test_katz_lm import Brute, tokens


class Triples(Brute):
    """Order 3 over the pair model, token by token."""

    def __init__(self, data):
        super().__init__(data)
        train = [tokens(t) for d, t, *_ in data if zlib.crc32(("" if d is None else str(d)).encode()) % 10]
        self.triples = Counter(x for ws in train for x in zip([None, None, *ws], [None, *ws], ws, strict=False))
        self.contexts = Counter()
        for (u, v, _), r in self.triples.items():
            self.contexts[u, v] += r
        d = L.discounts(np.array([sum(x == r for x in self.triples.values()) for r in range(1, 7)]))
        self.after2: dict = {}
        for (u, v, w), r in self.triples.items():
            self.after2.setdefault((u, v), {})[w] = (d[r] if r <= 5 else 1.0) * r / self.contexts[u, v]

    def p3(self, u, v, w):
        seen = self.after2.get((u, v))
        if not seen:
            return self.p(v, w)
        kept = sum(seen.values())
        left = max(1 - kept, 0.5 / self.contexts[u, v])
        return seen[w] * (1 - left) / kept if w in seen else left * self.p(v, w) / (1 - sum(self.p(v, x) for x in seen))

    def score(self, t):
        ws = tokens(t)
        return sum(math.log10(self.p3(*x)) for x in zip([None, None, *ws], [None, *ws], ws, strict=False))


@pytest.mark.parametrize(("chunk", "spread"), [(1 << 20, 8), (300, 1), (300, 200)])
def test_scores_equal_brute_force(spark, monkeypatch, chunk, spread):
    monkeypatch.setattr(L, "CHUNK", chunk)
    monkeypatch.setattr(L, "SPREAD", spread)
    data = [*rows(), *[(1000 + i, t, l, s, n, a, b) for i, t, l, s, n, a, b in rows(9)], (None, "no id", "en", "h", 1, "", "")]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    monkeypatch.setattr(Q.common, "load", lambda *_: df)
    got = {r.doc_id: r.score for r in Q.op5_katz_lm(spark, "").collect()}
    m = Triples(data)
    want = {d: m.score(t) for d, t, *_ in data}
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()), rtol=1e-9)


def test_triples_sum_to_one():
    m = Triples([(i, t, *r) for i, t, *r in rows() if t])
    for u, v in list(m.after2)[:25]:
        assert abs(sum(m.p3(u, v, w) for w in m.c) + m.p3(u, v, "never seen") - 1) < 1e-9
