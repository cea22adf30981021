import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from seatracks.llm import katz_lm as L

from .corpus import SCHEMA, rows


def tokens(t):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None]


class Brute:
    """The same model from dictionaries, token by token."""

    def __init__(self, data):
        train = [tokens(t) for d, t, *_ in data if zlib.crc32(("" if d is None else str(d)).encode()) % 10]
        self.c = Counter(w for ws in train for w in ws)
        self.pairs = Counter(p for ws in train for p in zip([None, *ws], ws, strict=False))
        self.n, self.v = sum(self.c.values()), len(self.c)
        tally = lambda k: np.array([sum(x == r for x in k.values()) for r in range(1, 7)])
        self.d1, self.d2 = L.discounts(tally(self.c)), L.discounts(tally(self.pairs))
        disc = lambda d, r: d[r] if r <= 5 else 1.0
        self.p1 = {w: disc(self.d1, r) * r / self.n for w, r in self.c.items()}
        left = 1 - sum(self.p1.values())
        self.unk = max(left, 1 / (self.n + 1))
        self.p1 = {w: p * (1 - self.unk) / (1 - left) for w, p in self.p1.items()}
        self.after: dict = {}
        for (v, w), r in self.pairs.items():
            self.after.setdefault(v, {})[w] = disc(self.d2, r) * r / self.c[v]

    def p(self, v, w):
        low = self.p1.get(w, self.unk)
        if v not in self.after:
            return low
        seen = self.after[v]
        kept = sum(seen.values())
        left = max(1 - kept, 0.5 / self.c[v])
        if w in seen:
            return seen[w] * (1 - left) / kept
        return left * low / (1 - sum(self.p1[x] for x in seen))

    def score(self, t):
        ws = tokens(t)
        return sum(math.log10(self.p(v, w)) for v, w in zip([None, *ws], ws, strict=False))


@pytest.mark.parametrize(("chunk", "spread"), [(1 << 20, 8), (300, 1), (300, 200)])
def test_scores_equal_brute_force(spark, monkeypatch, chunk, spread):
    monkeypatch.setattr(L, "CHUNK", chunk)
    monkeypatch.setattr(L, "SPREAD", spread)
    data = [*rows(), *[(1000 + i, t, l, s, n, a, b) for i, t, l, s, n, a, b in rows(9)], (None, "no id", "en", "h", 1, "", "")]
    got = L.katz_scores(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    m = Brute(data)
    base = lambda t: sum(math.log10((m.c[w] + 0.1) / (m.n + 0.1 * (m.v + 1))) for w in tokens(t))
    want = sorted((-1 if d is None else d, zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0, len(tokens(t)), sum(m.c[w] > 0 for w in tokens(t)), m.n, base(t), m.score(t)) for d, t, *_ in data)
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [x[:5] for x in have] == [x[:5] for x in want]
    assert np.allclose([x[5:] for x in have], [x[5:] for x in want], rtol=1e-9)


def test_model_sums_to_one():
    m = Brute([(i, t, *r) for i, t, *r in rows() if t])
    assert abs(sum(m.p1.values()) + m.unk - 1) < 1e-9
    for v in list(m.after)[:40]:
        assert abs(sum(m.p(v, w) for w in m.c) + m.p(v, "never seen") - 1) < 1e-9


def test_empty_and_untrained(spark):
    assert L.katz_scores(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = L.katz_scores(spark.createDataFrame([(lone, "a b", None, None, None, None, None)], SCHEMA)).collect()[0]
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.score) == (True, 3, 0, 0, 0.0)


def test_discounts():
    d = L.discounts(np.array([1000, 400, 220, 140, 100, 75]))
    assert (d[1:] > 0).all() and (d[1:] < 1).all() and (np.diff(d[1:]) > 0).all()
    assert (L.discounts(np.zeros(6))[1:] > 0).all()
