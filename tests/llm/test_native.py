"""Quality rules and sharding against brute force."""

import re
import zlib
from collections import Counter, defaultdict

from seatracks.llm import quality_rules as Q
from seatracks.llm.sharding import shard_by_bytes

from .corpus import SCHEMA, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def test_measures_equal_brute_force(spark):
    data = rows()
    got = Q.quality_rules(spark.createDataFrame(data, SCHEMA)).collect()
    want = sorted((d, *brute(t)) for d, t, *_ in data)
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_bad_hosts_lose_only_documents_that_break_a_stricter_limit(spark):
    clean, odd = " ".join(f"word{i}" for i in range(80)), " ".join(f"w{i} #" for i in range(60))
    data = [(i, "junk", "en", "bad", 4) for i in range(90)] + [(100, clean, "en", "bad", 1), (101, odd, "en", "bad", 1)]
    data += [(200 + i, clean, "en", "good", 1) for i in range(90)] + [(300, odd, "en", "good", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in Q.quality_rules(docs).where("kept").collect()}
    assert kept == {100, 300, *range(200, 290)}
    passed = Q.passing(docs)
    assert passed.columns == docs.columns and {r.doc_id for r in passed.collect()} == kept


def test_prior_shrinks_small_hosts():
    a, b = Q.beta_prior(1000, 300, 140.0, 10)
    assert 0.29 < a / (a + b) < 0.31 and (1 + a) / (1 + a + b) < 0.9
    assert Q.beta_prior(0, 0, 0.0, 0) == (1.0, 1.0)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert Q.quality_rules(docs).count() == Q.passing(docs).count() == shard_by_bytes(docs).count() == 0


def test_shards(spark):
    data = [*rows(), (None, None, None, None, None, None, None)]
    got = shard_by_bytes(spark.createDataFrame(data, SCHEMA), 8).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted((d or -1, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in data)
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    total, most, last = sum(r.size for r in got), max(r.size for r in got), -1
    for k in sorted(shards):
        part = sorted(shards[k], key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        assert abs(sum(r.size for r in part) - total / 8) <= most
        ids = [-1 if r.doc_id is None else r.doc_id for r in part]
        assert ids == sorted(ids) and ids[0] >= last
        last = ids[-1]
