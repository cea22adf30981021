"""Chunk encoding, Simple-8b files, packing and the BPE transducer against the tokenizers library and brute force."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from seatracks.llm import bpe_stream, common, packing, simple8b

from .corpus import SCHEMA, rows

WORD, BYTE = (common.tokenizer_path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "  a\n\n b \t\x85c d ", "Let's GO, it'S we'll 12345 x1y2", "<|endoftext|> a  <|endoftext|>b", "ΑΣΣ ſḰ İx Ångström é", "a\x1cb \x1f c", "日本語 テキスト 😀😀", "z" * 3000, "ab" * 2000 + "'s'ss", "​﻿x　y"]


def texts():
    rng = random.Random(3)
    alphabet = "abcdeéàß 漢😀'.-0123\n\t<|> "
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(150)] + [r[1] or "" for r in rows()]


def raw(tok, t):
    return np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunks_equal_the_library(path):
    tok, mine = Tokenizer.from_file(path), common.Chunks(path, most=50)
    for t in texts():
        assert mine.one(t) == raw(tok, t), t[:60]


def test_transducer_equals_the_library():
    tok, (mine, machine) = Tokenizer.from_file(WORD), bpe_stream.made(WORD)
    for t in texts():
        ids = mine.encode(t)
        assert ids == raw(tok, t), t[:60]
        seq = np.frombuffer(ids, "<u4").tolist()
        assert "".join([*(machine.feed(seq[i : i + 3]) for i in range(0, len(seq), 3)), machine.finish()]) == tok.decode(seq, skip_special_tokens=False)


def test_tokens_leave_early_and_right():
    mine, _ = bpe_stream.made(WORD)
    rng = random.Random(5)
    assert 0 < mine.lookahead < 5000
    for letters in ("ab", "eationrs", "abcdefghijklmnopqrstuvwxyz"):
        word = "".join(rng.choice(letters) for _ in range(3 * mine.lookahead + 1500))
        taken = 0

        def feed():
            nonlocal taken
            for c in word:
                taken += 1
                yield c

        out, early = [], None
        for t in mine.stream(feed()):
            early = early or taken
            out.append(t)
        whole = mine.merge([*word[:-1], word[-1] + mine.suffix])
        assert out == whole and early <= mine.lookahead + 257


def test_byte_machine_holds_unfinished_characters():
    tok, machine = Tokenizer.from_file(BYTE), bpe_stream.TextMachine(BYTE)
    ids = tok.encode("naïve 漢字 😀!", add_special_tokens=False).ids
    parts = [machine.feed([i]) for i in ids] + [machine.finish()]
    assert "".join(parts) == tok.decode(ids) and "�" not in "".join(parts)


def test_simple8b_round_trips():
    rng = np.random.default_rng(1)
    for n in (0, 1, 59, 60, 61, simple8b.RUN, simple8b.RUN + 1, 20000):
        for top in (1, 2, 300, 50257, 1 << 40, (1 << 64) - 1):
            ids = rng.integers(0, top, n, dtype=np.uint64, endpoint=True) >> rng.integers(0, 64, n, dtype=np.uint64)
            words, offsets = simple8b.encode(ids)
            assert (simple8b.decode(words, offsets, n) == ids).all()
            if n > simple8b.RUN and top < 1 << 59:  # a run decodes alone
                assert (simple8b.decode(words[offsets[1] :], offsets[1:] - offsets[1], n - simple8b.RUN) == ids[simple8b.RUN :]).all()
    assert len(simple8b.encode(np.zeros(600, np.uint64))[0]) == 10


def test_token_files(spark, tmp_path):
    data = [*rows(), (None, "null id", "en", "h", 1, "", "")]
    path = str(tmp_path / "tokens")
    simple8b.write_token_files(spark.createDataFrame(data, SCHEMA), path, BYTE)
    got = simple8b.read_token_files(spark, path, with_ids=True).collect()
    tok = Tokenizer.from_file(BYTE)
    at, want = 0, []
    for d, t, *_ in sorted(data, key=lambda r: (-1 if r[0] is None else r[0])):
        ids = raw(tok, t or "") + b"\0\0\0\0"
        want.append((-1 if d is None else d, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    empty = str(tmp_path / "none")
    simple8b.write_token_files(spark.createDataFrame([], SCHEMA), empty, BYTE)
    assert simple8b.read_token_files(spark, empty).count() == 0


def test_nnls_and_patterns():
    rng = np.random.default_rng(2)
    assert (packing.patterns(16, 3).sum(axis=1) == 16).all() and len({tuple(r) for r in packing.patterns(16, 3).tolist()}) == len(packing.patterns(16, 3)) == 30
    a = rng.random((12, 40))
    x = packing.nnls(a, a @ np.maximum(rng.normal(size=40), 0))
    assert (x >= 0).all() and np.abs(a @ x - a @ np.maximum(x, 0)).max() < 1e-9
    b = rng.random(12)
    x = packing.nnls(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-6 and np.abs(gradient[x > 0]).max() < 1e-6


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_whole_and_tight(seed):
    rng = np.random.default_rng(seed)
    lens = np.minimum(2048, np.ceil(rng.lognormal(6.2, 1.1, 20000))).astype(int)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lens, return_counts=True)), strict=True))
    groups = packing.plan(histogram, 2048)
    back: dict[int, int] = {}
    for ls, c in groups:
        assert c > 0 and sum(ls) <= 2048
        for n in ls:
            back[n] = back.get(n, 0) + c
    assert back == histogram
    assert sum(c for _, c in groups) <= 1.01 * lens.sum() / 2048 + 2


def best_fit_decreasing(lens: list[int], size: int) -> int:
    """Sequences of the plain greedy packing, a document at a time."""
    rooms, n = [0] * (size + 1), 0
    for x in sorted(lens, reverse=True):
        r = next((r for r in range(x, size + 1) if rooms[r]), None)
        if r is None:
            r, n = size, n + 1
        else:
            rooms[r] -= 1
        rooms[r - x] += 1
    return n


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_as_tight_as_greedy(seed):
    rng = np.random.default_rng(100 + seed)
    lens = np.minimum(2048, np.ceil(rng.lognormal(5.5 + 0.4 * seed, 1, 3000))).astype(int) if seed < 3 else rng.integers(300, 1200, 3000)
    kinds, counts = np.unique(lens, return_counts=True)
    used = sum(c for _, c in packing.plan(dict(zip(kinds.tolist(), counts.tolist(), strict=True)), 2048))
    assert used <= 1.002 * best_fit_decreasing(lens.tolist(), 2048) + 1
    many = sum(c for _, c in packing.plan(dict(zip(kinds.tolist(), (300 * counts).tolist(), strict=True)), 2048))
    assert many <= 300 * (used + 1)
    if seed < 2:  # enough small documents to fill every sequence
        assert many <= 1.001 * 300 * lens.sum() / 2048 + 1


def test_pack(spark):
    data = [*rows(), (None, "null id", "en", "h", 1, "", "")]
    got = packing.pack(spark.createDataFrame(data, SCHEMA), WORD).collect()
    tok = Tokenizer.from_file(WORD)
    want = []
    for d, t, *_ in data:
        ids = raw(tok, t or "") + b"\0\0\0\0"
        for k, at in enumerate(range(0, len(ids) // 4, 2048)):
            part = ids[4 * at : 4 * (at + 2048)]
            want.append((-1 if d is None else d, k, at, len(part) // 4, zlib.crc32(part)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(sequences) <= sum(r.length for r in got) / 2048 + 2
    assert packing.pack(spark.createDataFrame([], SCHEMA), WORD).count() == 0
