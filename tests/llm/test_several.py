"""Many texts encoded at once, against the tokenizers library; each distinct word asked for once."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from seatracks.llm import common, packing, simple8b

from .test_tokens import BYTE, WORD, raw, texts

#: Numbers that are no digits, separators that are no white space, unassigned characters, marks, specials in other letters.
STRANGE = ["x² ½a Ⅷb ٣c 一二", "a\x1cb \x1dc d\x1e", "a͸b \U000323b0x", "é ́a ño", "<|ENDOFTEXT|> <|startoftext|>", "it''s _a_b __ 'S'T", " 　 ", "\x0b\x0c\r", "a　b\xa0c\x85d e"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_several_equal_the_library(path):
    tok, mine = Tokenizer.from_file(path), common.Chunks(path, most=50)
    every = [None, *texts(), None, *STRANGE]
    plain = [t for t in texts() if not any(0x1C <= ord(c) < 0x20 for c in t)]
    for some in (every, plain, [None], [], STRANGE[:1], STRANGE[4:5], *([t] for t in STRANGE)):
        flat, counts = mine.several(pa.array(some, pa.string()))
        assert len(counts) == len(some) and flat.tobytes() == b"".join(raw(tok, t or "") for t in some)
        assert counts.tolist() == [len(raw(tok, t or "")) // 4 for t in some]


def test_each_distinct_word_is_asked_for_once():
    """With a memo too small for anything, as with many more words than it holds."""
    mine, asked = common.Chunks(WORD, most=50), []
    model = mine.words.make
    mine.words.make = lambda w: asked.append(w) or model(w)
    mine.several(pa.array([f"Alpha beta, w{i % 7} (gamma)." for i in range(300)]))
    assert len(asked) == len(set(asked)) <= 20


def test_kept_texts_ask_for_each_distinct_word_once():
    mine, asked = common.Chunks(BYTE, most=50), []
    model = mine.words.make
    mine.words.make = lambda w: asked.extend(filter(None, [w])) or model(w)
    mine.several(pa.array([f"Alpha beta, w{i % 7} (gamma).\nDelta" for i in range(300)]))
    assert len(asked) == len(set(asked)) <= 24


def test_kept_texts_in_odd_white_space():
    """Runs of white space of either kind, zeros, specials, and letters that only one of the patterns takes."""
    tok, mine, rng = Tokenizer.from_file(BYTE), common.Chunks(BYTE, most=1 << 20), random.Random(11)
    spaces = [" ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\x1c", "\u200b"]
    others = ["a", "word", "Don't", "'s", "'S", "12", ".", "_", "...", "é", "漢字", "😀", "x1y", "'re", "ſ", "٣"]
    for more in ([], ["½", "²", "Ⅷ"], ["\0", "<|endoftext|>", "\u0378"]):
        some = ["".join(rng.choice(rng.choice([spaces, others + more])) for _ in range(rng.randrange(20))) for _ in range(3000)]
        flat, counts = mine.several(pa.array(["before", *some, "after"])[1:-1])
        want = [raw(tok, t) for t in some]
        assert flat.tobytes() == b"".join(want) and counts.tolist() == [len(x) // 4 for x in want]


def test_runs_are_whole():
    some = pa.array(["a", "", " b c", "d", " ", "e\u3000 f\xa0\n g\n\n h", ""])
    runs, before = common.spaced_runs(some)
    assert runs.to_pylist() == ["a", " b", " c", "d", " ", "e\u3000 f\xa0\n g", "\n\n h"] and before.tolist() == [0, 1, 1, 3, 4, 5, 7, 7]
    runs, before = common.spaced_runs(some[2:4])
    assert runs.to_pylist() == [" b", " c", "d"] and before.tolist() == [0, 2, 3]
    assert common.spaced_runs(some[:0])[1].tolist() == [0]


def test_blocks_of_token_files(spark, tmp_path):
    """Blocks end with the document that fills them, also where a slice of texts ends before."""
    data = [(i, None if i == 7 else f"w{i} x, " * (3 * simple8b.BLOCK // 4 if i == 11 else 9000) * (i != 5)) for i in range(45)]
    path, tok = str(tmp_path / "tokens"), Tokenizer.from_file(BYTE)
    simple8b.write_token_files(spark.createDataFrame(data, "doc_id long, text string"), path, BYTE)
    want, at = [], 0
    for d, t in data:
        ids = raw(tok, t or "") + b"\0\0\0\0"
        want.append((d, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = simple8b.read_token_files(spark, path).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
    blocks = spark.read.parquet(path).select("part", "block", "n_ids", "lengths").collect()
    ends = {(r.part, r.block): r.n_ids - int(np.frombuffer(r.lengths, "<u4")[-1]) for r in blocks}
    assert sum(r.n_ids for r in blocks) == at and all(x < simple8b.BLOCK for x in ends.values())
    assert all(r.n_ids >= simple8b.BLOCK or (r.part, r.block + 1) not in ends for r in blocks) and len(blocks) > 4


def test_slices_are_whole():
    some = pa.array(["a" * 5, None, "é" * 3, "", "b" * 30, "c", None])
    assert list(common.text_slices(some, 11)) == [(0, 4), (4, 5), (5, 7)]
    assert list(common.text_slices(some[1:4], 1)) == [(0, 1), (1, 2), (2, 3)]
    assert list(common.text_slices(some[:0])) == []


def test_pieces_of_long_and_empty_texts(spark):
    data = [(i, t) for i, t in enumerate([None, "", "a b " * 3000, "x", "y " * 2047, "z " * 2048, "q"])]
    got = packing.pieces(spark.createDataFrame(data, "doc_id long, text string").coalesce(1), WORD).collect()
    tok, want = Tokenizer.from_file(WORD), []
    for d, t in data:
        n = len(raw(tok, t or "")) // 4 + 1
        want += [(d, k, at, min(2048, n - at)) for k, at in enumerate(range(0, n, 2048))]
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in got) == want
