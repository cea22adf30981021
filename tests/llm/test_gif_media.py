import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from seatracks.llm import gif_media as G

from .corpus import SCHEMA, rows


def brute_lzw(data, low, most):
    """Bit by bit, from the format's rules."""
    clear, at, out, table, width, last = 1 << low, 0, [], {}, low + 1, None
    bits = "".join(f"{b:08b}"[::-1] for b in data)
    while True:
        code = int(bits[at : at + width][::-1], 2)
        at += width
        if code == clear:
            table, width, last = {i: [i] for i in range(clear)} | {clear: [], clear + 1: []}, low + 1, None
            continue
        if code == clear + 1:
            return bytes(out)[:most]
        now = table[code] if code in table else last + last[:1]
        out += now
        if last is not None and len(table) < 4096:
            table[len(table)] = last + now[:1]
            if len(table) == 1 << width and width < 12:
                width += 1
        last = now


@pytest.mark.parametrize("low", [2, 4, 8])
def test_lzw(low):
    rng = random.Random(low)
    for n in (1, 2, 255, 576, 5000, 60000):
        for top in (1, 1 << low):
            data = bytes(rng.randrange(top) for _ in range(n))
            code = G.lzw_encode(data, low)
            assert brute_lzw(code, low, n) == data == G.lzw_decode(code, low, n)


def gif(w, h, palette, parts):
    out = b"GIF89a" + struct.pack("<HHBBB", w, h, 0x80 | 1, 0, 0) + bytes(palette)
    for left, top, fw, fh, disposal, clear, delay, pix, flags, local in parts:
        out += b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (clear is not None), delay, clear or 0) + b"\0"
        out += b"\x2c" + struct.pack("<HHHHB", left, top, fw, fh, flags | (0x81 if local else 0)) + bytes(local or b"") + b"\x02"
        code = G.lzw_encode(bytes(pix), 2)
        out += bytes([len(code)]) + code + b"\0"
    return out + b"\x3b"


P = [0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255]


def test_disposal_transparency_and_palettes():
    data = gif(2, 2, P, [(0, 0, 2, 2, 1, None, 5, [1, 1, 1, 1], 0, None), (0, 0, 2, 1, 3, 0, 7, [0, 2], 0, None), (1, 0, 1, 2, 2, None, 9, [3, 3], 0, None), (0, 1, 1, 1, 1, None, 1, [0], 0, [9, 9, 9] * 4)])
    got = list(G.frames(data))
    R, GR, B, N, L = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (0, 0, 0, 0), (9, 9, 9, 255)
    want = [[R, R, R, R], [R, GR, R, R], [R, B, R, B], [R, N, L, N]]
    assert [[tuple(int(v) for v in p) for p in c.reshape(-1, 4)] for c, _ in got] == want
    assert [d for _, d in got] == [5, 7, 9, 1]


def test_interlace():
    h = 11
    order = [*range(0, h, 8), *range(4, h, 8), *range(2, h, 4), *range(1, h, 2)]
    value = [y % 4 for y in range(h)]
    ((canvas, _),) = G.frames(gif(1, h, P, [(0, 0, 1, h, 0, None, 0, [value[y] for y in order], 64, None)]))
    assert [tuple(map(int, c[:3])) for c in canvas[:, 0]] == [tuple(P[3 * v : 3 * v + 3]) for v in value]


def test_samples_come_back():
    payload = bytes(range(256)) * 9
    assert b"".join(G.samples(c) for c, _ in G.frames(G.stored(payload))) == payload


def test_media_column(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    media = G.store_media(docs)
    by_text = {}
    for r, (d, t, *_) in zip(sorted(G.media_features(media).collect(), key=lambda r: r.doc_id), sorted(data, key=lambda x: x[0]), strict=True):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (r.doc_id, r.n_bytes, r.payload_bytes) == (d, len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
        bins = np.bincount([(p[0] >> 6) << 4 | (p[1] >> 6) << 2 | p[2] >> 6 for p in G.PALETTE[list(payload)].tolist()], minlength=64)
        assert r.histogram == bins.tolist() and r.duration_cs == 10 * r.n_frames == 10 * len(payload) // 576
        assert by_text.setdefault(t or "", r.media_sha256) == r.media_sha256
    assert G.timed_frames(media.where("doc_id = 3")).count() >= 1
    assert G.media_features(G.store_media(spark.createDataFrame([], SCHEMA))).count() == 0
