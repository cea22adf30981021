"""GIF media columns: images written with LZW code streams, and a reader for frames of any GIF.

The reader decodes the code streams, applies global and local palettes, interlacing, transparency and the disposal of
earlier frames, and gives each frame's composed canvas with its time. Tables hold the media as a binary column, the
timed frames as rows or as colour histograms for each document.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: A stored frame: 24 x 24 samples, shown for 0.1 s.
SIDE, FRAME, DELAY_CS = 24, 576, 10
#: The stored palette: three bits of red, three of green, two of blue; all colours differ, so samples can be read back.
PALETTE = np.array([[(i >> 5) * 255 // 7, ((i >> 2) & 7) * 255 // 7, (i & 3) * 85] for i in range(256)], np.uint8)
#: Codes of a full table; bytes of the tables in which frames are coded side by side; codes and frames that are read at once.
FULL, TABLES, CODES, SIDE_BY_SIDE = 4096, 32 << 20, 2048, 2048


def widths(low: int) -> np.ndarray:
    """Bits of each code after a clear code; a full table stays at 12 bits."""
    return np.minimum(12, np.floor(np.log2((1 << low) + 1 + np.arange(FULL))).astype(np.int64) + 1)


WIDTHS = {low: widths(low) for low in range(2, 9)}
PLACES = {low: np.concatenate([[0], np.cumsum(w)]) for low, w in WIDTHS.items()}


def place(low: int, k: np.ndarray) -> np.ndarray:
    """The bits before the k-th code after a clear code."""
    return PLACES[low][np.minimum(k, FULL)] + 12 * np.maximum(k - FULL, 0)


def lzw_codes(samples: bytes, low: int) -> list[int]:
    """The codes of samples, with clear codes at the start and when the table is full, and the end code."""
    clear = 1 << low
    out, table, free = [clear], {}, clear + 2
    if not samples:
        return [clear, clear + 1]
    prefix, get, put = samples[0], table.get, out.append
    for c in samples[1:]:
        key = prefix << 8 | c
        code = get(key)
        if code is None:
            put(prefix)
            if free < FULL - 1:
                table[key] = free
                free += 1
            else:
                put(clear)
                table, free = {}, clear + 2
                get = table.get
            prefix = c
        else:
            prefix = code
    out += [prefix, clear + 1]
    return out


def lzw_encode(samples: bytes, low: int = 8) -> bytes:
    """The code stream of samples of any number."""
    codes, clear = np.array(lzw_codes(samples, low), np.int64), 1 << low
    # a code's place after the last clear code gives its width; a clear code has the width of what it ends
    cuts = np.flatnonzero(codes == clear)
    since = np.arange(len(codes)) - cuts[np.searchsorted(cuts, np.arange(len(codes)), side="left") - 1] - 1
    since[0] = 0
    bits = WIDTHS[low][since]
    each = (codes[:, None] >> np.arange(12)).astype(np.uint8) & 1
    return np.packbits(each[np.arange(12) < bits[:, None]], bitorder="little").tobytes()


def lzw_encode_frames(samples: np.ndarray) -> list[bytes]:
    """The code streams of frames (a row each, too short to fill a table), which are coded side by side, sample by sample.

    Each frame has a table of its nodes by its distinct samples. Frames with like numbers of distinct samples go
    together, as many as their tables fit into ``TABLES`` bytes.
    """
    n, size = samples.shape
    there = np.zeros((n, 256), bool)
    there[np.arange(n)[:, None], samples] = True
    distinct = there.sum(axis=1)
    local = np.take_along_axis(there.cumsum(axis=1) - 1, samples.astype(np.int64), axis=1)
    out: list[bytes] = [b""] * n
    order, lo = np.argsort(distinct, kind="stable"), 0
    while lo < n:
        # the last frame of a group has the most distinct samples
        most = lambda hi: (hi - lo) * (int(distinct[order[hi - 1]]) + size) * int(distinct[order[hi - 1]]) * 2
        hi = min(n, lo + SIDE_BY_SIDE)
        while hi > lo + 1 and most(hi) > TABLES:
            hi = lo + max(1, (hi - lo) * 3 // 4)
        rows = order[lo:hi]
        for k, code in zip(rows.tolist(), _coded(samples[rows], local[rows], int(distinct[rows[-1]])), strict=True):
            out[k] = code
        lo = hi
    return out


def _coded(samples: np.ndarray, local: np.ndarray, d: int) -> list[bytes]:
    """Code streams of frames whose samples are numbered from 0 to below d; a node is a sample or d + an entry's number."""
    n, size = samples.shape
    table = np.zeros(n * (d + size) * d, np.uint16)
    char = np.ascontiguousarray(local.T)
    base = char + np.arange(n) * ((d + size) * d)
    nodes, ends = np.empty((size, n), np.int64), np.ones((size, n), bool)
    node, free = char[0], np.full(n, d, np.int64)
    for i in range(1, size):
        at = base[i] + node * d
        found = table[at]
        new = found == 0
        nodes[i - 1], ends[i - 1] = node, new
        table[at[new]] = free[new]
        free += new
        node = np.where(new, char[i], found)
    nodes[size - 1] = node
    sample_of = np.zeros((n, d), np.int64)
    np.put_along_axis(sample_of, local, samples.astype(np.int64), axis=1)
    codes = np.where(nodes.T < d, np.take_along_axis(sample_of, np.minimum(nodes.T, d - 1), axis=1), nodes.T - d + 258)
    # a clear code, the codes and the end code in rows; where each code lies is the same in all rows
    each = ends.T.sum(axis=1)
    rows = np.zeros((n, int(each.max()) + 2), np.uint16)
    rows[:, 0] = 256
    of, at = np.nonzero(ends.T)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    rows[of, nth + 1] = codes[of, at]
    rows[np.arange(n), each + 1] = 257
    bits = np.concatenate([[9], WIDTHS[8][: rows.shape[1] - 1]])
    column = np.repeat(np.arange(len(bits)), bits)
    shift = (np.arange(len(column)) - np.repeat(np.cumsum(bits) - bits, bits)).astype(np.uint16)
    raw = np.packbits(((rows[:, column] >> shift) & 1).astype(np.uint8), axis=1, bitorder="little")
    length = (np.cumsum(bits)[each + 1] + 7) >> 3
    return [r[:k].tobytes() for r, k in zip(raw, length.tolist(), strict=True)]


def _tokens(streams: list[bytes], low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes of streams without clear and end codes: stream, token before which the table was last cleared, and code.

    All streams are read together, up to ``CODES`` codes of each in a round; a table that stays full is read on.
    """
    clear, n = 1 << low, len(streams)
    size = np.array([len(s) for s in streams], np.int64)
    start = np.cumsum(size + 4) - size - 4
    raw = np.frombuffer(b"\0\0\0\0".join([*streams, b""]), np.uint8)
    at, total, k, cleared = np.zeros(n, np.int64), 8 * size, np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.flatnonzero(total > low)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def read(of: np.ndarray, bit: np.ndarray, k: np.ndarray) -> np.ndarray:
        byte = start[of] + (bit >> 3)
        three = raw[byte].astype(np.int64) | raw[byte + 1].astype(np.int64) << 8 | raw[byte + 2].astype(np.int64) << 16
        return three >> (bit & 7) & ((1 << WIDTHS[low][np.minimum(k, FULL - 1)]) - 1)

    while len(live):
        left = live[k[live] == 0]
        while len(left):  # clear codes where none is needed
            left = left[at[left] + low < total[left]]
            left = left[read(left, at[left], k[left]) == clear]
            at[left] += low + 1
        room = np.minimum((total - at)[live] // (low + 1), CODES)
        of = np.repeat(live, room)
        kth = np.arange(len(of)) - np.repeat(np.cumsum(room) - room, room)
        bit = at[of] + place(low, k[of] + kth) - place(low, k[of])
        fits = bit + WIDTHS[low][np.minimum(k[of] + kth, FULL - 1)] <= total[of]
        of, kth, bit = of[fits], kth[fits], bit[fits]
        code = read(of, bit, k[of] + kth)
        mark = (code == clear) | (code == clear + 1)
        # what follows a stream's first mark is read anew, or is of no use
        begin = np.searchsorted(of, live)
        count = np.bincount(of, minlength=n)[live]
        first = np.full(n, len(of), np.int64)
        np.minimum.at(first, of[mark], np.flatnonzero(mark))
        got = np.minimum(first[live] - begin, count)
        use = np.arange(len(of)) < np.repeat(begin + got, count)
        parts.append((of[use], cleared[of[use]], code[use]))
        ended, was = got < count, k[live]
        at[live] += place(low, was + got) - place(low, was)
        k[live] += got
        marked = live[ended]
        kind = code[first[marked]]
        at[marked] += WIDTHS[low][np.minimum(k[marked], FULL - 1)]
        k[marked] = 0
        cleared[marked] += 1
        go = count > 0
        go[np.flatnonzero(ended)[kind != clear]] = False
        live = live[go]
        live = live[at[live] + low < total[live]]
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    of, since, code = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(of, kind="stable")
    of, since, code = of[order], since[order], code[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (since[1:] != since[:-1])
    return of, np.maximum.accumulate(np.where(new, np.arange(len(of)), 0)), code


def lzw_decode_streams(streams: list[bytes], low: int) -> tuple[np.ndarray, np.ndarray]:
    """The samples of all streams, one after another, and how many each has.

    An entry is what an earlier token stood for and one sample more, and stands in the output at that token's place. So
    lengths come from following tokens to plain samples, and so do the samples themselves; both in doubled steps.
    """
    of, head, code = _tokens(streams, low)
    n, clear = len(of), 1 << low
    entry = code - clear - 2
    plain = code < clear
    if (~plain & ((entry < 0) | (entry >= np.arange(n) - head))).any():
        raise ValueError("a code ahead of its table")
    source = np.where(plain, np.arange(n), head + entry)
    length, to = 1 + (~plain).astype(np.int64), source.copy()
    rest = np.flatnonzero(~plain)
    while len(rest):  # length - 1 is the number of steps up to ``to``
        rest = rest[to[to[rest]] != to[rest]]
        add, nxt = length[to[rest]] - 1, to[to[rest]]
        length[rest] += add
        to[rest] = nxt
    begin = np.cumsum(length) - length
    total = int(length.sum())
    token = np.repeat(np.arange(n), length)
    where = np.arange(total) - begin[token] + begin[source[token]]
    rest = np.flatnonzero(where != np.arange(total))
    while len(rest):
        nxt = where[where[rest]]
        rest, nxt = rest[nxt != where[rest]], nxt[nxt != where[rest]]
        where[rest] = nxt
    samples = np.zeros(total, np.uint8)
    samples[begin[plain]] = code[plain]
    return samples[where], np.bincount(of, weights=length, minlength=len(streams)).astype(np.int64)


def lzw_decode(data: bytes, low: int, most: int) -> bytes:
    """Up to ``most`` samples of one code stream."""
    return lzw_decode_streams([data], low)[0][:most].tobytes()


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


@dataclass
class Frame:
    """What a GIF says of one frame; ``stream`` is its code stream."""

    left: int
    top: int
    width: int
    height: int
    interlaced: bool
    palette: np.ndarray | None
    low: int
    stream: bytes
    disposal: int
    delay: int
    clearness: int | None


def parsed(data: bytes) -> tuple[int, int, list[Frame]]:
    """Width, height and frames of a GIF."""
    if data[:3] != b"GIF":
        raise ValueError("not a GIF")
    wide, high, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at, shared, found = 13, None, []
    if flags & 128:
        n = 2 << (flags & 7)
        shared = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
    disposal, delay, clearness = 0, 0, None
    while at < len(data):
        kind = data[at]
        if kind == 0x3B:
            break
        if kind == 0x21:
            body, nxt = _blocks(data, at + 2)
            if data[at + 1] == 0xF9:
                disposal, delay = body[0] >> 2 & 7, body[1] | body[2] << 8
                clearness = body[3] if body[0] & 1 else None
            at = nxt
            continue
        if kind != 0x2C:
            raise ValueError("an unknown block")
        left, top, w, h, flags = struct.unpack_from("<HHHHB", data, at + 1)
        at, palette = at + 10, shared
        if flags & 128:
            n = 2 << (flags & 7)
            palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
            at += 3 * n
        low = data[at]
        stream, at = _blocks(data, at + 1)
        found.append(Frame(left, top, w, h, bool(flags & 64), palette, low, stream, disposal, delay, clearness))
        disposal, delay, clearness = 0, 0, None
    return wide, high, found


def samples_of(found: list[Frame]) -> list[np.ndarray]:
    """The samples of frames, in rows from top to bottom; code streams of equal sample width are read together."""
    out: list[np.ndarray] = [np.zeros(0, np.uint8)] * len(found)
    for low in {f.low for f in found}:
        of = [i for i, f in enumerate(found) if f.low == low]
        flat, sizes = lzw_decode_streams([found[i].stream for i in of], low)
        ends = np.cumsum(sizes)
        for i, lo, hi in zip(of, (ends - sizes).tolist(), ends.tolist(), strict=True):
            f = found[i]
            area = f.width * f.height
            part = flat[lo : min(hi, lo + area)]
            part = (part if len(part) == area else np.concatenate([part, np.zeros(area - len(part), np.uint8)])).reshape(f.height, f.width)
            if f.interlaced:
                part = part[np.argsort([*range(0, f.height, 8), *range(4, f.height, 8), *range(2, f.height, 4), *range(1, f.height, 2)])]
            out[i] = part
    return out


class Screen:
    """A canvas on which the frames of a GIF are shown one after another."""

    def __init__(self, wide: int, high: int):
        self.size, self.canvas = (high, wide), np.zeros((high, wide, 4), np.uint8)

    def show(self, found: list[Frame], samples: list[np.ndarray]) -> np.ndarray:
        """The composed canvases (frame x height x width x RGBA) of the next frames."""
        if not found:
            return np.zeros((0, *self.size, 4), np.uint8)
        if all(f.palette is found[0].palette and f.clearness is None and f.disposal < 2 and (f.left, f.top, f.height, f.width) == (0, 0, *self.size) for f in found):
            # each covers all that was there before
            colours = np.concatenate([found[0].palette, np.full((len(found[0].palette), 1), 255, np.uint8)], axis=1)
            out = colours[np.stack(samples)]
            self.canvas = out[-1].copy()
            return out
        return np.stack([self._one(f, x) for f, x in zip(found, samples, strict=True)])

    def _one(self, f: Frame, samples: np.ndarray) -> np.ndarray:
        before = self.canvas.copy() if f.disposal == 3 else None
        area = self.canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        samples = samples[: area.shape[0], : area.shape[1]]
        seen = np.ones(samples.shape, bool) if f.clearness is None else samples != f.clearness
        area[seen, :3], area[seen, 3] = f.palette[samples[seen]], 255
        shown = self.canvas.copy()
        if f.disposal == 2:
            area[:] = 0
        elif f.disposal == 3:
            self.canvas = before
        return shown


def shown(media: list[bytes]) -> Iterator[tuple[int, list[Frame], np.ndarray]]:
    """Frames of media in order, with the medium's place in the list: some frames of one medium and their canvases at a
    time. Code streams are read together across media, up to ``SIDE_BY_SIDE`` of them."""
    held: list[tuple[int, Screen, list[Frame]]] = []
    count = 0

    def flush() -> Iterator[tuple[int, list[Frame], np.ndarray]]:
        every, at = samples_of([f for _, _, fs in held for f in fs]), 0
        for i, screen, fs in held:
            yield i, fs, screen.show(fs, every[at : at + len(fs)])
            at += len(fs)

    for i, data in enumerate(media):
        wide, high, found = parsed(data)
        screen = Screen(wide, high)
        for lo in range(0, len(found), SIDE_BY_SIDE):
            part = found[lo : lo + SIDE_BY_SIDE]
            if held and count + len(part) > SIDE_BY_SIDE:
                yield from flush()
                held, count = [], 0
            held.append((i, screen, part))
            count += len(part)
    yield from flush()


def frames(data: bytes) -> Iterator[tuple[np.ndarray, int]]:
    """Each frame's composed canvas (height x width x RGBA) and delay in hundredths of a second."""
    for _, found, canvases in shown([data]):
        yield from zip(canvases, (f.delay for f in found), strict=True)


HEAD = b"GIF89a" + struct.pack("<HHBBB", SIDE, SIDE, 0xF7, 0, 0) + PALETTE.tobytes()
START = b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, DELAY_CS, 0) + b"\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, SIDE, SIDE, 0) + b"\x08"


def stored_all(payloads: list[bytes]) -> list[bytes]:
    """For each payload a GIF with a frame for each 576 bytes of it; frames are coded together across payloads."""
    codes: list[bytes] = []
    every = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, FRAME)
    for lo in range(0, len(every), 2 * SIDE_BY_SIDE):
        codes += lzw_encode_frames(every[lo : lo + 2 * SIDE_BY_SIDE])
    out, at = [], 0
    for p in payloads:
        parts = [HEAD]
        for code in codes[at : at + len(p) // FRAME]:
            parts.append(START)
            for k in range(0, len(code), 255):
                part = code[k : k + 255]
                parts += [bytes((len(part),)), part]
            parts.append(b"\0")
        at += len(p) // FRAME
        out.append(b"".join([*parts, b"\x3b"]))
    return out


def stored(payload: bytes) -> bytes:
    return stored_all([payload])[0]


def samples(canvas: np.ndarray) -> bytes:
    """The stored samples of one or more canvases, from their colours."""
    return ((canvas[..., 0] & 0xE0) | (canvas[..., 1] >> 5) << 2 | canvas[..., 2] >> 6).tobytes()


def histograms(canvases: np.ndarray) -> np.ndarray:
    """For each canvas how many of its points have each of 64 colours (two bits each of red, green and blue)."""
    top = canvases[..., :3] >> 6
    bins = (top[..., 0] << 4 | top[..., 1] << 2 | top[..., 2]).reshape(len(canvases), -1)
    return np.bincount((bins + (np.arange(len(canvases)) * 64)[:, None]).ravel(), minlength=64 * len(canvases)).reshape(-1, 64)


def padded(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (-len(raw) % FRAME if raw else FRAME)


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the media column. Null or empty text: one frame of 255s. Repeated rows: a row each. Other
    columns, whatever their names, are ignored; an empty table gives none. A task holds one batch's texts and media."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in common.by_bytes([t or "" for t in texts]):
                raws = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts[lo:hi]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(raws, pa.int64()), pa.array(stored_all([padded(t) for t in texts[lo:hi]]), pa.binary())], ["doc_id", "n_bytes", "media"])

    return common.id_text(docs).mapInArrow(common.tidy(run), "doc_id long, n_bytes long, media binary")


TIMED = "frames array<struct<start_cs: long, delay_cs: int, colours: array<int>>>"
FEATURES = f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames long, duration_cs long, histogram array<long>, {TIMED}"
_TIMED = pa.list_(pa.struct([("start_cs", pa.int64()), ("delay_cs", pa.int32()), ("colours", pa.list_(pa.int32()))]))


def _timed(delays: list[np.ndarray], colours: list[np.ndarray]) -> pa.Array:
    """The timed frames of some media, a list each, with each frame's colour histogram."""
    each = np.array([len(d) for d in delays], np.int64)
    delay = np.concatenate(delays) if delays else np.zeros(0, np.int64)
    ends = np.cumsum(delay)
    first = np.cumsum(each) - each
    start = ends - delay - np.repeat(np.concatenate([[0], ends])[first], each)
    flat = np.concatenate(colours).astype(np.int32) if colours else np.zeros((0, 64), np.int32)
    bars = pa.ListArray.from_arrays(pa.array(np.arange(len(delay) + 1) * 64, pa.int32()), pa.array(flat.ravel()))
    rows = pa.StructArray.from_arrays([pa.array(start), pa.array(delay.astype(np.int32)), bars], fields=list(_TIMED.value_type))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()), rows, type=_TIMED)


#: What reading a file that isn't whole can raise.
BROKEN = (ValueError, IndexError, KeyError, TypeError, struct.error)
_FEATURE_NAMES = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "n_frames", "duration_cs", "histogram", "frames"]
_FEATURE_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), _TIMED]


def _features(gifs: list[bytes]) -> list[pa.Array]:
    """The columns of some media that are read side by side."""
    n = len(gifs)
    digests, tails = [hashlib.sha256() for _ in range(n)], [b""] * n
    delays: list[list[int]] = [[] for _ in range(n)]
    bars: list[list[np.ndarray]] = [[] for _ in range(n)]
    for i, found, canvases in shown(gifs):
        part = samples(canvases)
        digests[i].update(part)
        tails[i] = part[-32:]
        delays[i] += [f.delay for f in found]
        bars[i].append(histograms(canvases))
    colours = [np.concatenate(b) if b else np.zeros((0, 64), np.int64) for b in bars]
    return [
        pa.array([FRAME * len(d) for d in delays], pa.int64()), pa.array([d.hexdigest() for d in digests]), pa.array(list(map(zlib.crc32, tails)), pa.int64()), pa.array(list(map(len, gifs)), pa.int64()),
        pa.array([hashlib.sha256(g).hexdigest() for g in gifs]), pa.array(list(map(len, delays)), pa.int64()), pa.array(list(map(sum, delays)), pa.int64()),
        pa.array([c.sum(axis=0) for c in colours], pa.list_(pa.int64())), _timed([np.array(d, np.int64) for d in delays], colours),
    ]


def _apart(gifs: list[bytes | None], lo: int, hi: int) -> Iterator[tuple[int, int, list[pa.Array]]]:
    """Ranges of media with their columns. If one of a range is null or can't be read, the range is halved; alone, it has
    nulls, but for its size and digest if it is there."""
    cols = None
    if None not in gifs[lo:hi]:
        try:
            cols = _features(gifs[lo:hi])
        except BROKEN:
            pass
    if cols is not None:
        yield lo, hi, cols
    elif hi - lo > 1:
        mid = (lo + hi) // 2
        yield from _apart(gifs, lo, mid)
        yield from _apart(gifs, mid, hi)
    else:
        known = {} if gifs[lo] is None else {"media_bytes": len(gifs[lo]), "media_sha256": hashlib.sha256(gifs[lo]).hexdigest()}
        yield lo, hi, [pa.array([known.get(name)], kind) for name, kind in zip(_FEATURE_NAMES, _FEATURE_TYPES, strict=True)]


def media_features(media: DataFrame) -> DataFrame:
    """Reads the media back: digests of the payload, the number and time of frames, a histogram of 64 colours over all
    frames, and the timed frames with a histogram each. Equal media, equal values; repeated rows: a row each; a null
    medium: nulls; one that can't be read: its size and digest, else nulls; an empty table gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gifs = batch.column(2).to_pylist()
            for first, last in common.by_bytes([g or b"" for g in gifs]):
                for lo, hi, cols in _apart(gifs, first, last):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *cols], ["doc_id", "n_bytes", *_FEATURE_NAMES])

    return media.mapInArrow(common.tidy(run), FEATURES)


def timed_frames(media: DataFrame) -> DataFrame:
    """A row for each frame of each medium: doc_id, frame, start_cs, delay_cs, width, height and the RGBA canvas.
    Repeated rows: their frames each; a null medium: none; one that can't be read to its end: those before; an empty table
    gives none."""

    def readable(gif: bytes | None) -> Iterator[tuple[np.ndarray, int]]:
        try:
            yield from frames(gif) if gif is not None else ()
        except BROKEN:
            return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, gif in zip(batch.column(0), batch.column(2), strict=True):
                start = 0
                for k, (canvas, delay) in enumerate(readable(gif.as_py())):
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((doc.as_py(), pa.int64()), (k, pa.int32()), (start, pa.int64()), (delay, pa.int32()), (canvas.shape[1], pa.int32()), (canvas.shape[0], pa.int32()), (canvas.tobytes(), pa.binary()))], ["doc_id", "frame", "start_cs", "delay_cs", "width", "height", "rgba"])
                    start += delay

    return media.mapInArrow(common.tidy(run), "doc_id long, frame int, start_cs long, delay_cs int, width int, height int, rgba binary")
