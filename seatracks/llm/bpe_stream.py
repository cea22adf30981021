"""BPE as a streaming transducer with bounded lookahead, and incremental decoding.

Merges are applied by rank. What is still to come can change a token only through a chain of merges of rising rank that
ends at the edge of what has been read; the longest such chain that the merge list allows gives the lookahead. Tokens
that end further from the edge than that are stable and leave at once, so memory is constant however long a piece of
text without a break is. Texts are cut into words first, by the tokenizer's own rules, and a bounded memo holds words.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .common import SYMBOLS


def lookahead(merges: list[tuple[str, str]], suffix: str) -> int:
    """How many symbols past a token's end suffice to settle it.

    A merge (u, v) of rank r is open while it is open whether v goes elsewhere; then u is open for merges of higher rank,
    alone or as uv. So the open zone grows by u, and again by what a later merge puts before u or uv. The longest growth,
    from the last merge back, plus the longest token (which may reach over the edge) is enough.
    """
    size = lambda t: len(t.removesuffix(suffix)) if suffix else len(t)
    reach: dict[str, int] = {}
    most = longest = 0
    for u, v in reversed(merges):
        grown = size(u) + max(reach.get(u, 0), reach.get(u + v, 0))
        reach[v] = max(reach.get(v, 0), grown)
        most, longest = max(most, grown), max(longest, size(u) + size(v))
    return most + longest


class Transducer:
    """Encodes texts for a tokenizer file whose model is BPE over byte symbols with an end-of-word suffix."""

    def __init__(self, path: str, memo: int = 400_000):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.lookahead = lookahead(merges, self.suffix)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split).findall
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.chunk = re.compile(f"[^{common.SPACE}]+").findall
        self.most, self.seen, self.once, self.word_seen = memo, {}, {}, {}

    def merge(self, sym: list[str]) -> list[str]:
        """All merges of a list of symbols, always the lowest rank, leftmost first."""
        rank = self.rank
        if len(sym) <= 24:
            while len(sym) > 1:
                best, at = None, -1
                for i, pair in enumerate(zip(sym, sym[1:], strict=False)):
                    r = rank.get(pair)
                    if r is not None and (best is None or r < best):
                        best, at = r, i
                if best is None:
                    break
                sym = [*sym[:at], sym[at] + sym[at + 1], *sym[at + 2 :]]
            return sym
        n = len(sym)
        sym, after, before = list(sym), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := rank.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, u, v = heapq.heappop(heap)
            j = after[i]
            if j >= n or sym[i] != u or sym[j] != v:
                continue
            sym[i], sym[j], after[i] = u + v, "", after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank.get((sym[i], sym[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i, sym[i], sym[after[i]]))
            if (k := before[i]) >= 0 and (r := rank.get((sym[k], sym[i]))) is not None:
                heapq.heappush(heap, (r, k, sym[k], sym[i]))
        return [s for s in sym if s]

    def stream(self, symbols: Iterable[str], window: int = 0) -> Iterator[str]:
        """The tokens of one word from its symbols one by one; holds ``window`` symbols at most."""
        window = max(window, self.lookahead + 256)
        held: list[str] = []
        for s in symbols:
            held.append(s)
            if len(held) > window:  # the last symbol may yet be the word's end, so it counts as unread
                end, stable = 0, len(held) - 1 - self.lookahead
                for t in self.merge(held[:-1]):
                    if end + len(t) > stable:
                        break
                    yield t
                    end += len(t)
                held = held[end:]
        if held:
            held[-1] += self.suffix
            yield from self.merge(held)

    def word(self, w: str) -> bytes:
        ids = self.word_seen.get(w)
        if ids is None:
            ids = np.array([self.vocab[t] for t in self.stream(SYMBOLS[b] for b in w.encode("utf-8", "surrogatepass"))], "<u4").tobytes()
            if len(w) <= 64:
                self.word_seen[w] = ids
        return ids

    def part(self, chunk: str) -> bytes:
        """The ids of text without white space: composed, lower-cased letter by letter, and cut into words."""
        return b"".join(map(self.word, self.words(common.composed(chunk))))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if "<" in text and self.cut.search(text):
            out, at = [], 0
            for m in self.cut.finditer(text):
                out += [self.plain(text[at : m.start()]), np.array([self.added[m[0]]], "<u4").tobytes()]
                at = m.end()
            return b"".join([*out, self.plain(text[at:])])
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        found, seen = self.chunk(text), self.seen
        try:
            return b"".join(map(seen.__getitem__, found))
        except KeyError:
            pass
        # a chunk enters the lasting memo when it is met again, so that rare ones don't push out frequent ones
        once, here = self.once, {}
        if len(seen) > self.most:
            seen.clear()
        if len(once) > self.most:
            once.clear()
        if len(self.word_seen) > self.most:
            self.word_seen.clear()
        for w in set(found).difference(seen):
            ids = once.pop(w, None)
            if ids is None:
                here[w] = ids = self.part(w)
                if len(w) <= 64:
                    once[w] = ids
            else:
                seen[w] = ids
        return b"".join([seen[w] if w in seen else here[w] for w in found])


class TextMachine:
    """Ids to text, piece by piece: state is whether a token came before, or an unfinished character's bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytewise = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.token = [""] * (max(names.values()) + 1)
        for t, i in names.items():
            self.token[i] = t
        if self.bytewise:
            value = {c: b for b, c in enumerate(SYMBOLS)}
            self.raw = [bytes(value[c] for c in t) if all(c in value for c in t) else t.encode() for t in self.token]
        self.reset()

    def reset(self) -> None:
        self.begun, self.rest = False, codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: list[int]) -> str:
        """What is certain after these ids. A tokenizer without a decoder has its tokens joined by one space."""
        if self.bytewise:
            return self.rest.decode(b"".join(map(self.raw.__getitem__, ids)))
        if not ids:
            return ""
        lead, self.begun = " " if self.begun else "", True
        return lead + " ".join(map(self.token.__getitem__, ids))

    def finish(self) -> str:
        out = self.rest.decode(b"", final=True) if self.bytewise else ""
        self.reset()
        return out


_MADE: dict[str, tuple[Transducer, TextMachine]] = {}


def made(path: str) -> tuple[Transducer, TextMachine]:
    if path not in _MADE:
        _MADE[path] = Transducer(path), TextMachine(path)
    return _MADE[path]


def encode_and_decode(docs: DataFrame, tokenizer: str, step: int = 1 << 16) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded text of each document.

    Null or empty text: no ids, empty text. Repeated rows: a row each. Other columns are ignored. Ids are decoded from
    their stored form, ``step`` at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, machine = made(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in common.by_bytes([t or "" for t in texts], 1 << 22):
                raws, backs = [], []
                for t in texts[lo:hi]:
                    raws.append(coder.encode(t or ""))
                    ids = np.frombuffer(raws[-1], "<u4")
                    backs.append("".join([*(machine.feed(ids[i : i + step].tolist()) for i in range(0, len(ids), step)), machine.finish()]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([len(r) // 4 for r in raws], pa.int64()), pa.array(raws, pa.binary()), pa.array(backs, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return common.id_text(docs).mapInArrow(common.tidy(run), "doc_id long, n_tokens long, ids binary, decoded string")
