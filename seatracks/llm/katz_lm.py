"""A language model of word pairs (order 2) or triples (order 3) with Katz backoff.

Counts are discounted by Good-Turing; a context's left-over mass goes to the words not seen after it, in proportion to
their own (again discounted) unigram probabilities, with a weight that makes the sum over all words and one unknown word
exactly 1. A token is evaluated recursively: its triple if seen, else the context's weight times its
probability by the pair, which is the pair's if seen, else that context's weight times its unigram. A document begins
after ends.

All of it is counted over whole tables. A task turns its documents into chunks of local word numbers once; what a chunk
needs from the model it asks from partitioned tables in compact sorted slices, and gets back in the same order: first
word counts (by ranges of hashes), then pair counts with the contexts' sums (by context; a frequent context is spread
over buckets by the second word, and its sums are added up), then triples, by contexts of two words, in the same way.
The answer for a pair says whether other chunks have it too. If none has, the chunk holds all triples that begin with
it and counts them itself.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .substring_dedup import _edges

#: Counts up to so many are discounted.
GT = 5
#: Tokens of a chunk, about.
CHUNK = 1 << 20
#: The base model adds this to each count.
ADD = 0.1
#: A bucket gets about as many tokens as so many chunks have.
EACH = 4
#: A context is spread over buckets if it has more than this share of a bucket's mean load.
SPREAD = 8
#: Triples are dealt out in so many turns, one after another, as they take the most room on their way.
TURNS = 4

#: Parts of a chunk: its documents, and its words, which only their count needs.
DOCS, VOCABULARY = range(2)
CHUNKS = "part int, chunk long, docs binary, null_docs binary, held binary, lengths binary, tokens binary, place binary, words binary, train binary"
_CHUNKS = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), *[(x.split()[0], pa.binary()) for x in CHUNKS.split(", ")[2:]]])
ROW = "kind int, chunk long, bucket int, a binary, b binary, c binary, d binary, e binary"
_ROW = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int32()), *[(x, pa.binary()) for x in "abcde"]])
#: Kinds of rows: a slice of words or pairs that is asked for, its answer, sums for the driver, sums of spread contexts.
ASK, WORDS, PAIRS, SUMS, SPREADS, TRIPLES = range(6)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def held_out(doc: int | None) -> bool:
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0


def chunk_table(docs: DataFrame) -> DataFrame:
    """Documents as numbers of words in a list of their own for each chunk; number 0 is the end. Words stand by hash,
    with their counts in training; ``place`` has where each number's word stands. A chunk has two rows, by ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = count(TaskContext.get().partitionId() << 32)

        def fresh() -> tuple[defaultdict, list, list]:
            names: defaultdict = defaultdict(count(1).__next__)
            return names, [], []

        names, docs_, parts = fresh()
        tokens = 0

        def flush() -> pa.Table:
            lengths = np.array(list(map(len, parts)), "<u4")
            flat = np.concatenate(parts)
            held = np.array(list(map(held_out, docs_)), np.uint8)
            train = np.bincount(flat[np.repeat(held == 0, lengths)], minlength=len(names) + 1).astype("<u4")
            words = common.word_hashes([b"", *names])
            order = np.argsort(words, kind="stable")
            place = np.empty(len(order), "<u4")
            place[order] = np.arange(len(order))
            docs = np.array([d or 0 for d in docs_], "<i8")
            null = np.array([d is None for d in docs_], np.uint8)
            chunk = next(number)
            of_docs, of_words = (docs, null, held, lengths, flat, place), (words[order], train[order])
            return _rows([(DOCS, chunk, *map(common.packed, of_docs), None, None), (VOCABULARY, chunk, *[None] * len(of_docs), *map(common.packed, of_words))], _CHUNKS)

        for batch in batches:
            for doc, text in zip(*batch.columns, strict=True):
                found = common.words_of(text.as_py(), lower=True)
                docs_.append(doc.as_py())
                part = np.zeros(len(found) + 1, "<u4")
                part[:-1] = np.fromiter(map(names.__getitem__, found), "<u4", len(found))
                parts.append(part)
                tokens += len(part)
                if tokens >= CHUNK:
                    yield from flush().to_batches()
                    names, docs_, parts = fresh()
                    tokens = 0
        if docs_:
            yield from flush().to_batches()

    return common.id_text(docs).mapInArrow(common.tidy(run), CHUNKS)


def _tally(n: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, ... GT + 1."""
    return np.bincount(np.minimum(n, GT + 2), minlength=GT + 3)[1 : GT + 2]


def _word_slices(buckets: int):
    edges = _edges(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, train in zip(*(batch.column(k).to_pylist() for k in ("chunk", "words", "train")), strict=True):
                h, n = common.unpacked(words, "<u8"), common.unpacked(train, "<u4")
                cut = [0, *np.searchsorted(h, edges).tolist(), len(h)]
                yield from _rows([(ASK, chunk, b, common.packed(h[i:j]), common.packed(n[i:j]), None, None, None) for b, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if j > i], _ROW).to_batches()

    return run


def _count_words(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """One bucket of words: their counts and numbers (by falling count), for each chunk that asked; and the sums."""
        chunks, bucket = table.column("chunk").to_pylist(), table.column("bucket")[0].as_py()
        hs = [common.unpacked(x, "<u8") for x in table.column("a").to_pylist()]
        ns = [common.unpacked(x, "<u4") for x in table.column("b").to_pylist()]
        words, at = np.unique(np.concatenate(hs), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(ns), minlength=len(words)).astype(np.int64)
        number = np.empty(len(words), np.int64)
        number[np.argsort(-total, kind="stable")] = np.arange(len(words)) * buckets + bucket
        out, lo = [], 0
        for chunk, h in zip(chunks, hs, strict=True):
            mine = at[lo : lo + len(h)]
            lo += len(h)
            out.append((WORDS, chunk, bucket, common.packed(number[mine]), common.packed(total[mine]), None, None, None))
        sums = np.concatenate([[total.sum(), (total > 0).sum()], _tally(total)]).astype("<i8")
        return _rows([*out, (SUMS, None, bucket, sums.tobytes(), None, None, None, None)], _ROW)

    return run


def discounts(tally: np.ndarray) -> np.ndarray:
    """Katz's Good-Turing discounts of counts 0 to GT (entry 0 unused), from how many counts are 1, 2, ... GT + 1.

    Where the tally gives none that lie between 0 and 1 (small corpora), each count loses n1 / (n1 + 2 n2) instead.
    """
    n = tally.astype(float)
    r = np.arange(1, GT + 1)
    out = np.ones(GT + 1)
    if (n > 0).all():
        common_part = (GT + 1) * n[GT] / n[0]
        d = ((r + 1) * n[1:] / (r * n[:-1]) - common_part) / (1 - common_part) if common_part != 1 else np.zeros(GT)
        if (d > 0).all() and (d < 1).all():
            out[1:] = d
            return out
    lost = min(0.9, max(0.1, n[0] / (n[0] + 2 * n[1]))) if n[0] else 0.5
    out[1:] = (r - lost) / r
    return out


@dataclass
class Unigrams:
    """N, V and the discounted probabilities of known words and of the one unknown word."""

    n: int
    v: int
    d: np.ndarray = field(repr=False)
    unknown: float = 1.0
    scale: float = 1.0

    @classmethod
    def of(cls, sums: np.ndarray) -> Unigrams:
        n, v, tally = int(sums[0]), int(sums[1]), sums[2:]
        d = discounts(tally)
        if not n:
            return cls(n, v, d)
        r = np.arange(1, GT + 1)
        left = float(((1 - d[1:]) * r * tally[:GT]).sum()) / n
        unknown = max(left, 1 / (n + 1))
        return cls(n, v, d, unknown, (1 - unknown) / (1 - left))

    def p(self, c: np.ndarray) -> np.ndarray:
        seen = np.where(c > GT, 1.0, self.d[np.minimum(c, GT)]) * c * (self.scale / max(self.n, 1))
        return np.where(c > 0, seen, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return (c + ADD) / (self.n + ADD * (self.v + 1))


@dataclass
class Asked:
    """A chunk's distinct pairs with known contexts, sorted as they are asked for, and where its tokens find them."""

    pair_of_token: np.ndarray  # of each token its pair, in order of ``v`` and ``w``
    v: np.ndarray  # local numbers of each distinct pair
    w: np.ndarray
    sent: np.ndarray  # places of pairs in the order they are sent
    edges: np.ndarray  # of the buckets in ``sent``
    n: np.ndarray  # training count of each sent pair in this chunk


def _dealt(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by bucket (as before within each), and where each bucket begins."""
    small = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    return np.argsort(small, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(small, minlength=buckets))])


def _by_two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order by a, then b; numbers below 2^32 make one key."""
    if not len(a) or max(int(a.max()), int(b.max())) < 1 << 32:
        return np.argsort((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64))
    return np.lexsort((b, a))


def _ask(tokens: np.ndarray, lengths: np.ndarray, held: np.ndarray, number: np.ndarray, c: np.ndarray, end: int, buckets: int, n_train: int) -> Asked:
    """Tokens are places of their words by number, so pairs come sorted by both words' numbers."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(lengths) - lengths] = end  # a document begins after an end
    keys, at = np.unique((before.astype(np.uint64) << np.uint64(32)) | tokens.astype(np.uint64), return_inverse=True)
    v, w = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n = np.bincount(at, weights=np.repeat(held == 0, lengths), minlength=len(keys)).astype(np.int64)
    load = _load(n_train, buckets)
    ways = -(-c[v] // load)
    bucket = (number[v] + np.where(ways > 1, (common.mix(number[w].view(np.uint64)) % np.maximum(ways, 1).astype(np.uint64)).astype(np.int64), 0)) % buckets
    known = np.flatnonzero(c[v] > 0)  # a pair with an unknown word still needs its context's sums
    order, edges = _dealt(bucket[known], buckets)
    sent = known[order]
    return Asked(at, v, w, sent, edges, n[sent])


def _heads(v: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where a new context begins among sent pairs; each bucket begins one."""
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    new[edges[edges < len(v)]] = True
    return np.flatnonzero(new)


def _of_chunk(row: dict, answers: dict) -> tuple:
    """A chunk's arrays with its words by their numbers in the model: tokens (places among them), lengths, held, the
    words' numbers and counts, and the end's place."""
    place, tokens, lengths, held = (common.unpacked(row[k], t) for k, t in (("place", "<u4"), ("tokens", "<u4"), ("lengths", "<u4"), ("held", "u1")))
    mine = sorted((b, x, y) for k, b, x, y in zip(answers["kind"], answers["bucket"], answers["a"], answers["b"], strict=True) if k == WORDS)
    number, c = (np.concatenate([common.unpacked(x, "<i8") for x in part]) for part in ([x for _, x, _ in mine], [y for _, _, y in mine]))
    order = np.argsort(number)
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order))
    rank = rank[place]
    return rank[tokens], lengths.astype(np.int64), held, number[order], c[order], int(rank[0])


def _pair_slices(buckets: int, n_train: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """A chunk's pairs for each bucket: contexts with lengths of their runs, second words, their counts, and pairs' counts."""
        out = []
        answers = right.to_pydict()
        for row in left.to_pylist():
            tokens, lengths, held, number, c, end = _of_chunk(row, answers)
            asked = _ask(tokens, lengths, held, number, c, end, buckets, n_train)
            v, w = asked.v[asked.sent], asked.w[asked.sent]
            for b, (i, j) in enumerate(zip(asked.edges[:-1].tolist(), asked.edges[1:].tolist(), strict=True)):
                if j > i:
                    head = _heads(v[i:j], np.zeros(0, np.int64))
                    runs = np.diff(head, append=j - i).astype("<u4")
                    out.append((ASK, row["chunk"], b, common.packed(number[v[i:j][head]]), common.packed(runs), common.packed(number[w[i:j]]), common.packed(c[w[i:j]]), common.packed(asked.n[i:j].astype("<u4"))))
        return _rows(out, _ROW)

    return run


def _count_pairs(unigrams: Unigrams, buckets: int, spread: set[int]):
    def run(table: pa.Table) -> pa.Table:
        """One bucket of pairs: their counts, and for each context how many of its pairs have each small count and the
        unigram mass of its pairs, for each chunk that asked."""
        get = table.to_pydict()
        bucket = get["bucket"][0]
        heads = [common.unpacked(x, "<i8") for x in get["a"]]
        runs = [common.unpacked(x, "<u4") for x in get["b"]]
        gv = np.concatenate([np.repeat(x, y) for x, y in zip(heads, runs, strict=True)])
        gw, cw = (np.concatenate([common.unpacked(x, "<i8") for x in get[k]]) for k in "cd")
        ns = [common.unpacked(x, "<u4") for x in get["e"]]
        n = np.concatenate(ns).astype(np.int64)
        order = _by_two(gv, gw)
        sv, sw = gv[order], gw[order]
        new = np.ones(len(order), bool)
        new[1:] = (sv[1:] != sv[:-1]) | (sw[1:] != sw[:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order], first)
        pair_of = np.empty(len(order), np.int64)
        pair_of[order] = np.cumsum(new) - 1
        alone = (np.diff(first, append=len(order)) == 1).astype(np.uint8)  # each chunk sends a pair once
        pv, mass = sv[first], np.where(total > 0, unigrams.p(cw[order][first]), 0.0)
        context = _heads(pv, np.zeros(0, np.int64))
        small = np.stack([np.add.reduceat((total == r).astype(np.int64), context) for r in range(1, GT + 1)], axis=1).astype("<u4")
        sums, names = np.add.reduceat(mass, context), pv[context]
        out, lo = [], 0
        for chunk, head, k in zip(get["chunk"], heads, ns, strict=True):
            at = np.searchsorted(names, head)
            mine = pair_of[lo : lo + len(k)]
            out.append((PAIRS, chunk, bucket, common.packed(total[mine].astype("<u4")), common.packed(small[at].reshape(-1)), common.packed(sums[at].astype("<f8")), common.packed(alone[mine]), None))
            lo += len(k)
        out.append((SUMS, None, bucket, _tally(total).astype("<i8").tobytes(), None, None, None, None))
        many = np.flatnonzero(np.isin(names, np.fromiter(spread, np.int64, len(spread))))
        if len(many):
            out.append((SPREADS, None, bucket, names[many].astype("<i8").tobytes(), small[many].astype("<i8").tobytes(), sums[many].astype("<f8").tobytes(), None, None))
        return _rows(out, _ROW)

    return run


def pair_probabilities(n: np.ndarray, cv: np.ndarray, p1: np.ndarray, small: np.ndarray, mass: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Probabilities of pairs with counts n, of contexts with counts cv > 0, second words with unigram probability p1,
    and for each pair's context its numbers of small counts and the unigram mass of its seen pairs."""
    r = np.arange(1, GT + 1)
    kept = (cv - (small * r * (1 - d[1:])).sum(axis=1)) / cv  # mass of the discounted pairs
    left = np.maximum(1 - kept, 0.5 / cv)
    seen = np.where(n > GT, 1.0, d[np.minimum(n, GT)]) * n / cv * ((1 - left) / np.maximum(kept, 1e-300))
    return np.where(n > 0, seen, left / np.maximum(1 - mass, 1e-300) * p1)


@dataclass
class Pairs:
    """A chunk's arrays, its pairs, their counts and probabilities, and whether no other chunk has them."""

    tokens: np.ndarray
    lengths: np.ndarray
    held: np.ndarray
    number: np.ndarray
    c: np.ndarray
    end: int
    asked: Asked
    counts: np.ndarray
    p: np.ndarray
    alone: np.ndarray


def _pairs_of(row: dict, answers: dict, unigrams: Unigrams, d: np.ndarray, buckets: int, sums: dict[int, tuple[np.ndarray, float]]) -> Pairs:
    tokens, lengths, held, number, c, end = _of_chunk(row, answers)
    asked = _ask(tokens, lengths, held, number, c, end, buckets, unigrams.n)
    p = unigrams.p(c[asked.w])
    counts, alone = np.zeros(len(asked.v), np.int64), np.zeros(len(asked.v), bool)
    mine = sorted(x[1:] for x in zip(*(answers[k] for k in ("kind", "bucket", "a", "b", "c", "d")), strict=True) if x[0] == PAIRS)
    seen_before = np.flatnonzero(c[asked.v] > 0)
    if mine:
        n = np.concatenate([common.unpacked(x[1], "<u4") for x in mine]).astype(np.int64)
        small = np.concatenate([common.unpacked(x[2], "<u4") for x in mine]).reshape(-1, GT).astype(np.int64)
        mass = np.concatenate([common.unpacked(x[3], "<f8") for x in mine])
        alone[asked.sent] = np.concatenate([common.unpacked(x[4], "u1") for x in mine]) > 0
        # each context's sums, once, with the spread ones in full
        head = _heads(asked.v[asked.sent], asked.edges)
        local = asked.v[asked.sent[head]]
        of_small, of_mass = np.zeros((len(c), GT), np.int64), np.zeros(len(c))
        of_small[local], of_mass[local] = small, mass
        for i in np.unique(local[np.isin(number[local], np.fromiter(sums, np.int64, len(sums)))]).tolist():
            of_small[i], of_mass[i] = sums[int(number[i])]
        counts[asked.sent] = n
        v = asked.v[seen_before]
        p[seen_before] = pair_probabilities(counts[seen_before], c[v], p[seen_before], of_small[v], of_mass[v], d)
    return Pairs(tokens, lengths, held, number, c, end, asked, counts, p, alone)


@dataclass
class AskedTriples:
    """A chunk's distinct triples, sorted by context, where its tokens find them, and those with a known context: the
    ones counted here and the others as they are asked for."""

    triple_of_token: np.ndarray
    x: np.ndarray  # of each triple its context, a pair of the chunk or (the last) a document's beginning
    n: np.ndarray  # its training count in this chunk
    w: np.ndarray  # number of its third word
    low: np.ndarray  # its third word's probability by the pair
    u: np.ndarray  # numbers of each context's words, and its training count
    v: np.ndarray
    cc: np.ndarray
    here: np.ndarray
    sent: np.ndarray
    edges: np.ndarray


def _load(n_train: int, buckets: int) -> int:
    return max(1, n_train // (SPREAD * buckets))


def _ask_triples(m: Pairs, buckets: int, n_train: int) -> AskedTriples:
    starts = np.cumsum(m.lengths) - m.lengths
    context = np.empty(len(m.tokens), np.int64)
    context[1:] = m.asked.pair_of_token[:-1]
    context[starts] = len(m.asked.v)
    keys, at = np.unique((context.astype(np.uint64) << np.uint64(32)) | m.tokens.astype(np.uint64), return_inverse=True)
    x, w = (keys >> np.uint64(32)).astype(np.int64), m.number[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    n = np.bincount(at, weights=np.repeat(m.held == 0, m.lengths), minlength=len(keys)).astype(np.int64)
    low = np.empty(len(keys))
    low[at] = m.p[m.asked.pair_of_token]
    # no pair that ends a document is a context, so two ends stand for a beginning
    u, v, cc = np.append(m.number[m.asked.v], m.number[m.end]), np.append(m.number[m.asked.w], m.number[m.end]), np.append(m.counts, m.c[m.end])
    ways = np.maximum(-(-cc[x] // _load(n_train, buckets)), 1)
    mixed = common.mix(common.mix(u.view(np.uint64)) ^ v.view(np.uint64))
    bucket = ((mixed[x] % np.uint64(buckets)).astype(np.int64) + (common.mix(w.view(np.uint64)) % ways.astype(np.uint64)).astype(np.int64)) % buckets
    alone = np.append(m.alone, False)[x]
    known = np.flatnonzero((cc[x] > 0) & ~alone)
    order, edges = _dealt(bucket[known], buckets)
    return AskedTriples(at, x, n, w, low, u, v, cc, np.flatnonzero((cc[x] > 0) & alone), known[order], edges)


def _triple_slices(unigrams: Unigrams, d: np.ndarray, buckets: int, sums: dict[int, tuple[np.ndarray, float]], turn: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """A chunk's triples for each bucket: contexts (both words and count) with lengths of their runs, third words,
        their probabilities by the pair where they are in training here, and triples' counts. Every ``TURNS``-th bucket
        has its turn. With the first turn go the tallies of the triples that the chunk counts itself."""
        out, answers = [], right.to_pydict()
        for row in left.to_pylist():
            t = _ask_triples(_pairs_of(row, answers, unigrams, d, buckets, sums), buckets, unigrams.n)
            if not turn:
                out.append((SUMS, row["chunk"], row["chunk"] % buckets, _tally(t.n[t.here]).astype("<i8").tobytes(), None, None, None, None))
            for b, (i, j) in enumerate(zip(t.edges[:-1].tolist(), t.edges[1:].tolist(), strict=True)):
                if j > i and b % TURNS == turn:
                    part = t.sent[i:j]
                    head = _heads(t.x[part], np.zeros(0, np.int64))
                    x = t.x[part[head]]
                    low = np.where(t.n[part] > 0, t.low[part], 0.0)
                    out.append((ASK, row["chunk"], b, common.packed(np.concatenate([t.u[x], t.v[x], t.cc[x]])), common.packed(np.diff(head, append=j - i).astype("<u4")), common.packed(t.w[part]), common.packed(low.astype("<f8")), common.packed(t.n[part].astype("<u4"))))
        return _rows(out, _ROW)

    return run


def _count_triples(load: int):
    def run(table: pa.Table) -> pa.Table:
        """One bucket of triples, as ``_count_pairs``. Only where a chunk has an unseen triple does it get the mass."""
        asks = table.filter(pc.equal(table.column("kind"), ASK))
        told = [(SUMS, None, r["bucket"], r["a"], None, None, None, None) for r in table.filter(pc.equal(table.column("kind"), SUMS)).to_pylist()]
        if not asks.num_rows:
            return _rows(told, _ROW)
        get = asks.to_pydict()
        bucket = get["bucket"][0]
        heads = [common.unpacked(a, "<i8").reshape(3, -1) for a in get["a"]]
        runs = [common.unpacked(r, "<u4") for r in get["b"]]
        of_head = np.concatenate(heads, axis=1)
        # contexts of this bucket, numbered in the order of their words
        order = _by_two(of_head[0], of_head[1])
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(of_head[:2, order]) != 0).any(axis=0)
        context_of = np.empty(len(order), np.int64)
        context_of[order] = np.cumsum(new) - 1
        names = of_head[:, order[new]]
        x = np.repeat(context_of, np.concatenate(runs))
        w = np.concatenate([common.unpacked(c, "<i8") for c in get["c"]])
        low = np.concatenate([common.unpacked(p, "<f8") for p in get["d"]])
        ns = [common.unpacked(k, "<u4") for k in get["e"]]
        n = np.concatenate(ns).astype(np.int64)
        order = _by_two(x, w)
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(x[order]) != 0) | (np.diff(w[order]) != 0)
        first = np.flatnonzero(new)
        total, best = np.add.reduceat(n[order], first), np.maximum.reduceat(low[order], first)
        triple_of = np.empty(len(order), np.int64)
        triple_of[order] = np.cumsum(new) - 1
        begin = np.searchsorted(x[order][first], np.arange(names.shape[1]))
        small = np.stack([np.add.reduceat((total == r).astype(np.int64), begin) for r in range(1, GT + 1)], axis=1).astype("<u4")
        mass = np.add.reduceat(np.where(total > 0, best, 0.0), begin)
        out, lo, at = told, 0, 0
        for chunk, run_, k in zip(get["chunk"], runs, ns, strict=True):
            mine, of = total[triple_of[lo : lo + len(k)]], context_of[at : at + len(run_)]
            unseen = np.logical_or.reduceat(mine == 0, np.cumsum(run_.astype(np.int64)) - run_)
            out.append((TRIPLES, chunk, bucket, common.packed(mine.astype("<u4")), common.packed(small[of].reshape(-1)), common.packed(np.where(unseen, mass[of], 0.0).astype("<f8")), None, None))
            lo, at = lo + len(k), at + len(run_)
        out.append((SUMS, None, bucket, _tally(total).astype("<i8").tobytes(), None, None, None, None))
        spread = np.flatnonzero(names[2] > load)
        if len(spread):
            out.append((SPREADS, None, bucket, names[:2, spread].astype("<i8").tobytes(), small[spread].astype("<i8").tobytes(), mass[spread].astype("<f8").tobytes(), None, None))
        return _rows(out, _ROW)

    return run


def _triple_log(m: Pairs, answers: dict, d: np.ndarray, buckets: int, n_train: int, sums: dict[tuple[int, int], tuple[np.ndarray, float]]) -> np.ndarray:
    """Each token's probability by its triple, as a decimal logarithm."""
    t = _ask_triples(m, buckets, n_train)
    p = t.low
    if len(t.here):
        x, n = t.x[t.here], t.n[t.here]
        head = _heads(x, np.zeros(0, np.int64))
        of = np.repeat(np.arange(len(head)), np.diff(head, append=len(x)))
        small = np.stack([np.add.reduceat((n == r).astype(np.int64), head) for r in range(1, GT + 1)], axis=1)
        mass = np.add.reduceat(np.where(n > 0, p[t.here], 0.0), head)
        p[t.here] = pair_probabilities(n, t.cc[x], p[t.here], small[of], mass[of], d)
    mine = sorted((b, x, y, z) for k, b, x, y, z in zip(answers["kind"], answers["bucket"], answers["a"], answers["b"], answers["c"], strict=True) if k == TRIPLES)
    if mine:
        n = np.concatenate([common.unpacked(x, "<u4") for _, x, _, _ in mine]).astype(np.int64)
        small = np.concatenate([common.unpacked(y, "<u4") for _, _, y, _ in mine]).reshape(-1, GT).astype(np.int64)
        mass = np.concatenate([common.unpacked(z, "<f8") for _, _, _, z in mine])
        x = t.x[t.sent]
        head = _heads(x, t.edges)
        of = np.cumsum(np.bincount(head, minlength=len(x))) - 1
        for i in np.flatnonzero(t.cc[x[head]] > _load(n_train, buckets)).tolist():
            k = x[head[i]]
            small[i], mass[i] = sums[int(t.u[k]), int(t.v[k])]
        p[t.sent] = pair_probabilities(n, t.cc[x], p[t.sent], small[of], mass[of], d)
    return np.log10(p)[t.triple_of_token]


def _whole(rows: list, width: int) -> dict:
    """Sums of spread contexts, of all buckets together, by their names (one word's number, or two words')."""
    whole: dict = {}
    for r in rows:
        names = np.frombuffer(r["a"], "<i8").reshape(width, -1).T.tolist()
        for name, small, mass in zip(names, np.frombuffer(r["b"], "<i8").reshape(-1, GT), np.frombuffer(r["c"], "<f8").tolist(), strict=True):
            key = name[0] if width == 1 else tuple(name)
            s, m = whole.get(key, (np.zeros(GT, np.int64), 0.0))
            whole[key] = (s + small, m + mass)
    return whole


def _told(counted: DataFrame, width: int) -> tuple[np.ndarray, dict]:
    """Discounts and sums of spread contexts: a few numbers for each bucket, and at most 2 * SPREAD contexts a bucket."""
    tally = [np.frombuffer(r["a"], "<i8") for r in counted.where(F.col("kind") == SUMS).select("a").collect()]
    return discounts(np.sum(tally, axis=0) if tally else np.zeros(GT + 1, np.int64)), _whole(counted.where(F.col("kind") == SPREADS).select("a", "b", "c").collect(), width)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(unigrams: Unigrams, buckets: int, pairs: tuple[np.ndarray, dict], triples: tuple[np.ndarray, dict] | None):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, cols = right.to_pydict(), [[] for _ in range(7)]
        for row in left.to_pylist():
            m = _pairs_of(row, answers, unigrams, pairs[0], buckets, pairs[1])
            log = _triple_log(m, answers, triples[0], buckets, unigrams.n, triples[1]) if triples else np.log10(m.p)[m.asked.pair_of_token]
            starts = np.cumsum(m.lengths) - m.lengths
            of_doc = lambda x: np.add.reduceat(x, starts)
            docs, null, known = common.unpacked(row["docs"], "<i8"), common.unpacked(row["null_docs"], "u1"), m.c[m.tokens]
            values = (pa.array(docs, mask=null.astype(bool)), m.held.astype(bool), m.lengths, of_doc((known > 0).astype(np.int64)), np.full(len(docs), unigrams.n, np.int64), of_doc(np.log10(unigrams.base(known))), of_doc(log))
            for col, x in zip(cols, values, strict=True):
                col.append(x if isinstance(x, pa.Array) else pa.array(x))
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.Table.from_arrays([pa.chunked_array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in SCORES.split(", ")])

    return run


def katz_scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document, by a model of ``order`` 2 or 3.

    Null or empty text: the end alone. A null doc_id counts as an empty id, which is held out. Repeated rows count as
    often as they occur. Without training documents every token is unknown. An empty table gives an empty result.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark = docs.sparkSession
    home = common.shared_dir(spark)
    both = common.written(chunk_table(docs), f"{home}/chunks", by="part")
    chunks = both.where(F.col("part") == DOCS)
    buckets = common.buckets(spark, chunks.count(), EACH)
    slices = both.where(F.col("part") == VOCABULARY).select("chunk", "words", "train").mapInArrow(_word_slices(buckets), ROW)
    words = common.written(slices.groupBy("bucket").applyInArrow(_count_words(buckets), ROW), f"{home}/words")
    common.removed(spark, f"{home}/chunks/part={VOCABULARY}")
    sums = [np.frombuffer(r["a"], "<i8") for r in words.where(F.col("kind") == SUMS).select("a").collect()]  # a few numbers for each bucket
    unigrams = Unigrams.of(np.sum(sums, axis=0) if sums else np.zeros(GT + 3, np.int64))
    # contexts that are spread: at most SPREAD * buckets, as their counts add up to N
    load = _load(unigrams.n, buckets)
    spread = set(_spread(words, load))
    asking = chunks.select("chunk", "lengths", "held", "tokens", "place")
    answers = words.where(F.col("kind") == WORDS)
    pairs = asking.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_pair_slices(buckets, unigrams.n), ROW)
    counted = common.written(pairs.groupBy("bucket").applyInArrow(_count_pairs(unigrams, buckets, spread), ROW), f"{home}/pairs")
    of_pairs, of_triples = _told(counted, 1), None
    told = answers.union(counted.where(F.col("kind") == PAIRS))
    if order == 3:
        for turn in range(TURNS):
            triples = asking.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_triple_slices(unigrams, of_pairs[0], buckets, of_pairs[1], turn), ROW)
            counted = common.written(triples.groupBy("bucket").applyInArrow(_count_triples(load), ROW), f"{home}/triples", mode="append")
        of_triples = _told(counted, 2)
        told = told.union(counted.where(F.col("kind") == TRIPLES))
    return chunks.select("chunk", "docs", "null_docs", "held", "lengths", "tokens", "place").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_score(unigrams, buckets, of_pairs, of_triples), SCORES)


def _spread(words: DataFrame, load: int) -> list[int]:
    """Numbers of the words that occur more than ``load`` times in training; there are at most N / load of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(common.unpacked(number, "<i8")[common.unpacked(c, "<i8") > load])], ["number"])

    return [r["number"] for r in words.where(F.col("kind") == WORDS).select("a", "b").mapInArrow(common.tidy(run), "number long").distinct().collect()]
