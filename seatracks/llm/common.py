"""What the operators share: the shared folder, word splitting, chunk encoders and packed arrays."""

from __future__ import annotations

import os
import re
import tempfile
import unicodedata
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pyarrow as pa

#: Characters with Unicode's White_Space property, as a character class body.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared folder; a temporary one only on one machine that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/seatracks-{uuid.uuid4().hex}"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """While a table is written, the shuffles behind it go as soon as it is there: they are of no further use."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "true")
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def written(df: DataFrame, path: str, by: str | None = None, mode: str = "error") -> DataFrame:
    """Writes a table and rereads it: cuts the lineage, so a lost executor costs no recomputation."""
    with cleaned(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder of the library's own, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release() -> None:
    """Gives memory that is free, but still held by the allocators, back to the machine."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """A task's function of batches, after which its Python worker, which waits for the next task, holds no free memory."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def buckets(spark: SparkSession, size: int | None = None, each: int = 1) -> int:
    """The session's shuffle partitions, or more if ``size`` bytes would give a bucket more than ``each``."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // each))


def id_text(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone (null text stays null), whatever else the table has."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def free(df: DataFrame, *names: str) -> list[str]:
    """The given names, or longer ones that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def load(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def by_bytes(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters each; a longer text alone."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def text_slices(texts: pa.Array, most: int = 16 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts (null: empty) of at most ``most`` bytes each; a longer text alone."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """A text's words in UTF-8: bytes.split() cuts at exactly the six characters of ASCII white space, and
    bytes.lower() changes A-Z alone."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Hashing a word anew is cheaper than a memo whose entries lie all over the memory."""
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), dtype="<u8")


MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * MIX1
    h ^= h >> np.uint64(33)
    h *= MIX2
    h ^= h >> np.uint64(33)
    return h


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes; empty if there are fewer words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, "<u8")
    out = np.full(m, n, "<u8")
    for j in range(n):
        out = (out ^ h[j : j + m]) * MIX1
        out ^= out >> np.uint64(29)
    return mix(out)


def planes(a: np.ndarray) -> bytes:
    """A column's bytes, all first bytes, then all second bytes and so on: sorted or small numbers then compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unplanes(raw: bytes, dtype: str) -> np.ndarray:
    d = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(d.itemsize, -1).T).reshape(-1).view(d)


def packed(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(planes(a))


def unpacked(raw: bytes, dtype: str) -> np.ndarray:
    import zstandard

    return unplanes(zstandard.ZstdDecompressor().decompress(raw), dtype)


#: Fixed value: how byte-level tokenizers cut text before merging, where their file names no pattern.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, k = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], k = chr(k), k + 1
    return out


SYMBOLS = byte_symbols()
_SYMBOL_OF = dict(enumerate(SYMBOLS))


def composed(text: str) -> str:
    """Composed and lower-cased letter by letter (a final sigma as any other)."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class _Generation(dict):
    """A dict that gets what it lacks from its owner."""

    def __init__(self, owner: Recent):
        self.owner = owner

    def __missing__(self, key: str) -> bytes:
        return self.owner.found(key)


class Recent:
    """A memo of bounded bytes in two generations: when the newer one is full, it takes the older one's place."""

    #: What an entry takes besides its characters; keys beyond so many characters are not kept.
    ENTRY, LONG = 200, 64

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.held = make, most // 2, 0
        self.new, self.old = _Generation(self), {}

    def of(self, keys: Iterable[str]) -> bytes:
        """The values of keys, joined."""
        return b"".join(map(self.new.__getitem__, keys))

    def each(self, keys: Iterable[str]) -> list[bytes]:
        return list(map(self.new.__getitem__, keys))

    def found(self, key: str) -> bytes:
        value = self.new.get(key)  # there if a generation ended since the caller took it
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(key) <= self.LONG:
                self.held += len(key) + len(value) + self.ENTRY
                if self.held > self.most:
                    self.old, self.new, self.held = self.new, _Generation(self), 0
                self.new[key] = value
        return value


#: White space besides the single space and the line feed.
OTHER = re.compile(f"[{SPACE.replace(r'\x20', '').replace(r'\t-\r', r'\t\x0b-\r\x1c-\x1f')}]")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: A chunk of a text that is kept as it is: ASCII letters, perhaps after a space, and punctuation; two words to its pattern.
LETTERS = r"^(?P<letters> ?[A-Za-z]+)(?P<rest>[!-/:-@\[-`{-~]*)$"
#: UTF-8 of the white space beyond ASCII, as numbers.
WIDE = np.array([int.from_bytes(c.encode(), "big") for c in map(chr, range(0x80, 0x3001)) if re.match(f"[{SPACE}]", c)])


class Chunks:
    """Encodes whole texts with the tokenizers library by way of their distinct chunks.

    A chunk is cut where no token can cross: at white space, which a byte-level tokenizer keeps as one leading space or
    as runs of its own. A new chunk is cut into words by the tokenizer's pattern and each word goes to the library's
    model. ``several`` does so for the distinct chunks of many texts at once, with Arrow and numpy around them; where the
    text is kept as it is, its chunks take the white space before them along. Memos of
    chunks and words are bounded in bytes; texts that hold a special token's string go through the library as they are,
    as do all texts if the file has other rules than those known here.
    """

    def __init__(self, path: str, most: int = 192 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.keeps, pattern = rules_of(spec)
        if pattern:
            self.find = re.compile(f"[{SPACE}]+(?![^{SPACE}])| ?[^{SPACE}]+|[{SPACE}]+" if self.keeps else f"[^{SPACE}]+").findall
            self.cut = regex.compile(pattern).findall
            # chunks that are cut together end with a character that is a word of its own and, to those before it, the end
            self.end = "\0" if self.keeps else "\n"
            if self.keeps:
                pattern = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\s\p{L}\p{N}\0]").replace(r"(?!\S)", r"(?![^\s\0])")
                plain = pattern.replace(r"[^\s\p{L}\p{N}\0]", r"(?:[^\w\s\0]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
            else:
                plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\w\s]|_)").replace(r"[\p{L}]", r"[^\W\d_]").replace(r"[\p{N}]", r"\d")
            self.lines = regex.compile(f"{pattern}|{self.end}").findall
            self.plain_lines = self.lines if r"\p" in plain else re.compile(f"{plain}|{self.end}").findall
        self.known = bool(pattern)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.words = Recent(self.tokens, most // 2)
        self.seen = Recent(self.part, most // 8 if self.keeps else most // 2)
        self.spaced = Recent(lambda w: self.part(" " + w), most * 3 // 8)

    def library(self, texts: Iterable[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(list(texts), add_special_tokens=False)]

    def pieces(self, chunk: str) -> list[str]:
        """The words of a chunk; letters with punctuation behind them, by far the most, need no pattern."""
        core = chunk.rstrip(PUNCTUATION)
        if (core[1:] if core[:1] == " " else core).isalpha():
            return [core, chunk[len(core) :]] if len(core) < len(chunk) else [core]
        return self.cut(chunk)

    def tokens(self, word: str) -> bytes:
        spelt = word.replace(" ", "\u0120") if word.isascii() and word.isprintable() else word.encode("utf-8", "surrogatepass").decode("latin-1").translate(_SYMBOL_OF)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def part(self, chunk: str) -> bytes:
        return self.words.of(self.pieces(chunk if self.keeps else composed(chunk)))

    def one(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not self.known or any(s in text for s in self.special):
            return self.library([text])[0]
        if not self.keeps:
            odd = any(c in text for c in "\x1c\x1d\x1e\x1f")  # white space to split() alone
            return self.seen.of(self.find(text) if odd else text.split())
        if text[:1] in " \n" or text[-1:] in " \n" or any(x in text for x in ("  ", " \n", "\n ", "\n\n")) or OTHER.search(text):
            return self.seen.of(self.find(text))
        # words between single spaces and line feeds: each after a space takes it along
        out = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out += [self.seen.of((first,)), self.spaced.of(rest)]
        return self.seen.of("\n").join(map(b"".join, zip(out[::2], out[1::2], strict=True)))

    def several(self, texts: pa.Array, whole: str = "") -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (null: none), one text after the other, and how many each has.

        Each distinct chunk is cut once and each distinct word is asked for once, however small the memo is; all that is
        done for every chunk is done by Arrow and numpy. Texts with a character of ``whole`` go through the library as
        they are, as do those with characters that Python's Unicode does not know: whether they are letters is the
        library's to say.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        if not self.known:
            parts = [self.one(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(parts), "<u4"), np.array([len(x) // 4 for x in parts], np.int64)
        odd = np.zeros(len(texts), bool)
        for s in [*self.special, *[self.end] * self.keeps]:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if whole:
            odd |= pc.match_substring_regex(texts, f"[{whole}]").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        if self.keeps:
            chunks, bounds = spaced_runs(plain)
        else:
            chunks = pc.ascii_split_whitespace(plain)
            chunks, bounds = chunks.flatten(), chunks.offsets.to_numpy()
        coded = chunks.dictionary_encode()
        index, distinct = coded.indices.to_numpy(), coded.dictionary
        pairs = []
        if self.keeps:  # most chunks are two words to a regular expression of Arrow's; only the others are left
            pair = pc.extract_regex(distinct, LETTERS)
            easy = pair.is_valid()
            pairs, distinct = pair.filter(easy).flatten(), distinct.filter(pc.invert(easy))
            easy = easy.to_numpy(zero_copy_only=False)
            index = np.where(easy, np.cumsum(easy) - 1, np.sum(easy) + np.cumsum(~easy) - 1)[index]
        lines = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), self.end)[0].as_py() + self.end
        lines = lines if self.keeps else composed(lines)
        kinds = {c: unicodedata.category(c) for c in set(lines)}
        if new := "".join(c for c, kind in kinds.items() if kind == "Cn"):
            return self.several(texts, whole + new)
        # separators and numbers that are no digits are the only ones that re sees otherwise than the tokenizer's pattern
        find = self.lines if any(c in "\x1c\x1d\x1e\x1f" or kind in ("Nl", "No") for c, kind in kinds.items()) else self.plain_lines
        coded = pa.concat_arrays([*pairs, pa.array(find(lines), pa.string())]).dictionary_encode()
        words, word = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        end = words.index(self.end)
        words[end] = ""
        # the ids of words, then of chunks (pairs first; each other one ends with a word that has none), then of texts
        ids = self.words.each(words)
        flat, lengths = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        paired = sum(map(len, pairs))
        word = np.concatenate([word[:paired].reshape(2, -1).T.reshape(-1), word[paired:]])
        flat, ends = gathered(flat, lengths, word)
        last = word == end
        last[1:paired:2] = True
        lengths = np.diff(ends[1:][last], prepend=0)
        flat, ends = gathered(flat, lengths, index)
        at = ends[bounds]
        counts = np.diff(at)
        if odd.any():
            whole = [np.frombuffer(x, "<u4") for x in self.library(texts.filter(pa.array(odd)).to_pylist())]
            counts[odd] = [len(x) for x in whole]
            flat = np.insert(flat, np.repeat(at[:-1][odd], counts[odd]), np.concatenate(whole))
        return flat, counts


def spaced_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut wherever white space of ASCII follows a character that is none, which no token of theirs crosses; the
    number of runs before each text, and of all."""
    import pyarrow as pa

    if not len(texts):
        return pa.array([], pa.string()), np.zeros(1, np.int64)
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    data = pa.py_buffer(b"") if data is None else data
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    space = (raw == 32) | (raw - np.uint8(9) < 5)
    first = space.copy()
    first[1:] &= ~space[:-1]
    at = np.flatnonzero(first[1:] & (raw[:-1] >= 0x80)) + 1
    before = raw[at - 3].astype(np.int32) << 16 | raw[at - 2].astype(np.int32) << 8 | raw[at - 1]
    first[at[np.isin(before, WIDE) | np.isin(before & 0xFFFF, WIDE)]] = False
    starts = offsets - offsets[0]
    first[starts[starts < len(raw)]] = True
    at = np.flatnonzero(first)
    runs = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at + offsets[0], offsets[-1]).astype(np.int32)), data)
    return runs, np.searchsorted(at, starts)


def gathered(flat: np.ndarray, lengths: np.ndarray, index: np.ndarray, block: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` (one after the other, of the given lengths) in the order of ``index``; where each begins and
    the last ends."""
    starts = np.cumsum(lengths) - lengths
    ends = np.zeros(len(index) + 1, np.int64)
    np.cumsum(lengths[index], out=ends[1:])
    out = np.empty(ends[-1], flat.dtype)
    for lo in range(0, len(index), block):  # the places of all at once would take many times the memory of the ids
        part = index[lo : lo + block]
        a, b = ends[lo], ends[lo + len(part)]
        out[a:b] = flat[np.repeat(starts[part] - ends[lo : lo + len(part)], lengths[part]) + np.arange(a, b)]
    return out, ends


def rules_of(spec: dict) -> tuple[bool, str]:
    """Whether a tokenizer file keeps the text as it is, and its word pattern; no pattern if its rules are others than
    byte-level alone, or composed and lower-cased text split by a pattern and then spelt in bytes."""
    normal, before = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if spec["model"].get("type") != "BPE" or spec["model"].get("dropout"):
        return True, ""
    if normal is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True):
        return True, BYTE_LEVEL
    steps = [n.get("type") for n in (normal or {}).get("normalizers", [])]
    cuts = before.get("pretokenizers", [])
    if steps == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]:
        return False, cuts[0]["pattern"]["Regex"]
    return True, ""


_CHUNKS: dict[str, Chunks] = {}


def chunks(path: str, most: int = 192 << 20) -> Chunks:
    """One encoder for each Python worker."""
    if path not in _CHUNKS:
        _CHUNKS[path] = Chunks(path, most)
    return _CHUNKS[path]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is; the file is never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)
