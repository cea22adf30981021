"""NMEA/AIVDM sentences to typed message tables, by column expressions.

Lines come with ``path`` and ``line_no`` (see the sources). Only sentences of messages in several parts are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from .carry import BLOCK, last_known
from .layouts import LAYOUTS, LEGENDS, LENGTHS, SCALED, Field

LEAST_BITS = 168


_HEX = pa.array([f"{i:02X}" for i in range(256)])


def _buffers(text: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where texts begin and end, and their bytes."""
    _, at, data = text.buffers()
    offsets = np.frombuffer(at, np.int64)[text.offset : text.offset + len(text) + 1] if at else np.zeros(1, np.int64)
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once for each row: a generator of one row, which no filter or projection on them
    is pushed through (each would carry a copy of the whole expression)."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def checksum(sentence: Column) -> Column:
    """Upper-case hexadecimal exclusive or of the bytes between ``!`` and ``*``; 00 without both."""
    return F.arrow_udf(_checksums, StringType())(sentence)


def _checksums(sentence: pa.Array) -> pa.Array:
    text = sentence.cast(pa.large_string())
    offsets, data = _buffers(text)
    stars = np.asarray(pc.fill_null(pc.find_substring(text, "*"), -1))
    sums = np.concatenate(([0], np.bitwise_xor.accumulate(data))).astype(np.uint8)
    start = offsets[:-1]
    first = np.append(data, 0)[start]  # of a text that is empty, the next one's; it has no star
    whole = (stars > 0) & (first == ord("!"))
    values = np.where(whole, sums[start + np.where(whole, stars, 0)] ^ sums[start + whole], 0).astype(np.int32)
    return pc.take(_HEX, pa.array(values, pa.int32(), mask=np.asarray(text.is_null())))


def verify_sentences(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed sentences with their tokens (fragments, fragment, channel, payload, pad), and the rejected lines
    with their reason. Text after the checksum is dropped first."""
    s = F.regexp_replace("_s", r"(\*[0-9A-Fa-f]{2}),.*$", "$1")
    out = once(once(lines.withColumnRenamed("sentence", "_s"), sentence=s).drop("_s"), _t=F.split(F.col("sentence"), ","))
    number = lambda i: F.get("_t", F.lit(i)).try_cast("int")
    reason = (
        F.when(F.col("sentence").isNull() | ~F.col("sentence").startswith("!"), "no sentence")
        .when(F.size("_t") < 7, "too few tokens")
        .when(~F.col("sentence").rlike(r"\*[0-9A-Fa-f]{2}$"), "no checksum")
        .when(checksum(F.col("sentence")) != F.upper(F.regexp_extract("sentence", r"\*([0-9A-Fa-f]{2})$", 1)), "bad checksum")
        .when(number(1).isNull() | number(2).isNull(), "bad fragment number")
    )
    pad = F.coalesce(F.regexp_extract(F.get("_t", F.lit(6)), r"^(\d)", 1).try_cast("int"), F.lit(0))
    out = once(out, reject_reason=reason, fragments=number(1), fragment=number(2), channel=F.get("_t", F.lit(4)), payload=F.get("_t", F.lit(5)), pad=pad).drop("_t")
    return out.where("reject_reason is null").drop("reject_reason"), out.where("reject_reason is not null")


def assemble(ok: DataFrame, block: int = BLOCK) -> DataFrame:
    """path, line_no (of the last part), raw, payload, pad and date of each whole message.

    Parts of a channel belong to the first part before them; a message is whole if its parts are exactly 1 to the
    number they state. Its date is its first part's. A file is taken in blocks of so many lines, over whose borders the
    first part's place is carried.
    """
    cols = ("path", "line_no", "raw", "payload", "pad", "date")
    single = ok.where("fragments <= 1").select("path", "line_no", F.col("sentence").alias("raw"), "payload", "pad", "date")
    parts = last_known(ok.where("fragments > 1"), ["path", "channel"], "line_no", F.when(F.col("fragment") == 1, F.col("line_no")), "_asm", block).where("_asm is not null")
    part = F.struct("line_no", "fragment", "payload", "pad", "sentence", "date")
    whole = parts.groupBy("path", "channel", "_asm").agg(F.array_sort(F.collect_list(part)).alias("_p"), F.min_by("fragments", "line_no").alias("_n"))
    whole = whole.withColumn("_p", F.slice("_p", 1, F.col("_n"))).where(F.transform("_p", lambda p: p["fragment"]) == F.sequence(F.lit(1), F.col("_n")))
    last = F.element_at("_p", -1)
    whole = whole.select("path", last["line_no"].alias("line_no"), F.array_join(F.transform("_p", lambda p: p["sentence"]), "\n").alias("raw"), F.array_join(F.transform("_p", lambda p: p["payload"]), "").alias("payload"), last["pad"].alias("pad"), F.get("_p", F.lit(0))["date"].alias("date"))
    return single.unionByName(whole.select(*cols))


def first_type(payload: Column) -> Column:
    """The message type from the first character alone, so that a filter by type needs no decoding."""
    c = F.ascii(payload) - 48
    return F.when(c > 40, c - 8).otherwise(c)


#: Bits of a word, which are the digits of 8 characters.
WORD = 48
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Payload characters in order of code, and the base64 digits of their values: 48 off, and 8 more above 40.
_ARMOUR = "".join(map(chr, range(48, 120)))
_DIGITS = "".join(BASE64[i - 8 if i > 40 else i] for i in range(72))
#: Six-bit text: 0 to 31 are @ to _, then blank to ?.
LETTERS = "".join(chr(i + 64 if i < 32 else i) for i in range(64))


#: The value of each byte of a payload; those that code nothing are zeros.
_VALUES = np.zeros(256, np.int64)
_VALUES[[ord(c) for c in _ARMOUR]] = [BASE64.index(c) for c in _DIGITS]


def _words(payload: pa.Array, used: pa.Array) -> pa.Array:
    """The bits of payloads, as far as they are used, as numbers of 48."""
    text = payload.cast(pa.large_string())
    text = pc.if_else(pc.string_is_ascii(text), text, pc.replace_substring_regex(text, r"[^\x00-\x7f]", "/"))
    bits = np.asarray(pc.fill_null(used, 0)).astype(np.int64)
    offsets, data = _buffers(text)
    n = -(-bits // 6)
    words = np.maximum(-(-n // 8), -(-(LEAST_BITS // 6 + 4) // 8))
    ends = np.concatenate(([0], np.cumsum(words)))
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    digits = _VALUES[data[offsets[row] + place]]
    # the pad's share of the last character is cleared
    spare = (n * 6 - bits)[row]
    digits = np.where(place == n[row] - 1, digits >> spare << spare, digits)
    grid = np.zeros(int(ends[-1]) * 8, np.int64)
    grid[ends[row] * 8 + place] = digits
    values = (grid.reshape(-1, 8) << np.arange(42, -1, -6)).sum(axis=1)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values), mask=pc.or_(text.is_null(), used.is_null()))


def to_words(packets: DataFrame) -> DataFrame:
    """``words``: the bits as numbers of 48, from the first on, without the pad and with zeros at the end; and ``bitlen``,
    the bits of the payload without the pad. Characters that code nothing count as zeros."""
    kept = F.greatest(F.length("payload") * 6 - F.col("pad"), F.lit(0))
    return once(once(packets, bitlen=kept), words=F.arrow_udf(_words, ArrayType(LongType()))("payload", "bitlen"))


def _bits(at: int, width: int) -> Column:
    """A number of up to 48 bits. Bits past the message's end are zeros."""
    i, off = divmod(at, WORD)
    word = lambda k: F.coalesce(F.get("words", F.lit(k)), F.lit(0))
    if off + width <= WORD:
        return F.shiftright(word(i), WORD - off - width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
    rest = off + width - WORD
    high = word(i).bitwiseAND(F.lit((1 << (WORD - off)) - 1).cast("long"))
    return F.shiftleft(high, rest).bitwiseOR(F.shiftright(word(i + 1), WORD - rest))


def unsigned(at: int, width: int) -> Column:
    return _bits(at, width).cast("int")


def _length() -> Column:
    """Bits of a message, which has at least 168."""
    return F.greatest("bitlen", F.lit(LEAST_BITS))


def text_of(at: int, width: int) -> Column:
    """Six-bit text up to the first @, without trailing blanks; letters that the message has no more whole are left out."""
    n = width // 6
    words = F.concat(*[F.lpad(F.hex(F.shiftleft(_bits(at + i, min(WORD, width - i)), max(0, WORD - width + i))), 12, "0") for i in range(0, width, WORD)])
    whole = F.least(F.lit(n), F.floor((_length() - at) / 6).cast("int"))
    letters = F.left(F.translate(F.base64(F.unhex(words)), BASE64 + "\r\n", LETTERS), whole)
    return F.rtrim(F.substring_index(letters, "@", 1))


def raw_of(at: int, width: int) -> Column:
    """Bits as text, as far as the message goes."""
    bits = F.array_join(F.transform("words", lambda w: F.lpad(F.bin(w), WORD, "0")), "")
    return F.substring(F.rpad(bits, LEAST_BITS, "0"), F.lit(at + 1), F.least(F.lit(width), _length() - at))


def extract(f: Field) -> Column:
    """A field's value; null if it begins at or past the end of the (zero-extended) message."""
    if f.kind == "c":
        value = F.when(_length() >= f.at + 6, text_of(f.at, f.width)).otherwise(F.lit(""))
    elif f.kind == "r":
        value = raw_of(f.at, f.width)
    else:
        value = unsigned(f.at, f.width)
        if f.kind == "s":
            value = (_bits(f.at, f.width) - F.when(unsigned(f.at, 1) == 1, F.lit(1 << f.width)).otherwise(F.lit(0))).cast("int")
    return F.when(F.lit(f.at) < _length(), value).alias(f.name)


def _picked(layout: str) -> Column:
    """Which messages of a type have this layout."""
    types, fs = LAYOUTS[layout]
    of_type = F.col("msgtype").isin(*types)
    at = {f.name: f for f in fs}
    if types[0] in (6, 8):
        dac, fid = unsigned(at["dac"].at, 10), unsigned(at["fid"].at, 6)
        known = (dac == 235) & (fid == 10) if types[0] == 6 else (dac == 1) & (fid == 11)
        return of_type & (known if "dac" in layout else ~known)
    if types[0] == 24:
        part, auxiliary = unsigned(38, 2), unsigned(8, 30).between(980000000, 989999999)
        return of_type & {"type24a": part == 0, "type24b1": (part == 1) & ~auxiliary, "type24b2": (part == 1) & auxiliary}[layout]
    if types[0] == 25:
        return of_type & (unsigned(38, 1) == int(layout[-2])) & (unsigned(39, 1) == int(layout[-1]))
    return of_type


def typed(packets: DataFrame, types: Sequence[int] | None = None) -> DataFrame:
    """Packets as words with their ``msgtype``, whether their length is out of range (``bogon``) and why they are
    rejected, if so. A filter by type comes before any payload is read."""
    if types:
        packets = packets.where(first_type(F.col("payload")).isin(*types))
    out = once(to_words(packets), msgtype=unsigned(0, 6))
    fits = reduce(lambda a, t: a.when(F.col("msgtype") == t, F.col("bitlen").between(*LENGTHS[t])), LENGTHS, F.when(F.lit(False), F.lit(True)))
    epfd = reduce(lambda a, x: a.when(F.col("msgtype").isin(*x[0]), unsigned(x[1], 4)), [(LAYOUTS[n][0], next(f.at for f in LAYOUTS[n][1] if f.name == "epfd")) for n in ("type4", "type5", "type19", "type21")], F.when(F.lit(False), F.lit(0)))
    station, ship24 = unsigned(next(f.at for f in LAYOUTS["type23"][1] if f.name == "stationtype"), 4), unsigned(40, 8)
    reason = (
        F.when(~F.col("msgtype").between(1, 27), "message type")
        .when(epfd.between(9, 14), "epfd")
        .when((F.col("msgtype") == 24) & (unsigned(38, 2) == 1) & (ship24 > 99), "ship type")
        .when((F.col("msgtype") == 24) & (unsigned(38, 2) > 1), "part number")
        .when((F.col("msgtype") == 23) & (station > 31), "station type")
        .when(F.col("msgtype") == 26, "no layout")
    )
    return once(out, bogon=~F.coalesce(fits, F.lit(False)), reject_reason=reason)


def _twelve(x: Column) -> Column:
    """A number's text with twelve significant digits."""
    out = F.round(x, 15)
    for power in range(-2, 3):
        out = F.when(F.abs(x) >= 10.0**power, F.round(x, 11 - power)).otherwise(out)
    return out.cast("string")


def _scaled(rule: str, c: Column) -> Column:
    """A field's scaled text by its rule in ``SCALED``."""
    text = c.cast("string")
    if rule in LEGENDS:
        return F.coalesce(F.get(F.array(*map(F.lit, LEGENDS[rule])), c), F.lit(LEGENDS[rule][0]))
    if rule == "turn":
        return F.when(c == -127, "fastleft").when(c == 127, "fastright").otherwise(_twelve(F.pow(c / 4.733, 2)))
    if rule in ("speed", "whole_speed"):
        return F.when(c == 1022, "fast").otherwise(text if rule == "whole_speed" else _twelve(c / 10.0))
    if rule == "second":
        return F.when(c == 60, "n/a").when(c == 61, "manual input").when(c == 62, "dead reckoning").when(c == 63, "inoperative").otherwise(text)
    if rule == "alt":
        return F.when(c == 4094, ">=4094").otherwise(text)
    if rule[0] == "/":
        return _twelve(c / float(rule[1:]))
    if rule[0] == "+":
        return (c + int(rule[1:])).cast("string")
    factor, _, less = rule[1:].partition("-")
    return _twelve(c * float(factor) - float(less or 0))


def scale(layout: str) -> dict[str, Column]:
    """The scaled form of a layout's columns as text: sentinels are n/a, legends for indexes, units applied."""
    rules = dict(x.split(":") for x in SCALED.get(layout, "").split())
    out = {}
    for f in LAYOUTS[layout][1]:
        if f.kind not in "us":
            continue
        c = F.col(f.name)
        value = _scaled(rules[f.name], c) if f.name in rules else c.cast("string")
        out[f.name] = F.when(c == f.missing, "n/a").otherwise(value) if f.missing is not None else value
    for keep in ("msgtype", "repeat", "mmsi"):
        out.pop(keep, None)
    return out


def decode_rows(packets: DataFrame, types: Sequence[int] | None = None, mode: str = "permissive") -> DataFrame:
    """All messages in one pass: path, line_no, date, raw, msgtype, ``layout`` (null for rejects), bogon, reject_reason and
    a struct for each layout, null but for the message's own. Parts A and B of type 24 stay rows of their own.

    Write it, by layout if many tables are wanted, and read the structs from there: what isn't selected isn't made.
    ``mode="failfast"`` raises on the first reject instead.
    """
    bad = F.col("bogon") | F.col("reject_reason").isNotNull()
    ready = typed(packets, types)
    if mode == "failfast":
        ready = ready.where(F.when(bad, F.raise_error(F.concat(F.lit("rejected message: "), "raw")).cast("boolean")).otherwise(F.lit(True)))
    names = [n for n, (of, _) in LAYOUTS.items() if not types or set(of) & set(types)]
    layout = reduce(lambda a, n: a.when(_picked(n), n), names, F.when(bad, F.lit(None).cast("string")))
    ready = once(ready, layout=layout)
    return ready.select("path", "line_no", "date", "raw", "msgtype", "layout", "bogon", "reject_reason", *[F.when(F.col("layout") == n, F.struct(*[extract(f) for f in LAYOUTS[n][1]])).alias(n) for n in names])


class Tables(Mapping):
    """A table for each layout, and ``rejects``, each made when it is asked for."""

    def __init__(self, make: Callable[[str], DataFrame], names: Sequence[str]):
        self.make, self.names = make, list(names)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        return self.make(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


def decode(packets: DataFrame, types: Sequence[int] | None = None, scaled: bool = False, mode: str = "permissive") -> Tables:
    """A table for each layout, and ``rejects`` (bogons and messages that break a rule).

    ``mode="failfast"`` raises on the first reject instead. Parts A and B of type 24 stay rows of their own. Each table
    is a pass of its own; for many, write ``decode_rows`` by layout.
    """
    ready, bad = typed(packets, types), F.col("bogon") | F.col("reject_reason").isNotNull()
    raised = F.raise_error(F.concat(F.lit("rejected message: "), "raw")).cast("boolean")
    good = ready.where(F.when(bad, raised).otherwise(F.lit(True)) if mode == "failfast" else ~bad)

    def table(name: str) -> DataFrame:
        if name == "rejects":
            return ready.where(bad).select("path", "line_no", "date", "raw", "msgtype", "bogon", "reject_reason")
        out = good.where(_picked(name)).select("path", "line_no", "date", "raw", *[extract(f) for f in LAYOUTS[name][1]])
        if name == "type21":
            out = out.withColumn("name", F.concat("name", F.coalesce("name_ext", F.lit("")))).drop("name_ext")
        return out.withColumns({k: v for k, v in scale(name).items() if k in out.columns}) if scaled else out

    return Tables(table, [*[n for n, (of, _) in LAYOUTS.items() if not types or set(of) & set(types)], "rejects"])


def completed(rows: DataFrame, register: DataFrame, key: str, name: str, room: int) -> DataFrame:
    """Texts that may go on past their field of ``room`` letters: one that fills it becomes the register's text for the
    row's key, if that begins with what was received. The register has a row for each key at most."""
    whole = register.where(F.length(name) > room).select(F.col(key).cast("long").alias("_key"), F.col(name).alias("_whole"))
    full = F.when(F.length(name) == room, F.col(key).try_cast("long"))
    out = rows.withColumn("_full", full).join(whole, F.col("_full") == F.col("_key"), "left")
    return out.withColumn(name, F.when(F.col("_whole").startswith(F.col(name)), F.col("_whole")).otherwise(F.col(name))).select(*rows.columns)


def malformed(packets: DataFrame) -> DataFrame:
    """The raw text of messages whose length is out of range."""
    return typed(packets).where("bogon").select("raw")


def type_histogram(packets: DataFrame) -> DataFrame:
    """key and n: messages by type, and those of types 6 and 8 also by type, area and function code."""
    ready = typed(packets).where("not bogon and reject_reason is null")
    t = F.col("msgtype")
    dac = F.when(t == 6, unsigned(72, 10)).otherwise(unsigned(40, 10))
    fid = F.when(t == 6, unsigned(82, 6)).otherwise(unsigned(50, 6))
    keys = F.array_compact(F.array(t.cast("string"), F.when(t.isin(6, 8), F.format_string("%02d_%04d_%02d", t, dac, fid))))
    return ready.select(F.explode(keys).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def packet_time(date: Column) -> Column:
    """The time of a packet's date text; null if it is no such text."""
    return F.coalesce(F.try_to_timestamp(F.regexp_extract(date, r"^(\d{8}T\d{6})", 1), F.lit("yyyyMMdd'T'HHmmss")), F.try_to_timestamp(date))


#: Of each layout with a position: units of a degree, and of a knot and a degree of course.
POSITIONS = {"cnb": (600000.0, 10.0), "type18": (600000.0, 10.0), "type27": (600.0, 1.0)}


def decode_positions(packets: DataFrame) -> DataFrame:
    """Position reports (types 1-3, 18 and 27) with degrees, knots and sentinels as values, in one pass."""
    rows = typed(packets, types=(1, 2, 3, 18, 27)).where("not bogon and reject_reason is null")

    def by_layout(name: str, of: Callable[[Column, str], Column] = lambda c, _: c) -> Column:
        """A field of whichever layout a message has."""
        out = F.when(F.lit(False), F.lit(None))
        for layout in POSITIONS:
            for f in LAYOUTS[layout][1]:
                if f.name == name:
                    out = out.when(F.col("msgtype").isin(*LAYOUTS[layout][0]), of(extract(f), layout))
        return out

    short = F.col("msgtype") == 27
    rows = once(rows, _speed=by_layout("speed"), _course=by_layout("course"))
    sog = F.when(short & (F.col("_speed") == 63), 102.3).otherwise(F.col("_speed") / F.when(short, 1.0).otherwise(10.0))
    cog = F.when(short & (F.col("_course") == 511), 360.0).otherwise(F.col("_course") / F.when(short, 1.0).otherwise(10.0))
    degrees = lambda c, layout: c / POSITIONS[layout][0]
    return rows.select(
        by_layout("mmsi").cast("long").alias("mmsi"), packet_time(F.col("date")).alias("time"), F.col("msgtype").alias("message_id"), by_layout("status").cast("int").alias("navigational_status"), sog.alias("sog"), cog.alias("cog"),
        F.coalesce(by_layout("heading").cast("double"), F.lit(511.0)).alias("heading"), by_layout("lat", degrees).alias("latitude"), by_layout("lon", degrees).alias("longitude"), "path", "line_no",
    )
