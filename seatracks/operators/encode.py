"""Messages back to sentences, by column expressions: for queries and tests over known values."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .decode import BASE64, LETTERS, WORD, _buffers, checksum
from .layouts import HEADER, TEXT, width

BODY = 60
#: Payload characters of the values 0 to 63.
ARMOUR = "".join(chr(i + 48 if i < 40 else i + 56) for i in range(64))


#: Bits of several numbers that one number holds.
RUN = 62


def _numbers(run: list[tuple[Column | None, int]]) -> Column:
    """Numbers with their bits, side by side; None is zero."""
    total, left = F.lit(0).cast("long"), sum(n for _, n in run)
    bits = left
    for value, n in run:
        left -= n
        if value is not None:
            total = total.bitwiseOR(F.shiftleft(value.cast("long").bitwiseAND(F.lit((1 << n) - 1).cast("long")), left))
    return F.lpad(F.bin(total), bits, "0")


def _text(value: Column, bits: int) -> Column:
    """Upper-cased six-bit text with @ behind it; 8 characters at a time."""
    n = bits // 6
    hexes = F.hex(F.unbase64(F.rpad(F.translate(F.rpad(F.upper(value), n, "@"), LETTERS, BASE64), -(-n // 8) * 8, "A")))
    words = [F.lpad(F.conv(F.substring(hexes, i * 12 + 1, 12), 16, 2), WORD, "0") for i in range(-(-n // 8))]
    return F.rpad(F.substring(F.concat(*words), 1, n * 6), bits, "0")


def bits_of(layouts: list[str], values: dict[str, Column]) -> Column:
    """The bits of a message; fields without a value are zero."""
    parts: list[Column] = []
    run: list[tuple[Column | None, int]] = []

    def close() -> None:
        if any(value is not None for value, _ in run):
            parts.append(_numbers(run))
        elif run:
            parts.append(F.lit("0" * sum(n for _, n in run)))
        run.clear()

    for item in " ".join([HEADER, *(TEXT[n] for n in layouts)]).split():
        name, _, spec = item.partition(":")
        n = int(spec.partition("=")[0].lstrip("uscr"))
        value = None if name == "_" else values.get(name)
        text = value is not None and spec[0] == "c"
        if text or n + sum(k for _, k in run) > RUN:
            close()
        if text:
            parts.append(_text(value, n))
        else:
            run.append((value, n))
    close()
    return F.concat(*parts)


def _armoured(bits: pa.Array) -> pa.Array:
    """Texts of one length of bits as payload characters, with zeros to a whole one."""
    text = bits.cast(pa.large_string())
    valid = text.drop_null()
    if not len(valid):
        return pa.nulls(len(text), pa.string())
    _, data = _buffers(valid)
    rows = np.frombuffer(data, np.uint8).reshape(len(valid), -1) - ord("0")
    rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 6))).reshape(len(valid), -1, 6)
    chars = np.frombuffer(ARMOUR.encode(), np.uint8)[rows @ np.array([32, 16, 8, 4, 2, 1], np.uint8)]
    out = pa.array(np.ascontiguousarray(chars).view(f"S{chars.shape[1]}").ravel(), pa.binary()).cast(pa.string())
    if not text.null_count:
        return out
    at = np.cumsum(np.asarray(text.is_valid())) - 1
    return pc.take(out, pa.array(at, pa.int64(), mask=np.asarray(text.is_null())))


def armour(bits: Column, n: int) -> tuple[Column, int]:
    """The payload of n bits, and the bits of padding."""
    return F.arrow_udf(_armoured, StringType())(bits), -n % 6


def bits_in(layouts: list[str]) -> int:
    return width(HEADER) + sum(width(TEXT[n]) for n in layouts)


def sentence(fragments: int, fragment: int, sequence: Column, channel: Column, payload: Column, pad: int) -> Column:
    body = F.concat(F.lit(f"!AIVDM,{fragments},{fragment},"), sequence, F.lit(","), channel, F.lit(","), payload, F.lit(f",{pad}*"))
    return F.concat(body, checksum(body))
