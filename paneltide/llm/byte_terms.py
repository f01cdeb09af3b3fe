"""Terms of texts straight from their UTF-8 bytes: runs of 0-9, a-z (A-Z count as
lower case) and of every character beyond ASCII. As all bytes of such characters are
128 or more, a table over bytes decides, and a term is held as a 64-bit hash."""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from paneltide.llm.common import mix64

PATTERN_LOWER = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"           # on lower-cased text
PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"        # on the text as it is
BLOCK = 1 << 16                # bytes hashed at once
BASE = 0x9E3779B97F4A7C15 | 1

_BYTE = np.arange(256)
_BYTE[65:91] += 32
IS_TERM = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
VALUE = np.where(IS_TERM, mix64(_BYTE.astype(np.uint64) + np.uint64(1)), np.uint64(0))


class Terms(NamedTuple):
    """Number of terms per text, and the hash of every term in order."""
    counts: np.ndarray
    hashes: np.ndarray


class Spans(NamedTuple):
    """Bytes of all texts, first byte of each text (and the end), terms per text, and the
    first and the next byte of every term."""
    raw: np.ndarray
    at: np.ndarray
    counts: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the power of 0 to n - 1, and of 0 to 1 - n."""
    up = np.full(n, np.uint64(BASE))
    down = np.full(n, np.uint64(pow(BASE, -1, 1 << 64)))
    up[:1] = down[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_POWERS = powers(BLOCK)


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, first byte of each text and the end); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def spans(texts: pa.Array, table: np.ndarray = IS_TERM, parts=None) -> Spans:
    """Where the terms of the texts stand: runs of the bytes that ``table`` marks.
    ``parts(before, byte)`` may say between which bytes a run falls into two terms."""
    raw, at = _buffer(texts)
    none = np.zeros(0, np.int64)
    if not len(raw):
        return Spans(raw, at, np.zeros(len(texts), np.int64), none, none)
    inside = table[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    if parts is not None:
        two = inside[:-1] & inside[1:] & parts(raw[:-1], raw[1:])
        first[1:] |= two
        last[:-1] |= two
    edge = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))]      # where one text meets the next
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Spans(raw, at, np.diff(np.searchsorted(start, at)), start, stop)


def terms(texts: pa.Array) -> Terms:
    """All terms of the texts in order."""
    found = spans(texts)
    return Terms(found.counts, hashes(found))


def hashes(found: Spans, value: np.ndarray = VALUE) -> np.ndarray:
    """The hash of every term from the values of its bytes."""
    raw, start, stop = found.raw, found.start, found.stop
    out = np.empty(len(start), np.uint64)
    a = 0
    with np.errstate(over="ignore"):
        while a < len(start):
            # as many terms as end within a block; a longer term has a block of its own
            b = max(a + 1, int(np.searchsorted(stop, start[a] + BLOCK, side="right")))
            origin, n = start[a], int(stop[b - 1] - start[a])
            up, down = _POWERS if n <= BLOCK else powers(n)
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(value[raw[origin:origin + n]] * up[:n], out=total[1:])
            s, e = start[a:b] - origin, stop[a:b] - origin
            out[a:b] = mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            a = b
    return out


def bit_marks(hashes) -> tuple:
    """(long, bit) of a 64-bit hash in a bitmap of 2^18 longs, for NumPy unsigned arrays."""
    return hashes >> np.uint64(46), hashes & np.uint64(63)


MARKS = 1 << 18


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the bitmap."""
    word, bit = bit_marks(hashes)
    return (bitmap[word.astype(np.int64)] >> bit & np.uint64(1)).astype(bool)


def bitmap_of(hashes) -> np.ndarray:
    """Bitmap of a DataFrame of one column of 64-bit hashes: set bits are gathered by an
    aggregate, at most MARKS rows (2 MB) reach the driver whatever the input."""
    from pyspark.sql import functions as F
    h = F.col(hashes.columns[0])
    rows = hashes.select(F.shiftrightunsigned(h, 46).alias("word"), F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int")).alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(MARKS, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out
