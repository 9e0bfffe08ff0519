"""Vectorised work on the bytes of Arrow string columns.

Words are runs of bytes of a class; classes are made of ASCII bytes and "every
byte of a non-ASCII character", so working on UTF-8 bytes gives the words that
working on characters would give.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PAD = 8
LONG_WORD = 512

U64 = np.uint64
_M1, _M2, _M3 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=U64)

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

#: Bytes of ``[^\x20\x09-\x0D]``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``, for text in lower case.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


class Texts(NamedTuple):
    """Texts ``first`` to ``first + len(offsets) - 1`` of a column, their bytes end to end and PAD zeros."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    #: Word numbers of each text's first word, and of the end of the last text.
    bounds: np.ndarray


def texts(column: pa.Array, limit: int = 1 << 20, table: np.ndarray = ASCII_LOWER) -> Iterator[Texts]:
    """Whole texts of a column in pieces of about ``limit`` bytes, each byte by way of ``table``; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    rows = len(column)
    _, offsets, values = column.buffers()
    if rows == 0:
        return
    offsets = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + rows + 1].astype(np.int64)
    values = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    at = 0
    while at < rows:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        part = values[offsets[at] : offsets[stop]]
        data = np.zeros(len(part) + PAD, np.uint8)
        np.take(table, part, out=data[: len(part)])
        yield Texts(at, data, offsets[at : stop + 1] - offsets[at])
        at = stop


def words(t: Texts, kind: np.ndarray) -> Words:
    """Runs of bytes of a class; a run never crosses from one text to the next."""
    size = len(t.data) - PAD
    inside = kind[t.data[:size]]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = t.offsets[(t.offsets > 0) & (t.offsets < size)]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, t.offsets, "left"))


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values in place, one to one."""
    h ^= h >> U64(30)
    h *= _M1
    h ^= h >> U64(27)
    h *= _M2
    h ^= h >> U64(31)
    return h


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as little-endian numbers."""
    return np.ndarray(len(data) - PAD + 1, dtype="<u8", buffer=data, strides=(1,))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``starts:ends``."""
    chunk, size = eights(data), ends - starts
    out = size.astype(U64) * _M3
    short = np.minimum(size, 8)
    out ^= chunk[starts] & _MASK[short] if len(starts) else out
    mix(out)
    done, left = 8, np.flatnonzero((size > 8) & (size <= LONG_WORD))
    while len(left):
        part = chunk[starts[left] + done] & _MASK[np.minimum(size[left] - done, 8)]
        out[left] = mix((out[left] * _M3) ^ part)
        done += 8
        left = left[size[left] > done]
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` values from every position on; ``len(h) - n + 1`` of them."""
    size = max(0, len(h) - n + 1)
    out = h[:size].copy()
    for k in range(1, n):
        out *= _M3
        out ^= h[k : k + size]
        mix(out)
    return out


def digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits of the bytes of an array, as two signed numbers."""
    found = xxhash.xxh3_128_intdigest(np.ascontiguousarray(values).tobytes())
    high, low = found >> 64, found & ((1 << 64) - 1)
    return high - (high >> 63 << 64), low - (low >> 63 << 64)
