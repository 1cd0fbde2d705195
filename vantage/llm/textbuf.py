"""Columnar text helpers for Arrow batches: words, hashes and lines by numpy over raw UTF-8.

A batch is cut into chunks of about ``CHUNK`` bytes of text (a longer document
is a chunk of its own), so memory stays bounded whatever the batch size.
A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``; those are ASCII,
so cutting UTF-8 there is safe.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)

WS = np.zeros(256, bool)
WS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_tables: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    t = _tables.get(name)
    if t is None or len(t) < n:
        size = 1 << max(CHUNK.bit_length(), int(n).bit_length())
        t = np.ones(size, U)
        have = 1
        step = base % (1 << 64)
        while have < size:  # t[have:2*have] = t[:have] * base**have
            with np.errstate(over="ignore"):
                t[have:2 * have] = t[:min(have, size - have)] * U(step)
            step = step * step % (1 << 64)
            have *= 2
        _tables[name] = t
    return t[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: a bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def prefix(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Running polynomial sums; :func:`span_hash` reads the hash of any span from them."""
    out = np.zeros(len(values) + 1, U)
    name = "w" if base == _BASE else f"w{base}"
    np.cumsum(values.astype(U) * _powers(name, base, len(values)), out=out[1:])
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for every span, the length included."""
    inv = _powers("inv", _BASE_INV, len(pre))
    h = (pre[end] - pre[start]) * inv[start]
    return mix(h + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


@dataclass
class Chunk:
    """Rows [first_row, first_row + n) of a batch: their bytes and the offsets between rows."""

    first_row: int
    buf: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """Chunks of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield Chunk(i, buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """Words of a chunk: byte spans, hashes, and per document the index of its first word."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, cut at document borders too."""
    n = len(inside)
    flag = np.zeros(n + 1, bool)
    flag[1:n] = inside[1:] & ~inside[:-1]
    if n:
        flag[0] = inside[0]
    border = offsets[(offsets < n)]
    flag[border] |= inside[border] if n else False
    start = np.flatnonzero(flag[:n])
    flag = np.zeros(n + 1, bool)
    flag[1:n] = inside[:-1] & ~inside[1:]
    if n:
        flag[n] = inside[-1]
    border = offsets[(offsets > 0)]
    if n:
        flag[border] |= inside[border - 1]
    return start, np.flatnonzero(flag)


def words(chunk: Chunk, lower: bool = False) -> Words:
    buf = LOWER[chunk.buf] if lower else chunk.buf
    start, end = edges(~WS[buf], chunk.offsets)
    h = span_hash(prefix(buf), start, end)
    return Words(start, end, np.searchsorted(start, chunk.offsets), h)


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within one document, and the word index each starts at."""
    last = np.repeat(w.first[1:], w.counts)
    at = np.flatnonzero(np.arange(len(w.hash)) + k <= last)
    return span_hash(prefix(w.hash), at, at + k), at
