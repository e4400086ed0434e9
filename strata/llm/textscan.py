"""Vectorised scanning of UTF-8 text inside a task: words, their hashes, runs of bytes.

Hashes are polynomial over random byte values, modulo 2**64, then mixed.  They depend
on the bytes alone, so every task on every machine gives a string the same hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from strata.llm.common import byte_views

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII letters and every byte of a non-ASCII character
LETTER = np.zeros(256, dtype=bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
LETTER[0x80:] = True

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 0x20

_pow = np.ones(1, dtype=np.uint64)
_inv = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse."""
    global _pow, _inv
    if len(_pow) <= n:
        size = max(n + 1, 1 << 16)
        with np.errstate(over="ignore"):
            _pow = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _BASE, np.uint64))])
            _inv = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _INV, np.uint64))])
    return _pow, _inv


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of a binary Arrow column in pieces of about ``limit`` bytes: first row, end row, bytes, offsets."""
    raw, off = byte_views(column)
    n, at = len(off) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield at, end, raw[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span."""
    power, _ = _powers(len(raw))
    out = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * power[:len(raw)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = _powers(len(prefix) - 1)
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def lower_latin(raw: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the Latin-1 letters of UTF-8."""
    out = ASCII_LOWER[raw]
    if len(raw) > 1:
        second = out[1:]
        up = (raw[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        second[up] += 0x20
    return out


def words(raw: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes for which ``inside`` holds; none crosses a row. Returns row, start, end."""
    m = np.zeros(len(raw) + 2, dtype=bool)
    m[1:-1] = inside[raw]
    edge = m[1:] != m[:-1]
    first = m[1:-1] & edge[:-1]
    last = m[1:-1] & edge[1:]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    if len(inner):
        first[inner] |= m[1:-1][inner]
        last[inner - 1] |= m[1:-1][inner - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return np.searchsorted(off, start, side="right") - 1, start, end
