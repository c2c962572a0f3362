"""Words of whole Arrow text columns as numpy arrays: positions, hashes, windows.

Texts are read as UTF-8 bytes, so a word class is a table over the 256 byte
values: each class here keeps every byte of a character outside ASCII. Columns
are taken in pieces of half a MB, cut between texts, so memory does not follow
the size of an Arrow batch; a text longer than a piece is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (of lower-cased text)
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_LOW = 12


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_NEAR = _powers(int(_BASE), 1 << _LOW)
_FAR_BASE = int(_NEAR[-1]) * int(_BASE) % (1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of some texts: byte positions in ``data``, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        self.data = _LOWER[data]
        self.offsets = offsets
        self.texts = len(offsets) - 1
        inside = word_bytes[self.data]
        before = np.empty(len(inside) + 1, bool)
        before[0] = before[-1] = False
        before[1:-1] = inside[:-1]
        before[offsets] = False  # a word ends where its text ends
        self.starts = np.flatnonzero(inside & ~before[:-1])
        after = np.empty(len(inside) + 1, bool)
        after[: len(inside)] = inside
        after[-1] = False
        after[offsets] = False
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        length = self.ends - self.starts
        at = np.arange(int(length.sum()))
        begin = np.cumsum(length) - length
        at -= np.repeat(begin, length)  # place of each byte in its word
        value = self.data[np.repeat(self.starts, length) + at].astype(np.uint64)
        value += np.uint64(1)
        longest = int(length.max())
        if longest <= 1 << _LOW:
            value *= _NEAR[at]
        else:
            value *= _NEAR[at & ((1 << _LOW) - 1)]
            value *= _powers(_FAR_BASE, (longest >> _LOW) + 1)[at >> _LOW]
        return mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * _STEP)

    def text(self, start: int, k: int) -> bytes:
        """``k`` words from ``start``, joined by single spaces."""
        return b" ".join(
            self.data[s:e].tobytes()
            for s, e in zip(self.starts[start : start + k], self.ends[start : start + k])
        )


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` words, in place of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, k * int(_STEP) % (1 << 64), np.uint64)
    for j in range(k):
        total *= _BASE
        total += hashes[j : j + n]
    return mix(total)


def pieces(column: pa.Array, word_bytes: np.ndarray) -> Iterator[tuple[int, Words]]:
    """``(index of the first text, words)`` for successive pieces; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        upto = int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1
        upto = min(max(upto, at + 1), len(column))
        own = offsets[at : upto + 1]
        yield at, Words(data[own[0] : own[-1]], own - own[0], word_bytes)
        at = upto
