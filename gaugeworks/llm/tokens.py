"""Words of a whole Arrow column at once, in numpy: bounds, 64-bit hashes, shingles.

Works on the UTF-8 bytes. A-Z are lower-cased, other letters stay as they are. Null texts
have no words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that make words: all but blanks, or letters and digits (with every byte of non-ASCII).
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1B54A32D192ED03))
_powers = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def _power(kind: str, n: int) -> np.ndarray:
    known = _powers[kind]
    if len(known) < n:
        size = 1 << int(n - 1).bit_length()
        steps = np.full(size, _BASE if kind == "up" else _BACK, _U)
        steps[0] = 1
        known = _powers[kind] = np.cumprod(steps, dtype=_U)
    return known[:n]


@dataclass
class Words:
    data: np.ndarray  #: lower-cased bytes of all texts, one after the other
    offsets: np.ndarray  #: where each text begins, and the end
    start: np.ndarray  #: first byte of each word
    end: np.ndarray  #: byte after each word
    first: np.ndarray  #: number of the first word of each text, and the count

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, _U)
        sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTE[self.data] * _power("up", n), out=sums[1:])
        own = (sums[self.end] - sums[self.start]) * _power("down", n)[self.start]
        return mix(own + (self.end - self.start).astype(_U))

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(column: pa.Array, inside: np.ndarray = NOT_BLANK) -> Words:
    raw, offsets = buffers(column)
    data = LOWER[raw]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, np.zeros(len(offsets), np.int64))
    own = inside[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = own[:-1], own[1:]
    cuts = offsets[1:-1]
    before[cuts[cuts < n]] = False
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(own & ~before)
    end = np.flatnonzero(own & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def shingle_sets(words: Words, n: int):
    """For each text the sorted distinct hashes of its n-word shingles. A text of fewer words,
    but not none, has one: the whole sequence."""
    h = words.hashes()
    grams = h
    for k in range(1, n):
        grams = mix(grams[: max(len(h) - k, 0)] * _U(0xD6E8FEB86659FD93) + h[k:])
    for d in range(len(words.first) - 1):
        a, b = words.first[d], words.first[d + 1]
        if b - a >= n:
            own = np.sort(grams[a : b - n + 1])
            yield own[np.append(True, own[1:] != own[:-1])]
        elif b > a:
            whole = h[a : a + 1]
            for k in range(a + 1, b):
                whole = mix(whole * _U(0xA0761D6478BD642F) + h[k : k + 1])
            yield mix(whole + _U(b - a))
        else:
            yield h[:0]
