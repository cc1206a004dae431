"""Words and their hashes for whole Arrow batches of text, in numpy.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, or outside another set of gaps. Hashes are 64 bits
wide, of the UTF-8 bytes, with A-Z taken as a-z when ``lower`` is set.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass handles; a longer text has a pass of its own.
CHUNK_BYTES = 1 << 21

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)
_STEP = 0xD1342543DE82EF95 | 1
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on an array of unsigned 64-bit integers."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _MUL)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII bytes but letters and digits: gaps between the terms of a search.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_POWERS: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the rolling hash's base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, base in ((0, _STEP), (1, _STEP_INVERSE)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


class Words(NamedTuple):
    """Words of consecutive texts: text i has words first[i]:first[i + 1]."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]] if len(at) else whole, at - at[0] if len(at) else np.zeros(1, np.int64)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True, gaps: np.ndarray = _SPACE) -> Words:
    """Words of the texts that offsets cut data into; start and end count bytes within data. gaps tells for each byte whether it parts words."""
    base = int(offsets[0])
    data = data[base : int(offsets[-1])]
    cuts = (offsets - base).astype(np.int64)
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(len(cuts), np.int64), none, none, np.zeros(0, _U))
    solid = ~gaps[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    inner = cuts[1:-1]
    inner = inner[inner < n]
    opens[inner] = solid[inner]
    start = np.flatnonzero(opens)
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    inner = inner[inner > 0]
    closes[inner - 1] = solid[inner - 1]
    end = np.flatnonzero(closes) + 1
    up, down = powers(n + 1)
    total = np.empty(n + 1, _U)
    total[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * up[:n], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _MUL)
    return Words(np.searchsorted(start, cuts, "left"), start + base, end + base, hashes)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k consecutive entries; texts are not told apart here."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    up, _ = powers(k)
    out = np.zeros(n, _U)
    for j in range(k):
        out += hashes[j : j + n] * up[j]
    return mix(out)


def whole_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash for a sequence shorter than a run, apart from those of runs."""
    up, _ = powers(len(hashes))
    return mix(np.array([(hashes * up).sum(dtype=_U) ^ _U(0xA5A5A5A55A5A5A5A + len(hashes))], _U))
