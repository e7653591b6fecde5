"""Word shingles of a whole Arrow batch of texts at once, on their UTF-8 bytes.

Words are runs of bytes other than space, tab and line ends, with A-Z in lower
case. A word's hash is a polynomial over a random value per byte, taken from
prefix sums; all arithmetic is modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerline.llm.common import mix

CHUNK = 1 << 19  # bytes of text hashed in one step; a longer text is one step of its own
LENGTH = 5

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_VALUE = np.random.default_rng(20_240_501).integers(1, 2**64, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_TURN = [np.uint64(pow(_BASE, k, 1 << 64)) for k in range(1, LENGTH + 1)]


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse, as many as the longest step so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def at_least(self, count: int) -> None:
        if len(self.up) < count:
            self.up, self.down = _powers(_BASE, count), _powers(_BACK, count)


_POWERS = _Powers()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the borders of its texts; a missing text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, borders, data = column.buffers()
    at = np.frombuffer(borders, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8), at


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts between the borders `at`, and the borders of each text's words."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.uint64), np.zeros(len(at), dtype=np.int64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    edge[n] = True
    ends = np.flatnonzero(~space & (edge[1:] | np.concatenate([space[1:], [True]]))) + 1
    begins = np.flatnonzero(~space & (edge[:n] | np.concatenate([[True], space[:-1]])))
    _POWERS.at_least(n)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_VALUE[data] * _POWERS.up[:n], dtype=np.uint64)])
    hashes = (sums[ends] - sums[begins]) * _POWERS.down[begins]
    return mix(hashes + (ends - begins).astype(np.uint64) * np.uint64(_BASE)), np.searchsorted(begins, at)


def _shingles(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes, sorted and distinct within each text, and the borders of each text's."""
    counts = np.diff(at)
    sizes = np.where(counts >= LENGTH, counts - LENGTH + 1, (counts > 0).astype(np.int64))
    borders = np.concatenate([[0], np.cumsum(sizes)])
    values = np.empty(borders[-1], dtype=np.uint64)
    wide = len(words) - LENGTH + 1
    if wide > 0:
        rolled = np.full(wide, LENGTH, dtype=np.uint64)
        for k in range(LENGTH):
            rolled += words[k : k + wide] * _TURN[k]
        rolled = mix(rolled)
    for i in range(len(counts)):
        n = counts[i]
        if n >= LENGTH:
            part = values[borders[i] : borders[i + 1]]
            part[:] = rolled[at[i] : at[i] + n - LENGTH + 1]
            part.sort()
        elif n:
            whole = np.uint64(n)
            for k in range(n):
                whole += words[at[i] + k] * _TURN[k]
            values[borders[i]] = mix(np.array([whole], dtype=np.uint64))[0]
    if not len(values):
        return values, borders
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[borders[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return values[new], kept[borders]


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a column."""
    data, at = buffers(column)
    start = 0
    with np.errstate(over="ignore"):
        while start < len(column):
            end = max(start + 1, int(np.searchsorted(at, at[start] + CHUNK, "right")) - 1)
            end = min(end, len(column))
            words, borders = _words(data[at[start] : at[end]], at[start : end + 1] - at[start])
            values, borders = _shingles(words, borders)
            for i in range(end - start):
                yield values[borders[i] : borders[i + 1]]
            start = end
