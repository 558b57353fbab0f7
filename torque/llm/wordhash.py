"""Word and window hashes of an Arrow batch of texts, in numpy.

Words are runs of bytes other than ASCII white space. A word's hash comes from
running sums of byte * base^place (so all words of a batch are hashed at once)
and is well mixed afterwards; a window's hash combines its words' hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xC2B2AE3D27D4EB4F)
SLICE_BYTES = 2_000_000          # texts handled at once, unless one alone is longer

_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    if n > 4 * SLICE_BYTES:          # one very long text: not worth keeping
        run = np.full(n, base, np.uint64)
        run[0] = 1
        return np.cumprod(run, dtype=np.uint64)
    if len(_POWERS[name]) < n:
        run = np.full(max(n, SLICE_BYTES), base, np.uint64)
        run[0] = 1
        _POWERS[name] = np.cumprod(run, dtype=np.uint64)
    return _POWERS[name][:n]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Yield (first row, rows) parts of a string column, by size."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        stop = min(max(stop, at + 1), len(column))
        yield at, column.slice(at, stop - at)
        at = stop


class Words:
    """Words of a column without nulls.

    ``start``/``end`` are byte places in ``data``; the words of row i are
    ``bounds[i]:bounds[i + 1]``.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[
            column.offset:column.offset + len(column) + 1]
        values = column.buffers()[2]
        raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        self.data = raw[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        n = len(self.data)
        black = np.zeros(n + 1, bool)
        black[:n] = ~_WHITE[self.data]
        fresh = np.zeros(n + 1, bool)
        fresh[offsets] = True
        before = np.concatenate(([False], black[:-1]))
        self.start = np.flatnonzero(black & (~before | fresh))
        self.end = np.flatnonzero(before & (~black | fresh))
        self.bounds = np.searchsorted(self.start, offsets)
        self.lower = lower

    def hashes(self) -> np.ndarray:
        data = _LOWER[self.data] if self.lower else self.data
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers("up", BASE, n), out=sums[1:])
        own = (sums[self.end] - sums[self.start]) * powers("down", BASE_INVERSE, n + 1)[self.start]
        return mix(own ^ (self.end - self.start).astype(np.uint64) * STEP)

    def texts(self, row: int, keep: np.ndarray | None = None) -> list[bytes]:
        a, b = self.bounds[row], self.bounds[row + 1]
        pairs = zip(self.start[a:b].tolist(), self.end[a:b].tolist())
        data = self.data.tobytes() if len(self.data) < 1 << 16 else memoryview(self.data)
        if keep is None:
            return [bytes(data[s:e]) for s, e in pairs]
        return [bytes(data[s:e]) for (s, e), k in zip(pairs, keep) if k]


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` neighbouring words (of one row or of many:
    windows over a row's end are for the caller to leave out)."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * STEP + words[j:j + n]
    return mix(out)
