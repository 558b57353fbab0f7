"""Distinct-segment evaluation of concatenated texts inside an Arrow batch.

The tokenizer operators cut a batch of texts into short byte segments, work
out a value per *distinct* segment once, and spread the values back. Arrow's
dictionary encoding does the (exact) de-duplication.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_CHARS = 2_000_000  # texts handled at once in a task, unless one text alone is longer


def slices(texts: list[str], limit: int = SLICE_CHARS):
    """Yield (start, stop) runs of texts of about ``limit`` characters in all."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def distinct_segments(data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Codes and distinct values of ``data[bounds[i]:bounds[i + 1]]``."""
    n = len(bounds) - 1
    if n <= 0:
        return np.zeros(0, np.int64), []
    array = pa.Array.from_buffers(pa.large_binary(), n, [
        None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)])
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for each i; empty ranges give 0."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def gather_ranges(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``flat[s:s + n]`` over pairs (s, n)."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
    return flat[at]
