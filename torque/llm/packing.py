"""Packed rows: hashes of a batch's documents, one row per hash bucket.

A row has the documents that occur in it, and per entry a place in that list
and a key. Arrays are laid out byte place by byte place, because runs of
equal high bytes compress well in a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MARK = np.uint32(1 << 31)        # flag of an entry, kept in its place


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(
        np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def document_row(docs: np.ndarray, places: np.ndarray, flags=None) -> tuple[bytes, bytes]:
    """Documents that occur and, per entry, the place in that list and its flag."""
    used, at = np.unique(places, return_inverse=True)
    at = at.astype(np.uint32)
    if flags is not None:
        at |= np.where(flags, MARK, np.uint32(0))
    return planes(docs[used]), planes(at)


def packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
        names=["bucket", "docs", "places", "keys", "found"])


def by_bucket(bucket: np.ndarray, n: int):
    """(bucket, entries) for entries sorted by bucket."""
    edges = np.searchsorted(bucket, np.arange(n + 1))
    return [(b, slice(edges[b], edges[b + 1])) for b in range(n) if edges[b] < edges[b + 1]]


def found_row(docs: np.ndarray, places: np.ndarray, keys: np.ndarray, n: int) -> list[tuple]:
    """Entries that are answered already; any bucket will do, so common ones spread."""
    if not len(places):
        return []
    return [(int(docs[places[0]] % n), *document_row(docs, places), planes(keys), True)]


def bucket_keys(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit key of 64-bit hashes."""
    return (hashes % np.uint64(n)).astype(np.int64), (hashes // np.uint64(n)).astype(np.uint32)
