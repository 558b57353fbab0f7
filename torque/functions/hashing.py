"""Deterministic pseudo-random column expressions.

A draw is the first 60 bits of ``md5(seed|key|tag)``: a pure function of the
row, so generated data is identical under any partitioning, task retry or
executor loss, and any engine with MD5 can restate it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, key: Column, tag: str | Column) -> Column:
    """Whole number in [0, 2^60), uniform over (seed, key, tag)."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    text = F.concat_ws("|", F.lit(str(seed)), key.cast("string"), tag)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def uniform_int(seed: int, key: Column, tag: str | Column, lo, hi) -> Column:
    """Integer uniform on [lo, hi] (``lo``/``hi`` ints or columns)."""
    lo_c, hi_c = F.lit(lo) if isinstance(lo, int) else lo, F.lit(hi) if isinstance(hi, int) else hi
    return (lo_c + draw(seed, key, tag) % (hi_c - lo_c + 1).cast("long")).cast("long")


def pick(values: list[str], seed: int, key: Column, tag: str) -> Column:
    """One element of a fixed vocabulary, uniformly."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (draw(seed, key, tag) % len(values) + 1).cast("int"))
