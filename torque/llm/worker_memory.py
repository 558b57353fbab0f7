"""What a Python worker keeps between tasks.

Spark reuses Python workers for the tasks of later stages, so whatever a task
leaves in a module stays until the worker ends. A worker keeps one compiled
object at a time (a tokenizer with its remembered words), and operators that
need none let go of it first.
"""

from __future__ import annotations

import pyarrow as pa

_KEPT: dict = {}


def kept(key, make):
    """The worker's compiled object for ``key``, made if it holds another one."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Let go of the compiled object, and of what earlier tasks' batches left allocated."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()


class Memo(dict):
    """Values of ``make(key)``, remembered within a bound in bytes.

    Two generations: when the younger one has filled its half it becomes the
    older one, whose entries move up when they are used again and go with it
    otherwise. ``size(key, value)`` estimates the bytes of an entry.
    """

    def __init__(self, make, limit: int, size):
        super().__init__()
        self.make, self.size, self.half = make, size, limit // 2
        self.old: dict = {}
        self.held = 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        size = self.size(key, value)
        if self.held + size > self.half:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.held += size
        self[key] = value
        return value
