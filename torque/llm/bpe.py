"""Byte-pair merging by last tokens.

A merge order fixes, for every prefix of a word, exactly one admissible last
token: the token ``t`` ending there such that ``t`` and the last token of the
prefix before it survive next to each other, i.e. merging their joined text
alone gives the same two tokens back. Both tokenizer operators rest on this.
"""

from __future__ import annotations


class Merges:
    """Pair merging over symbols that are slices of one string or bytes value.

    ``rank(left, right)`` gives the priority of joining two neighbouring
    symbols (lower joins first) or None; equal priorities join leftmost first.
    """

    def __init__(self, rank):
        self.rank = rank
        self._pairs: dict = {}

    def split(self, word):
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def adjacent(self, left, right) -> bool:
        """Do the two tokens stay as they are when they stand side by side?"""
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > 2_000_000:   # memo bound, not a limit on pairs
                self._pairs.clear()
            known = self._pairs[key] = self.split(left + right) == [left, right]
        return known
