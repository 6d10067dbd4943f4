"""A bounded memo of word encodings, kept by a Python worker between batches."""

from __future__ import annotations

from collections.abc import Iterable


class Remembered(dict):
    """Two generations: when the young one is full it becomes the old one, and entries of the
    old one that are used again move back. Holds at most about twice ``bound`` entries."""

    def __init__(self, bound: int):
        self.bound, self.old = bound, {}

    def __missing__(self, key):
        value = self[key] = self.old[key]
        return value

    def make_room(self, n: int) -> None:
        """Before up to ``n`` entries are used: start a new generation if they may not fit."""
        if len(self) and len(self) + n > max(self.bound, n):
            self.old = dict(self)
            self.clear()

    def unknown(self, keys: Iterable) -> set:
        return {k for k in set(keys) if k not in self and k not in self.old}
