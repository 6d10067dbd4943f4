"""External induced suffix sorting with common-prefix values.

The suffixes of a string are S (smaller than the next suffix) or L. Sorted leftmost S suffixes
(LMS) induce the sorted L suffixes in one ascending sweep over the symbols, and these induce the
S suffixes in one descending sweep: a suffix at p that is taken from the queue puts the
suffix at p - 1 into the queue of its first symbol. Every queue entry is a tuple (symbol,
position, common prefix with the entry before it of the same symbol); the common prefix of
an induced suffix is one more than the smallest common prefix between the two suffixes that
induced it and its predecessor. Tuples of one symbol that are ready are taken together, as arrays.

Queues, sweeps' results and the string itself go to files once they are over the memory
bound. LMS suffixes are sorted by naming the LMS substrings (one induced sort) and sorting
the shorter string of names, recursively while it is over the bound, else by prefix doubling.

The scratch files belong to one task and are removed with it; no other task reads them.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np


class Scratch:
    """Arrays in memory while small, else in files of a private folder."""

    def __init__(self, memory_bytes: int):
        self.memory_bytes, self.folder, self.names = memory_bytes, None, count()

    def __enter__(self):
        self.folder = tempfile.TemporaryDirectory(prefix="induced-")
        return self

    def __exit__(self, *failure):
        self.folder.cleanup()

    def path(self) -> str:
        return f"{self.folder.name}/{next(self.names)}"

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.memory_bytes // 4:
            return np.empty(n, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(n,))


class Column:
    """Values that are appended: in memory while few, else in a file that is mapped when read."""

    def __init__(self, scratch: Scratch, dtype):
        self.scratch, self.dtype, self.parts, self.bytes, self.file = scratch, dtype, [], 0, None

    def add(self, values: np.ndarray) -> None:
        self.parts.append(values.astype(self.dtype))
        self.bytes += self.parts[-1].nbytes
        if self.bytes > self.scratch.memory_bytes // 8:
            if self.file is None:
                self.file = open(self.scratch.path(), "wb")
            for p in self.parts:
                p.tofile(self.file)
            self.parts, self.bytes = [], 0

    def array(self) -> np.ndarray:
        if self.file is None:
            return np.concatenate([np.zeros(0, self.dtype), *self.parts])
        for p in self.parts:
            p.tofile(self.file)
        self.file.close()
        return np.memmap(self.file.name, self.dtype, "r")


class SymbolQueue:
    """Disk-backed priority queue: tuples (symbol, position, common prefix), taken by symbol
    and, of one symbol, in the order they came. Symbols share a bucket of 2**shift symbols."""

    def __init__(self, scratch: Scratch, symbols: int, with_lcp: bool):
        self.scratch, self.with_lcp = scratch, with_lcp
        self.shift = max(0, int(symbols - 1).bit_length() - 9)
        self.buckets: dict[int, list[tuple]] = {}
        self.files: dict[int, list[tuple]] = {}
        self.bytes = 0
        self.open = None  # the bucket being taken, and its symbols
        self.ready: dict[int, list[tuple]] = {}

    def put(self, sym: np.ndarray, pos: np.ndarray, lcp: np.ndarray | None) -> None:
        """Tuples sorted by symbol."""
        if not len(sym):
            return
        at = np.concatenate([[0], np.flatnonzero(np.diff(sym >> self.shift)) + 1, [len(sym)]])
        for i, j in zip(at.tolist(), at[1:].tolist()):
            b = int(sym[i]) >> self.shift
            part = (sym[i:j], pos[i:j], None if lcp is None else lcp[i:j])
            if b == self.open:
                self._sort_in(part)
            else:
                self.buckets.setdefault(b, []).append(part)
                self.bytes += (j - i) * (sym.itemsize + pos.itemsize + 1)
        if self.bytes > self.scratch.memory_bytes // 4:
            self._spill()

    def _spill(self) -> None:
        for b, parts in self.buckets.items():
            name = self.scratch.path()
            columns = [np.concatenate(c) for c in zip(*parts)] if self.with_lcp else [
                np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])]
            with open(name, "wb") as f:
                for c in columns:
                    np.save(f, c)
            self.files.setdefault(b, []).append(name)
        self.buckets, self.bytes = {}, 0

    def _sort_in(self, part: tuple) -> None:
        sym = part[0]
        at = np.concatenate([[0], np.flatnonzero(np.diff(sym)) + 1, [len(sym)]])
        for i, j in zip(at.tolist(), at[1:].tolist()):
            self.ready.setdefault(int(sym[i]), []).append(
                (part[1][i:j], None if part[2] is None else part[2][i:j]))

    def _load(self, bucket: int) -> None:
        self.open, self.ready = bucket, {}
        for name in self.files.pop(bucket, ()):
            with open(name, "rb") as f:
                sym, pos = np.load(f), np.load(f)
                self._sorted_in(sym, pos, np.load(f) if self.with_lcp else None)
        for sym, pos, lcp in self.buckets.pop(bucket, ()):
            self.bytes -= len(sym) * (sym.itemsize + pos.itemsize + 1)
            self._sort_in((sym, pos, lcp))

    def _sorted_in(self, sym, pos, lcp) -> None:
        o = np.argsort(sym, kind="stable")
        self._sort_in((sym[o], pos[o], None if lcp is None else lcp[o]))

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray | None] | None:
        """All ready tuples of a symbol; buckets are opened in sweep order."""
        if symbol >> self.shift != self.open:
            self._load(symbol >> self.shift)
        parts = self.ready.pop(symbol, None)
        if not parts:
            return None
        if len(parts) == 1:
            return parts[0]
        return (np.concatenate([p[0] for p in parts]),
                np.concatenate([p[1] for p in parts]) if self.with_lcp else None)


class Sorter:
    """Sorts one string; ``cap`` bounds the common-prefix values (at most 255)."""

    def __init__(self, text: np.ndarray, scratch: Scratch, cap: int = 255):
        self.text, self.scratch, self.cap, self.n = text, scratch, cap, len(text)
        self.symbols = int(text.max()) + 1 if self.n else 0
        self.is_s = self._types()
        self.pos_type = np.int32 if self.n < 2**31 - 1 else np.int64

    def _types(self, chunk: int = 1 << 22) -> np.ndarray:
        """True where a suffix is S: from the right, an equal symbol takes its neighbour's type."""
        out, x, n = self.scratch.array(self.n, bool), self.text, self.n
        after = False
        for hi in range(n, 0, -chunk):
            lo = max(0, hi - chunk)
            a = np.asarray(x[lo:hi])
            b = np.append(a[1:], x[hi] if hi < n else 0)
            less, same = a < b, a == b
            if hi == n:
                less[-1] = same[-1] = False
            decided = np.where(same, len(a), np.arange(len(a)))
            next_at = np.minimum.accumulate(decided[::-1])[::-1]
            out[lo:hi] = np.append(less, after)[next_at]
            after = bool(out[lo])
        return out

    def lms(self) -> np.ndarray:
        """LMS positions in text order."""
        s = self.is_s
        return (np.flatnonzero(s[1:] & ~s[:-1]) + 1).astype(self.pos_type)

    def common(self, p: int, q: int) -> int:
        m = min(self.cap, self.n - max(p, q))
        differ = self.text[p:p + m] != self.text[q:q + m]
        return int(np.argmax(differ)) if differ.any() else m

    def adjacent_common(self, pos: np.ndarray) -> np.ndarray:
        """Common prefix of every position with the one before it in ``pos``, up to ``cap``."""
        out = np.zeros(len(pos), np.uint8)
        alive = np.arange(1, len(pos))
        for k in range(self.cap):
            p, q = pos[alive] + k, pos[alive - 1] + k
            inside = np.maximum(p, q) < self.n
            alive, p, q = (alive, p, q) if inside.all() else (alive[inside], p[inside], q[inside])
            alive = alive[self.text[p] == self.text[q]]
            if not len(alive):
                break
            out[alive] += 1
        return out

    def sweep(self, seeds: np.ndarray, seed_lcp: np.ndarray | None,
              emit: Callable[[np.ndarray, np.ndarray | None], None]) -> None:
        """Induce from LMS seeds (sorted by symbol at least). ``emit`` gets all suffixes in
        descending order, with the common prefix of each with the suffix emitted before."""
        lcps = seed_lcp is not None
        x, cap, n = self.text, self.cap, self.n
        first = np.searchsorted(x[seeds], np.arange(self.symbols + 1)) if self.symbols <= 1 << 20 else None
        queue = SymbolQueue(self.scratch, self.symbols, lcps)
        low = np.full(self.symbols if lcps else 0, cap, np.uint8)
        seen = np.zeros(self.symbols if lcps else 0, bool)

        def induce(pos, lcp, keep: Callable) -> None:
            """Put the suffixes before ``pos`` that ``keep`` allows into the queue."""
            inner = pos > 0
            before = x[np.where(inner, pos - 1, 0)]
            src = np.flatnonzero(inner & keep(before, x[pos]))
            sym = before[src]
            o = np.argsort(sym, kind="stable")
            src, sym = src[o], sym[o]
            if not lcps:
                queue.put(sym, pos[src] - 1, None)
                return
            if not len(src):
                np.minimum(low, lcp.min(), out=low)
                return
            # Smallest common prefix since the symbol's last entry (of this or an earlier call).
            ext = np.append(lcp, cap).astype(np.uint8)
            new = np.concatenate([[True], sym[1:] != sym[:-1]])
            since = np.concatenate([[0], src[:-1] + 1])
            since[new] = 0
            pairs = np.stack([since, src + 1], axis=1).ravel()
            least = np.minimum.reduceat(ext, pairs)[::2]
            least[new] = np.minimum(least[new], low[sym[new]])
            value = np.minimum(least.astype(np.int16) + 1, cap).astype(np.uint8)
            value[new & ~seen[sym]] = 0
            queue.put(sym, pos[src] - 1, value)
            np.minimum(low, lcp.min(), out=low)
            last = np.append(new[1:], True)
            tail = np.minimum.accumulate(ext[::-1])[::-1]
            low[sym[last]] = tail[src[last] + 1]
            seen[sym] = True

        # Ascending: L suffixes. The suffix after the end is smaller than all others.
        larger = Stack(self.scratch, lcps)
        queue.put(x[n - 1:n], np.array([n - 1], self.pos_type), np.zeros(1, np.uint8) if lcps else None)
        if lcps:
            seen[x[n - 1]] = True
        present = self._present()
        seeds_at = 0
        for c in present:
            end = None
            while (got := queue.take(c)) is not None:
                pos, lcp = got
                larger.add(c, pos, lcp)
                end = int(pos[-1])
                induce(pos, lcp, np.greater_equal)
            if first is not None:
                i, j = int(first[c]), int(first[c + 1])
            else:
                i = seeds_at
                j = seeds_at = i + int(np.searchsorted(x[seeds[i:]], c, side="right"))
            if j > i:
                lcp = None
                if lcps:
                    lcp = np.array(seed_lcp[i:j])
                    lcp[0] = 0 if end is None else self.common(end, int(seeds[i]))
                induce(np.asarray(seeds[i:j]), lcp, np.greater)
        # Descending: S suffixes, then the L suffixes of the same symbol.
        queue = SymbolQueue(self.scratch, self.symbols, lcps)
        low[:], seen[:] = cap, False
        for c in reversed(present):
            end = None
            while (got := queue.take(c)) is not None:
                pos, lcp = got
                end = int(pos[-1])
                emit(pos, lcp)
                induce(pos, lcp, np.less_equal)
            carried = None
            for pos, lcp in larger.pop(c):
                if lcps:  # shift: an L suffix now follows the larger one
                    start = (0 if end is None else self.common(end, int(pos[-1]))) if carried is None else carried
                    carried = int(lcp[0])
                    lcp = np.concatenate([[start], lcp[:0:-1]]).astype(np.uint8)
                pos = pos[::-1]
                emit(pos, lcp)
                induce(pos, lcp, np.less)

    def _present(self) -> list[int]:
        if self.symbols <= 1 << 16:
            return np.flatnonzero(np.bincount(self.text, minlength=self.symbols)).tolist()
        return np.unique(self.text).tolist()

    def sorted_lms(self) -> np.ndarray:
        """LMS positions in the order of their suffixes."""
        lms = self.lms()
        if len(lms) < 2:
            return lms
        marked = self.scratch.array(self.n, bool)
        marked[:] = False
        marked[lms] = True
        by_symbol = lms[np.argsort(self.text[lms], kind="stable")]
        found = []

        def collect(pos, _):
            found.append(pos[marked[pos]])

        self.sweep(by_symbol, None, collect)
        order = np.concatenate(found)[::-1]
        # Name LMS substrings: up to and including the next LMS position.
        slot = np.searchsorted(lms, order)
        ends = np.append(lms[1:], self.n - 1).astype(np.int64) + 1
        length = ends[slot] - order
        same = np.concatenate([[False], length[1:] == length[:-1]])
        same[1:] &= (slot[1:] < len(lms) - 1) & (slot[:-1] < len(lms) - 1)
        alive, k = np.flatnonzero(same), 0
        while len(alive):
            differ = self.text[order[alive] + k] != self.text[order[alive - 1] + k]
            same[alive[differ]] = False
            k += 1
            alive = alive[~differ & (length[alive] > k)]
        name = np.cumsum(~same) - 1
        if name[-1] + 1 == len(lms):
            return order
        names = self.scratch.array(len(lms), np.int32 if len(lms) < 2**31 - 1 else np.int64)
        names[slot] = name
        if len(lms) * 40 <= self.scratch.memory_bytes:
            return lms[prefix_doubling(np.asarray(names))]
        inner = []
        shorter = Sorter(names, self.scratch)
        shorter.sweep(shorter.sorted_lms(), None, lambda pos, _: inner.append(np.array(pos)))
        return lms[np.concatenate(inner)[::-1]]

    def run(self, emit: Callable[[np.ndarray, np.ndarray], None]) -> None:
        """All suffixes in descending order with common prefixes (see ``sweep``)."""
        if self.n:
            seeds = self.sorted_lms()
            self.sweep(seeds, self.adjacent_common(seeds), emit)


class Stack:
    """Results of the ascending sweep, read back symbol by symbol from the largest."""

    def __init__(self, scratch: Scratch, with_lcp: bool):
        self.scratch, self.with_lcp, self.parts, self.bytes = scratch, with_lcp, {}, 0

    def add(self, symbol: int, pos: np.ndarray, lcp: np.ndarray | None) -> None:
        self.parts.setdefault(symbol, []).append((pos, lcp))
        self.bytes += pos.nbytes + len(pos)
        if self.bytes > self.scratch.memory_bytes // 4:
            for s, parts in self.parts.items():
                self.parts[s] = [self._saved(*p) if isinstance(p, tuple) else p for p in parts]
            self.bytes = 0

    def _saved(self, pos, lcp) -> str:
        name = self.scratch.path()
        with open(name, "wb") as f:
            np.save(f, pos)
            if self.with_lcp:
                np.save(f, lcp)
        return name

    def pop(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        for p in reversed(self.parts.pop(symbol, [])):
            if isinstance(p, str):
                with open(p, "rb") as f:
                    p = np.load(f), np.load(f) if self.with_lcp else None
            yield p


def prefix_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string of integers, in memory; only tied groups are sorted again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    new = np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])
    slots = np.arange(n)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    tied = ~(new & np.append(new[1:], True))
    at, h = slots[tied], 1
    while len(at):
        u = order[at]
        first, second = rank[u], rank[np.minimum(u + h, n)]
        o = np.argsort(first * (n + 1) + second + 1, kind="stable")
        u, first, second = u[o], first[o], second[o]
        order[at] = u
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        rank[u] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        at = at[~(new & np.append(new[1:], True))]
        h *= 2
    return order
