"""Content-defined anchors: which windows of a sequence can occur elsewhere.

The anchor of a window is the smallest hash among its k-grams. Equal windows have equal
anchors, so a window whose anchor occurs nowhere else occurs nowhere else: looking at
anchors (a few per window length) loses no repeated window.
"""

from __future__ import annotations

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def kgram_hashes(items: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive items (any integers); empty if there are fewer."""
    n = len(items) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, part, length = _MULTIPLIER, mixed((items.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER), 1
        out, done = None, 0
        while True:  # k in binary: hashes of 1, 2, 4, ... items, joined
            if k & length:
                piece = part[done:done + n]
                out = piece.copy() if out is None else out * power + piece
                done += length
            if 2 * length > k:
                return mixed(out)
            part = part[:len(part) - length] * power + part[length:]
            power, length = power * power, 2 * length


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Smallest of every w consecutive hashes."""
    if len(h) < w:
        return h[:0]
    length, part = 1, h
    while 2 * length <= w:
        part = np.minimum(part[:-length], part[length:])
        length *= 2
    return np.minimum(part[:len(part) - (w - length)], part[w - length:]) if w > length else part


ANCHOR_BITS = np.uint64(0xFFFFFFFFFFFF0000)  # anchors are compared by their upper 48 bits


def spread(h: np.ndarray) -> np.ndarray:
    """Times an odd constant: one to one on the upper 48 bits. Smallest hashes crowd at the low end;
    their products fill the whole range evenly."""
    return h * _MULTIPLIER


def anchors(items: np.ndarray, window: int, k: int) -> np.ndarray:
    """The anchor of every window, spread evenly. Anchors that differ may share 48 bits: a few
    more windows are then looked at, none less."""
    return spread(window_minima(kgram_hashes(items, k) & ANCHOR_BITS, window - k + 1))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint maximal spans that cover these spans."""
    if not len(starts):
        return starts, ends
    o = np.argsort(starts, kind="stable")
    s, e = starts[o], np.maximum.accumulate(ends[o])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])]
