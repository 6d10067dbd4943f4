"""Suffix-array de-duplication: removes byte strings that an earlier document holds.

Windows whose anchor occurs in one document only cannot repeat; the text around the others
is cut into fragments of windows with one and the same anchor, so equal windows meet in one
shard. Every shard joins its fragments to one string, and the external induced sorter gives its suffixes in
order with common-prefix values (``induced``). Neighbours that share at least ``length``
bytes form a group; its smallest document keeps the string, the others lose it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from touchline.llm import repeats
from touchline.llm.anchors import anchors
from touchline.llm.induced import Column, Scratch, Sorter
from touchline.llm.tables import lean, mapped, slices

ANCHOR_BYTES = 20


def as_items(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


class Fragments:
    """Distinct fragments of a task; only the smallest document's places of each are sent on."""

    def __init__(self, length: int, k: int, buckets: int, most_bytes: int = 24 << 20):
        self.length, self.k, self.buckets, self.most = length, k, buckets, most_bytes
        self.clear()

    def clear(self) -> None:
        self.docs, self.first, self.bytes = [], {}, 0
        self.done = []  # (document, start, end) settled here

    def full(self) -> bool:
        return self.bytes + 24 * len(self.done) > self.most

    def add(self, key: int, sign: int, data: bytes, among: list[int]) -> None:
        items = as_items(data)
        if len(items) < self.length:
            return
        a = anchors(items, self.length, self.k)
        s, e = repeats.anchor_runs(a, among)
        n, first, docs = len(self.docs), self.first, self.docs
        docs.append((key, sign))
        for b, i, j in zip(a[s].tolist(), s.tolist(), (e + self.length - 1).tolist()):
            f = data[i:j]
            held = first.get(f)
            if held is None:
                first[f] = [b, key, (n, i)]
                self.bytes += j - i + 150
            elif held[1] < key:  # an equal fragment lies in a smaller document
                self.done.append((n, i, j))
            elif held[1] == key:
                held.append((n, i))
            else:
                self.done += [(d, at, at + j - i) for d, at in held[2:]]
                first[f] = [b, key, (n, i)]

    def flush(self) -> Iterator[tuple]:
        if self.done:
            doc, s, e = np.array(self.done, np.int64).T
            for d, spans in repeats.spans_by_doc(doc, s, e):
                yield (*self.docs[d], spans)
        # By anchor and text: alike fragments lie together, and the block packs well.
        rows = sorted((anchor, f, d, at) for f, (anchor, _, *places) in self.first.items() for d, at in places)
        anchor = np.array([r[0] for r in rows], np.uint64)
        cut = np.searchsorted(repeats.by_bucket(anchor, self.buckets), np.arange(self.buckets + 1))
        for b, (i, j) in enumerate(zip(cut.tolist(), cut[1:].tolist())):
            if i == j:
                continue
            _, texts, doc, at = zip(*rows[i:j])
            used, idx = np.unique(np.array(doc), return_inverse=True)
            ids = np.array([self.docs[d] for d in used], np.int64)
            head = np.array([len(texts), len(used)], np.int64)
            yield b, b"".join((head.tobytes(), ids.tobytes(), anchor[i:j].tobytes(),
                               idx.astype(np.uint32).tobytes(),
                               np.array(at, np.uint32).tobytes(),
                               np.array([len(t) for t in texts], np.uint32).tobytes(), *texts))
        self.clear()


def unpacked(block: bytes) -> tuple[np.ndarray, ...]:
    """(key and sign per document; anchor, document, start and size per fragment; text)."""
    n, d = np.frombuffer(block, np.int64, 2).tolist()
    ids = np.frombuffer(block, np.int64, 2 * d, 16).reshape(-1, 2)
    at = 16 + 16 * d
    anchor = np.frombuffer(block, np.uint64, n, at)
    at += 8 * n
    idx, start, size = (np.frombuffer(block, np.uint32, n, at + 4 * n * i) for i in range(3))
    return ids, anchor, idx, start, size, np.frombuffer(block, np.uint8, offset=at + 12 * n)


def repeated_windows(text: np.ndarray, at: np.ndarray, size: np.ndarray, owner: np.ndarray, length: int,
                     memory_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, start, end) of the runs of windows whose string a piece of a smaller owner holds;
    pieces are ``size`` bytes of ``text`` from ``at``."""
    first = np.concatenate([[0], np.cumsum(size + 1)])
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    with Scratch(memory_bytes) as scratch:
        x = scratch.array(int(first[-1]), np.uint16)
        for i, j in steps(size):  # symbol 0 ends a piece
            x[first[i]:first[j]] = joined(text, at[i:j], size[i:j])
        taken = scratch.array(len(x), bool)
        taken[:] = False
        waiting: list[np.ndarray] = []

        def settle() -> None:
            """A group is complete: all but the smallest owner's windows are taken."""
            if sum(map(len, waiting)) > 1:
                p = np.concatenate(waiting)
                who = owner[np.searchsorted(first, p, side="right") - 1]
                taken[p[who > who.min()]] = True

        def emit(pos: np.ndarray, lcp: np.ndarray) -> None:
            nonlocal waiting
            joins = lcp >= length
            at = np.flatnonzero(~joins)
            if not len(at):
                waiting.append(np.array(pos))
                return
            waiting.append(np.array(pos[:at[0]]))
            settle()
            if len(at) > 1:  # groups that lie inside this batch
                inner = pos[at[0]:at[-1]]
                group = np.cumsum(~joins[at[0]:at[-1]]) - 1
                big = np.bincount(group)[group] > 1
                inner, group = inner[big], group[big]
                if len(inner):
                    who = owner[np.searchsorted(first, inner, side="right") - 1]
                    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                    low = np.minimum.reduceat(who, starts)
                    low = np.repeat(low, np.diff(np.append(starts, len(group))))
                    taken[inner[who > low]] = True
            waiting = [np.array(pos[at[-1]:])]

        Sorter(x, scratch, length).run(emit)
        settle()
        found = [(np.zeros(0, np.int64),) * 3]
        for i, j in steps(size):
            p = np.flatnonzero(taken[first[i]:first[j]]) + first[i]
            piece = np.searchsorted(first, p, side="right") - 1
            p = p - first[piece]
            inside = p + length <= size[piece]
            found.append(runs_of(piece[inside], p[inside]))
        return tuple(map(np.concatenate, zip(*found)))


def steps(size: np.ndarray, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(first, end) of pieces that follow each other, of about ``most_bytes`` (one piece at least)."""
    ends, i = np.cumsum(size + 1), 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most_bytes, side="right")))
        yield i, j
        i = j


def joined(text: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces' bytes + 1, a 0 after each."""
    ends = np.cumsum(size + 1)
    out = np.zeros(int(ends[-1]), np.uint16)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    place = np.arange(len(out)) + np.repeat(at - (ends - size - 1), size + 1)
    out[inside] = text[place[inside]].astype(np.uint16) + 1
    return out


def runs_of(piece: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start, end) of the runs of consecutive places."""
    new = np.concatenate([[True], (piece[1:] != piece[:-1]) | (p[1:] != p[:-1] + 1)])[:len(p)]
    s = np.flatnonzero(new)
    return piece[s], p[s], p[np.append(s[1:], len(p))[:len(s)] - 1] + 1


def cut_pieces(text: np.ndarray, at: np.ndarray, size: np.ndarray, length: int, k: int,
               part: int, parts: int) -> tuple[np.ndarray, ...]:
    """(parent, start, size, anchor) of the runs of windows with one anchor of ``k`` bytes that fall to
    this part of ``parts``."""
    out = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)]
    for i, j in steps(size):
        n = size[i:j]
        x = joined(text, at[i:j], n)
        first = np.concatenate([[0], np.cumsum(n + 1)])
        a = anchors(x, length, k)
        p = np.flatnonzero(repeats.by_bucket(a, parts) == part)
        piece = np.searchsorted(first, p, side="right") - 1
        inside = p - first[piece] + length <= n[piece]
        p, piece = p[inside], piece[inside]
        if len(p):
            new = np.concatenate([[True], (piece[1:] != piece[:-1]) | (p[1:] != p[:-1] + 1) | (a[p[1:]] != a[p[:-1]])])
            s = np.flatnonzero(new)
            last = p[np.append(s[1:], len(p)) - 1]
            out.append((piece[s] + i, p[s] - first[piece[s]], last - p[s] + length, a[p[s]]))
    return tuple(map(np.concatenate, zip(*out)))


def lost_windows(text: np.ndarray, at: np.ndarray, size: np.ndarray, key: np.ndarray, anchor: np.ndarray,
                 length: int, k: int, memory_bytes: int, most_bytes: int,
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fragment, start, end) of the runs of windows that a fragment of a smaller key holds.

    Fragments are ``size`` bytes of ``text`` from ``at``. More than ``most_bytes`` of them are cut further,
    by anchors of more bytes, and sorted part by part: equal windows have equal anchors whatever
    their size, and at ``length`` bytes an anchor is its window's, so that a hot string cannot fill a part.
    """
    none = (np.zeros(0, np.int64),) * 3
    if not len(at):
        return none
    view = memoryview(text)
    hashes = np.empty((len(at), 2), np.uint64)
    for i in range(0, len(at), 1 << 14):
        hashes[i:i + (1 << 14)] = np.frombuffer(b"".join(
            xxhash.xxh3_128_digest(view[a:a + n]) for a, n in zip(at[i:i + (1 << 14)].tolist(),
                                                                  size[i:i + (1 << 14)].tolist())),
            np.uint64).reshape(-1, 2)
    # Equal fragments are one string of the smallest document.
    o = np.lexsort((key, hashes[:, 1], hashes[:, 0]))
    h = hashes[o]
    new = np.concatenate([[True], (h[1:] != h[:-1]).any(axis=1)])
    which = np.empty(len(o), np.int64)
    which[o] = np.cumsum(new) - 1
    one = o[new]
    del hashes, h, o, new
    lowest = key[one]
    # A fragment with an anchor that no other text has cannot share a string with another one:
    # only the others are sorted.
    _, group, n = np.unique(anchor[one], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(n[group] > 1)
    its_at, its_size, its_key = at[one[mixed]], size[one[mixed]], lowest[mixed]
    total = int(its_size.sum())
    found = [none]
    if total <= most_bytes or k >= length:
        found.append(repeated_windows(text, its_at, its_size, its_key, length, memory_bytes))
    else:
        longer, parts = (k + length + 1) // 2, 4 * -(-total // most_bytes)
        for part in range(parts):
            parent, off, n, a = cut_pieces(text, its_at, its_size, length, longer, part, parts)
            again = n - length  # at full length, a piece is one window that follows itself
            if longer == length:
                n = np.full(len(n), length)
            f, s, e = lost_windows(text, its_at[parent] + off, n, its_key[parent], a, length, longer,
                                   memory_bytes, most_bytes)
            if longer == length:
                e = e + again[f]
            found.append((parent[f], off[f] + s, off[f] + e))
    piece, s, e = map(np.concatenate, zip(*found))
    piece = mixed[piece]
    by = np.argsort(piece, kind="stable")
    piece, s, e = piece[by], s[by], e[by]
    # Every place of a string in its smallest document loses the same windows, later ones lose all.
    later = key > lowest[which]
    first = np.flatnonzero(~later)
    i, j = (np.searchsorted(piece, which[first], side=x) for x in ("left", "right"))
    times = j - i
    run = np.arange(times.sum()) + np.repeat(i - np.cumsum(times) + times, times)
    later = np.flatnonzero(later)
    return (np.concatenate([later, np.repeat(first, times)]),
            np.concatenate([np.zeros(len(later), np.int64), s[run]]),
            np.concatenate([size[later] - length + 1, e[run]]))


def search_shard(blocks: Iterable[bytes], length: int, k: int, memory_bytes: int,
                 most_bytes: int) -> Iterator[tuple[int, int, bytes]]:
    """(key, sign, packed spans) of the byte ranges that a shard's fragments lose."""
    with Scratch(memory_bytes) as scratch:
        kinds = (np.int64, np.uint64, np.int64, np.int64, np.int64, np.uint8)
        columns, n_docs = [Column(scratch, x) for x in kinds], 0
        for b in blocks:
            ids, anchor, doc, *others = unpacked(b)
            for column, x in zip(columns, (ids.ravel(), anchor, doc.astype(np.int64) + n_docs, *others)):
                column.add(x)
            n_docs += len(ids)
        ids, anchor, doc, start, size, text = (c.array() for c in columns)
        ids = ids.reshape(-1, 2)
        f, s, e = lost_windows(text, np.cumsum(size) - size, size, ids[doc, 0], anchor, length, k,
                               memory_bytes, most_bytes)
        for d, spans in repeats.spans_by_doc(doc[f], start[f] + s, start[f] + e + length - 1):
            yield int(ids[d, 0]), int(ids[d, 1]), spans


def searched_rows(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  rest: SparkColumn | None = None, memory_bytes: int = 96 << 20, shards_per_task: int = 16,
                  shard_bytes: int = 16 << 20) -> DataFrame:
    """Every row (doc_id, key, sign, tag, data compressed, ``rest`` if given) with the spans it loses."""
    parts = repeats.even_parts(docs, repeats.buckets_of(docs, text_col))
    k = min(ANCHOR_BYTES, length)
    kept = repeats.shared_anchors(repeats.keyed(docs, id_col, text_col), as_items, length, k, within=False,
                                  parts=parts)
    rows = repeats.zipped_rows(repeats.keyed(docs, id_col, text_col, rest))
    searched = repeats.search_windows(
        rows, kept, lambda: Fragments(length, k, len(parts) * shards_per_task),
        lambda blocks: search_shard(blocks, length, k, memory_bytes, shard_bytes), parts, memory_bytes)
    return repeats.with_spans(rows, searched)


def cut(data: bytes, spans: bytes | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(starts, ends, what stays, piece by piece) of a compressed text and its packed spans."""
    data = repeats.unzipped(data)
    s, e = repeats.unpack_spans([spans] if spans else None)
    cuts = [0, *np.stack([s, e], axis=1).ravel().tolist(), len(data)]
    return s, e, [data[i:j] for i, j in zip(cuts[::2], cuts[1::2])]


def as_text(pieces: list[bytes]) -> str:
    """The text of the pieces without characters that a cut halves: bytes on both sides of a cut make none."""
    return "".join(x.decode("utf-8", "ignore") for x in pieces)


def suffix_dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                 with_text: bool = True, **options) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, ``with_text``, sign (xxhash64 of
    the text), kept (bytes), kept_text (without characters that a cut halves) and spans.

    A byte goes if a ``length``-byte string that covers it also starts in a document with a smaller
    doc_id. Null texts are empty; rows of one doc_id count as one document and take nothing from
    each other; a row without id is a document of its own after all others, one for all rows of its
    text; an empty table gives no rows. Of the options, ``memory_bytes``
    bounds the sorter's arrays in memory: beyond it they go to files. ``shards_per_task`` shards
    are sorted one after the other by each task (a task for every 64 MB of text, at least the session's
    shuffle partitions). Of a shard, ``shard_bytes`` of text at most are sorted at a time: more is split by
    longer anchors.
    """
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc_id, sign, data, spans in zip(*(batch.column(c).to_pylist()
                                                   for c in ("doc_id", "sign", "data", "spans"))):
                s, e, pieces = cut(data, spans)
                left = b"".join(pieces)
                removed = int((e - s).sum())
                out.append((doc_id, len(left) + removed, removed, len(s), hashlib.sha256(left).hexdigest()))
                if with_text:
                    out[-1] += (sign, left, as_text(pieces),
                                [{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())])
            cols = list(zip(*out))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.binary(), pa.string(),
                                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                     "sign", "kept", "kept_text", "spans"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], names[:len(cols)])

    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
              + ", sign long, kept binary, kept_text string, spans array<struct<start:long,end:long>>"
              * with_text)
    return mapped(searched_rows(docs, length, id_col, text_col, **options), finish, schema)


def without_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id",
                    text_col: str = "text", size_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` with repeated strings taken out of the text, all rows and columns kept (a document that
    is repeated as a whole has the empty text); ``size_col``, if there is one, follows the text.

    The other columns travel as one struct beside the compressed text, so that the texts are
    shuffled once. A null text stays null.
    """
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(F.col(text_col).isNull().alias("absent"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)])
    rows = searched_rows(docs, length, id_col, text_col, rest, **options)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [as_text(cut(data, spans)[2])
                   for data, spans in zip(batch.column("data").to_pylist(), batch.column("spans").to_pylist())]
            changed = pa.compute.is_valid(batch.column("spans"))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), changed, batch.column("rest")],
                                             ["text", "changed", "rest"])

    found = mapped(rows, lean(finish), StructType([
        StructField("text", StringType()), StructField("changed", BooleanType()), rows.schema["rest"]]))
    held = F.col("rest")
    new = {c: held.getField(f"c{i}") for i, c in enumerate(others)}
    new[text_col] = F.when(~held.getField("absent"), F.col("text"))
    if size_col in new:
        new[size_col] = F.when(F.col("changed"), F.char_length("text").cast(docs.schema[size_col].dataType)
                               ).otherwise(new[size_col])
    return found.select(*[new[c].alias(c) for c in docs.columns])
