"""Substring de-duplication by level-wise doubling.

Windows are words in a row. A window of the full length can only repeat if the shorter
windows inside it do. So the first level looks at windows of a fraction of the length, picked
by content (the smallest hash of those inside a full window); only where they repeat is the
window extended to twice that length, and so on until the full length or until no
candidate survives. At the full length the words around the surviving anchors are compared as
windows: all but the earliest place of each lose their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import repeats
from touchline.llm.anchors import anchors, kgram_hashes
from touchline.llm.tables import mapped, slices, stored


def as_items(data: bytes) -> np.ndarray:
    """A 64-bit hash per word (words are separated by ASCII white space)."""
    digest = xxhash.xxh3_64_intdigest
    words = data.split()
    return np.fromiter(map(digest, words), np.uint64, len(words))


def first_places(anchor: np.ndarray, window: np.ndarray, key: np.ndarray, start: np.ndarray,
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(later, order): which of the windows come after the earliest equal one (same anchor and
    window hash, 112 bits in all), in the sorted ``order`` of all windows."""
    order = np.lexsort((start, key, window, anchor))
    a, w, k, s = anchor[order], window[order], key[order], start[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])
    head = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    return (k != k[head]) | (s != s[head]), order


class Windows:
    """Candidate windows of a task; only the earliest place of each is sent on."""

    def __init__(self, length: int, k: int, buckets: int, most: int = 1_500_000):
        self.length, self.k, self.buckets, self.most = length, k, buckets, most
        self.clear()

    def clear(self) -> None:
        self.docs, self.parts, self.size = [], [], 0

    def full(self) -> bool:
        return self.size > self.most

    def add(self, key: int, sign: int, data: bytes, among: list[int]) -> None:
        items = as_items(data)
        if len(items) < self.length:
            return
        a = anchors(items, self.length, self.k)
        at = np.flatnonzero(repeats.member(a, among))
        whole = kgram_hashes(items, self.length)
        self.parts.append((a[at], whole[at], np.full(len(at), len(self.docs)), at))
        self.docs.append((key, sign))
        self.size += len(at)

    def flush(self) -> Iterator[tuple]:
        if self.size:
            anchor, window, doc, start = map(np.concatenate, zip(*self.parts))
            docs = np.array(self.docs, np.int64).reshape(-1, 2)
            later, order = first_places(anchor, window, docs[doc, 0], start)
            anchor, window, doc, start = anchor[order], window[order], doc[order], start[order]
            for d, spans in lost(doc[later], start[later], self.length):
                yield (*self.docs[d], spans)
            anchor, window, doc, start = (x[~later] for x in (anchor, window, doc, start))
            at = np.searchsorted(repeats.by_bucket(anchor, self.buckets), np.arange(self.buckets + 1))
            for b, (i, j) in enumerate(zip(at.tolist(), at[1:].tolist())):
                if j > i:
                    yield b, packed(anchor[i:j], window[i:j], doc[i:j], start[i:j], docs)
        self.clear()


def lost(doc: np.ndarray, start: np.ndarray, length: int) -> Iterator[tuple[int, bytes]]:
    """(document number, packed word spans) that windows at these places cover."""
    if not len(doc):
        return
    o = np.lexsort((start, doc))
    doc, start = doc[o], start[o]
    gap = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length)])
    first = np.flatnonzero(gap)
    last = np.append(first[1:] - 1, len(doc) - 1)
    yield from repeats.spans_by_doc(doc[first], start[first], start[last] + length)


def packed(anchor, window, doc, start, docs) -> bytes:
    """A block: anchors (each once, with its number of windows), window hashes, places, documents."""
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    used, idx = np.unique(doc, return_inverse=True)
    head = np.array([new.sum(), len(anchor), len(used)], np.int64)
    return b"".join(x.tobytes() for x in (
        head, anchor[new], window, docs[used], np.diff(np.append(np.flatnonzero(new), len(anchor))).astype(np.uint32),
        idx.astype(np.uint32), start.astype(np.uint32)))


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, window, document number, start per window; key and sign per document)."""
    n_anchors, n, n_docs = np.frombuffer(block, np.int64, 3).tolist()
    at = 24
    out = []
    for kind, m in ((np.uint64, n_anchors), (np.uint64, n), (np.int64, 2 * n_docs),
                    (np.uint32, n_anchors), (np.uint32, n), (np.uint32, n)):
        out.append(np.frombuffer(block, kind, m, at))
        at += out[-1].nbytes
    anchor, window, docs, times, idx, start = out
    return np.repeat(anchor, times), window, idx, start, docs.reshape(-1, 2)


def search_bucket(blocks: list[bytes], length: int) -> Iterator[tuple[int, int, bytes]]:
    """(key, sign, packed spans) of the words that a bucket's windows lose."""
    parts, n = [], 0
    for b in blocks:
        anchor, window, idx, start, docs = unpacked(b)
        parts.append((anchor, window, idx.astype(np.int64) + n, start.astype(np.int64), docs))
        n += len(docs)
    anchor, window, doc, start, docs = map(np.concatenate, zip(*parts))
    later, order = first_places(anchor, window, docs[doc, 0], start)
    for d, spans in lost(doc[order][later], start[order][later], length):
        yield int(docs[d, 0]), int(docs[d, 1]), spans


def window_dedup(docs: DataFrame, length: int = 20, first_length: int = 5, id_col: str = "doc_id",
                 text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (and the kept text).

    A word goes if a window of ``length`` words that covers it also starts earlier: in a document
    with a smaller doc_id, or earlier in the same one. Levels are first_length, twice that, and so on
    up to ``length``. Null texts have no words; rows that share a doc_id count as one document;
    a row without id is a document of its own after all others, one for all rows of its text; an empty table gives no rows.
    """
    parts = repeats.even_parts(docs, repeats.buckets_of(docs, text_col))
    rows = repeats.keyed(docs, id_col, text_col)
    k, level, items = min(first_length, length), rows, as_items
    rows = repeats.zipped_rows(rows)
    while True:
        kept = repeats.shared_anchors(level, items, length, k, within=True, parts=parts)
        if 2 * k >= length:
            break
        kept = stored(kept, "level")
        if kept.isEmpty():
            break
        level = rows.join(kept, ["key", "tag"]).withColumn("k", F.lit(k))
        k, items = 2 * k, lambda data: as_items(repeats.unzipped(data))
    searched = repeats.search_windows(rows, kept, lambda: Windows(length, k, len(parts)),
                                      lambda blocks: search_bucket(blocks, length), parts)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc_id, data, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "data", "spans"))):
                words = repeats.unzipped(data).split()
                s, e = repeats.unpack_spans([spans] if spans else None)
                left = []
                for i, j in zip([0, *e.tolist()], [*s.tolist(), len(words)]):
                    left += words[i:j]
                text = b" ".join(left)
                out.append((doc_id, len(words), len(words) - len(left),
                            hashlib.sha256(text).hexdigest()))
                if with_text:
                    out[-1] += (text.decode("utf-8", "replace"),)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names[:len(cols)])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return mapped(repeats.with_spans(rows, searched), finish, schema)
