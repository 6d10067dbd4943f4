"""Packing documents into fixed windows by non-negative least squares.

1. Every document is tokenised where it lies and cut into full windows and one remainder.
2. The remainder lengths make a histogram (at most window - 1 bins, whatever the input).
3. Shallow combinations of one to three lengths that fill a window exactly are enumerated;
   non-negative least squares finds how often to use each so that the histogram is met.
4. The solution is rounded within the histogram; what is left is packed greedily, the largest
   length first, then the largest that fits.
5. Every piece finds its place from its rank among the pieces of its length.

Only the histogram and the plan (both bounded by the window) pass through the driver.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.bpe import END_MARK, rank_encoding
from touchline.llm.remembered import Remembered
from touchline.llm.tables import lean, mapped, slices, stored, whole

SALTS = 64
GROUP_ROWS = 1_000_000
GROUP_BYTES = 1 << 18


def latin_class(kind: str) -> str:
    """The lower-case characters of U+0000 to U+02FF whose general category begins so, for a pattern."""
    lower = {c.lower() for c in map(chr, range(0x300)) if c != "\u0130"}
    return re.escape("".join(c for c in sorted(lower) if unicodedata.category(c)[0] == kind))


class WordIds:
    """Packed ids of a text whose tokenizer drops white space.

    Words between ASCII white space are encoded on their own and remembered up to a bound; such
    a tokenizer never joins across white space. Latin words (all characters below U+0300, but
    not U+0130; their normal form is lower case) are split together and merged by rank; all
    others go through the tokenizers library.
    """

    # Fixed value: the file's pre-token pattern, for lower-case Latin words with line feeds between.
    LATIN_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^\\t-\\r \x85\xa0{0}{1}]+|\\n".format(
        latin_class("L"), latin_class("N")))
    # Below U+0300 (first byte 0xCC) all text is in normal form C, and only U+0130 has two lower-case characters.
    NOT_LATIN = re.compile(b"[\xcc-\xff]|" + "\u0130".encode())

    def __init__(self, path: str, remembered: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            self.pieces, self.id_of_rank = rank_encoding(json.load(f), r"[^\n]*\n")
        self.words = Remembered(remembered)

    def _learn(self, words: list[bytes]) -> None:
        joined = END_MARK.join(words)
        if marks := [a for a in self.added if a in joined]:
            for w in [w for w in words if any(a in w for a in marks)]:
                ids = self.tokenizer.encode(w.decode("utf-8"), add_special_tokens=False).ids
                self.words[w] = struct.pack(f"<{len(ids)}I", *ids)
            words = [w for w in words if w not in self.words]
            joined = END_MARK.join(words)
        others = []
        if self.NOT_LATIN.search(joined):
            others = [w for w in words if self.NOT_LATIN.search(w)]
            words = [w for w in words if not self.NOT_LATIN.search(w)]
            joined = END_MARK.join(words)
        if words:  # a line feed between two words is a part of its own: with its mark, two lone marks
            parts = self.LATIN_PARTS.findall(joined.decode("utf-8").lower())
            ranks = np.array(self.pieces.encode_ordinary("\n".join([*parts, ""])), np.int64)
            lone = ranks == END_MARK[0]
            ends = np.flatnonzero(lone)[::2] - 2 * np.arange(len(words) - 1)
            ranks = ranks[~lone]
            self._remember(words, self.id_of_rank[ranks], np.concatenate([[0], ends, [len(ranks)]]))
        if others:  # separated by spaces; offsets tell which word an id belongs to
            texts = [w.decode("utf-8") for w in others]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            self._remember(others, np.array(found.ids, "<u4"),
                           np.searchsorted(np.array([o[0] for o in found.offsets], np.int64), starts))

    def _remember(self, words: list[bytes], ids: np.ndarray, at: np.ndarray) -> None:
        data, at = ids.tobytes(), (4 * at).tolist()
        self.words.update(zip(words, map(data.__getitem__, map(slice, at, at[1:]))))

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        for group in grouped(texts):
            split = [text.split() for text in group]
            words = set(chain.from_iterable(split))
            self.words.make_room(len(words))
            found = dict(zip(words, map(self.words.get, words)))
            missing = [w for w, ids in found.items() if ids is None]
            if missing:
                if new := self.words.unknown(missing):
                    self._learn(list(new))
                found.update(zip(missing, map(self.words.__getitem__, missing)))
            for of_text in split:
                yield b"".join(map(found.__getitem__, of_text))


def grouped(texts: list[bytes], group_bytes: int = GROUP_BYTES) -> Iterator[list[bytes]]:
    """The texts in groups that end where they reach ``group_bytes``."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= group_bytes:
            yield group
            group, size = [], 0
    if group:
        yield group


_LOADED: dict[str, WordIds] = {}

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_documents(docs: DataFrame, path: str, window: int, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids (its end id included): full windows, then the remainder."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = WordIds(path)
        end = struct.pack("<I", end_id)
        for batch in slices(batches):
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(),
                                _LOADED[path](batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                for s in range(0, n, window):
                    part = ids[4 * s:4 * (s + window)]
                    out.append((doc, s, len(part) // 4, zlib.crc32(part), n, part))
            cols = list(zip(*out))
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in cols[5]],
                                       pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in schema.split(", ")])

    schema = PIECES + ", ids array<int>" * with_ids
    return mapped(docs.select(F.col(id_col).cast("long"), whole(text_col).cast("binary")),
                  lean(rows), schema)


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int,
                 most: int = 6000) -> list[tuple[int, ...]]:
    """Up to ``most`` multisets of one to three lengths that sum to the window, those whose
    scarcest length is most frequent first."""
    h = np.zeros(window + 1, np.int64)
    h[lengths] = counts
    found = [((a, window - a), min(h[a], h[window - a]))
             for a in range(1, window // 2 + 1) if h[a] and h[window - a]]
    for a in lengths[lengths <= window // 3]:
        b = np.arange(a, (window - a) // 2 + 1)
        c = window - a - b
        ok = (h[b] > 0) & (h[c] > 0)
        b, c = b[ok], c[ok]
        value = np.minimum(h[a], np.minimum(h[b], h[c]))
        top = np.argsort(-value, kind="stable")[:64]
        found += [((int(a), int(b[i]), int(c[i])), value[i]) for i in top]
    found.sort(key=lambda x: (-x[1], x[0]))
    return [p for p, _ in found[:most]]


def nnls(patterns: list[tuple[int, ...]], h: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that lowers |Ax - h|: multiplicative updates, which keep every x non-negative.
    A's column of a pattern counts its lengths."""
    col = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.concatenate([np.array(p) for p in patterns])
    x = np.ones(len(patterns))
    target = np.bincount(col, h[row], len(patterns))
    for _ in range(rounds):
        made = np.bincount(row, x[col], len(h))
        x *= target / np.maximum(np.bincount(col, made[row], len(patterns)), 1e-12)
    return x


def plan_windows(histogram: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one window, number of such windows); uses every piece exactly once."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan = []
    if left[window]:
        plan.append(((window,), int(left[window])))
        left[window] = 0
    lengths = np.flatnonzero(left)
    patterns = combinations(lengths, left[lengths], window) if len(lengths) else []
    if patterns:
        wanted = np.rint(nnls(patterns, left.astype(float))).astype(np.int64)
        for i in np.argsort(-wanted, kind="stable"):
            if wanted[i] <= 0:
                break
            used, times = np.unique(patterns[i], return_counts=True)
            n = min(int(wanted[i]), int((left[used] // times).min()))
            if n:
                left[used] -= n * times
                plan.append((patterns[i], n))
    present = np.flatnonzero(left).tolist()
    while present:  # every turn uses up a length: at most window - 1 turns
        filled, space, taken = [], window, {}
        at = len(present)
        while space and (at := bisect_right(present, space, 0, at)):
            length = present[at - 1]
            k = min(space // length, int(left[length]) - taken.get(length, 0))
            if k:
                filled += [length] * k
                taken[length] = taken.get(length, 0) + k
                space -= k * length
            at -= 1
        n = min(int(left[x]) // k for x, k in taken.items())
        for x, k in taken.items():
            left[x] -= n * k
        present = [x for x in present if left[x]]
        plan.append((tuple(filled), n))
    return plan


def _places(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, pieces a window, first sequence, first offset), by length and rank."""
    rows, ranks, sequence = [], {}, 0
    for lengths, n in plan:
        offset = 0
        for x in sorted(set(lengths), reverse=True):
            k = lengths.count(x)
            rows.append((x, ranks.get(x, 0), k, sequence, offset))
            ranks[x] = ranks.get(x, 0) + k * n
            offset += k * x
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False, salts: int = SALTS,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Pieces of a length are ranked in groups of about ``group_rows`` at most, and in no fewer than
    ``salts`` groups, so that a length which holds most pieces is many groups at any size.
    Null and empty texts are one piece that holds the end id only; null or repeated doc_ids
    are packed like others; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = stored(cut_documents(docs, path, window, end_id, id_col, text_col, with_ids), "pieces")
    # At most a row per length.
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    groups = {x: max(salts, -(-n // group_rows)) for x, n in histogram.items()}
    per_length = spark.createDataFrame(list(groups.items()), "length long, salts long")
    salted = (pieces.join(F.broadcast(per_length), "length")
              .select(*pieces.columns, F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"),
                                              F.col("salts")).alias("salt")))
    # At most window x salts rows, and one more for every ``group_rows`` pieces.
    counts = salted.groupBy("length", "salt").count().collect()
    base, first = np.zeros(window + 1, np.int64), np.zeros(sum(groups.values()), np.int64)
    base[list(groups)] = np.cumsum([0, *groups.values()])[:-1]
    ranked: dict[int, int] = {}
    for r in sorted(counts, key=lambda r: (r["length"], r["salt"])):
        first[base[r["length"]] + r["salt"]] = ranked.get(r["length"], 0)
        ranked[r["length"]] = ranked.get(r["length"], 0) + r["count"]
    shared = spark.sparkContext.broadcast((base, first, _places(plan_windows(histogram, window))))
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, first, places = shared.value
        key = (places[:, 0] << 44) + places[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = first[base[length] + batch.column("salt").to_numpy()] + batch.column("nth").to_numpy() - 1
            _, start, k, sequence, offset = places[np.searchsorted(key, (length << 44) + rank,
                                                                   side="right") - 1].T
            window_no, slot = np.divmod(rank - start, k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(sequence + window_no), pa.array(offset + slot * length)],
                [*names, "sequence_id", "offset"])

    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return mapped(salted.withColumn("nth", nth.cast("long")), place,
                  schema + ", sequence_id long, offset long")
