"""Finding repeated windows of documents in two rounds, shared by two de-duplication operators.

Round 1 (``shared_anchors``) sends the anchor hashes of every document to hash buckets and
keeps those that occur in more than one place: the only windows that can repeat are those
whose anchor is kept. Round 2 (``search_windows``) sends what lies
around kept anchors. Values that repeat inside one task are settled there and sent once,
so a passage that a third of all documents hold arrives once per task, not once per document.

Rows travel packed (one row per task and bucket), and spans are returned per document.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.anchors import ANCHOR_BITS, anchors, kgram_hashes, merged, spread
from touchline.llm.tables import mapped, slices, whole

MANY = np.uint32(0xFFFFFFFF)
NAMELESS = 1 << 62  # keys of rows without id begin here

PACKED = "bucket long, many boolean, docs binary, tags binary, at binary, anchors binary"


def keyed(docs: DataFrame, id_col: str, text_col: str, rest: Column | None = None) -> DataFrame:
    """doc_id, key (orders documents), sign (tells texts of one id apart), tag (16 bits of it), the
    text's bytes and, if given, ``rest``.

    A row without id is a document of its own, after all others (ids are below 2^62), that its text
    names. Documents meet by key and tag, so that an id on many different texts is no hot key.
    """
    text = whole(text_col)
    nameless = F.lit(NAMELESS).bitwiseOR(F.xxhash64(text).bitwiseAND(F.lit(NAMELESS - 1)))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), nameless).alias("key"),
                       F.xxhash64(text).alias("sign"),
                       F.xxhash64(text).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("tag"),
                       text.cast("binary").alias("data"), *([rest.alias("rest")] if rest is not None else []))


def planes(values: np.ndarray) -> bytes:
    """Sorted 64-bit values by byte position, so that the shuffle's codec finds the high bytes alike."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()


def buckets_of(df: DataFrame, text_col: str, most_bytes: int = 64 << 20) -> int:
    """A bucket for every ``most_bytes`` of text (each is searched in one task's memory), and at
    least the session's shuffle partitions."""
    size = df.agg(F.sum(F.octet_length(whole(text_col)).cast("long"))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // most_bytes))


def by_bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket numbers that rise with the value (so sorted values are sorted by bucket)."""
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pack_anchors(values: np.ndarray, owner: np.ndarray, docs: np.ndarray, tags: np.ndarray,
                 repeated: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows of PACKED for (anchor, document number) pairs of one task."""
    o = np.argsort(values, kind="stable")
    values, owner, repeated = values[o], owner[o], repeated[o]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    group = np.cumsum(new) - 1
    many = np.bincount(group, repeated) + np.bincount(group) > 1
    here = many[group]
    if here.any():  # settled here: these documents hold repeated anchors
        yield (int(docs[0]) % buckets, True, docs.tobytes(), tags.tobytes(),
               owner[here].astype(np.uint32).tobytes(), values[here].tobytes())
    values, owner = values[new], np.where(many, MANY, owner[new]).astype(np.uint32)
    at = np.searchsorted(by_bucket(values, buckets), np.arange(buckets + 1))
    for b, (i, j) in enumerate(zip(at.tolist(), at[1:].tolist())):
        if j > i:
            used, idx = np.unique(owner[i:j], return_inverse=True)
            its = np.minimum(used, len(docs) - 1)
            small = np.uint16 if len(used) < 1 << 16 else np.uint32
            idx = idx.astype(small)
            if used[-1] == MANY:
                idx[idx == len(used) - 1] = np.iinfo(small).max
            yield b, False, docs[its].tobytes(), tags[its].tobytes(), idx.tobytes(), planes(values[i:j])


def shared_anchors(rows: DataFrame, items: Callable[[bytes], np.ndarray], window: int, k: int,
                   within: bool, parts: list[int], limit: int = 3_000_000) -> DataFrame:
    """(key, tag, anchors): the anchors of each document that occur in another one (or, if ``within``,
    at another place of the same document). ``rows`` has key, tag, data and, after an earlier
    round, that round's ``anchors`` and ``k``: windows without one of them are left out.
    ``parts`` (see ``even_parts``) names the buckets: each is one task's."""
    kinds = [pa.int64(), pa.bool_(), *[pa.binary()] * 4]
    names = [x.split()[0] for x in PACKED.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, tags, found_in, size = [], [], [], 0

        def out():
            values, owner, repeated = map(np.concatenate, zip(*found_in))
            cols = zip(*pack_anchors(values, owner, np.array(docs, np.int64), np.array(tags, np.uint16),
                                     repeated, len(parts)))
            cols = [[parts[b] for b in next(cols)], *cols]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        for batch in slices(batches):
            for key, tag, data, *before in zip(*(batch.column(c).to_pylist() for c in cols)):
                found = items(data)
                if len(found) < window:
                    continue
                a = anchors(found, window, k)
                if before:
                    if not before[0]:
                        continue
                    a = a[member(anchors(found, window, before[1]), before[0])]
                a = np.unique(a)
                twice = np.zeros(len(a), np.int64)
                if within:
                    h, n = np.unique(spread(kgram_hashes(found, k) & ANCHOR_BITS), return_counts=True)
                    twice = (n[np.searchsorted(h, a)] > 1).astype(np.int64)
                found_in.append((a, np.full(len(a), len(docs)), twice))
                docs.append(key)
                tags.append(tag)
                size += len(a)
                if size > limit:
                    yield out()
                    docs, tags, found_in, size = [], [], [], 0
        if size:
            yield out()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, keys, marks, real = [], [], [], []
        for batch in batches:
            for many, docs, tags, at, packed in zip(*(batch.column(c).to_pylist() for c in names[1:])):
                docs, tags = np.frombuffer(docs, np.int64), np.frombuffer(tags, np.uint16)
                if many:
                    at = np.frombuffer(at, np.uint32)
                    yield pairs(docs[at], tags[at], np.frombuffer(packed, np.uint64))
                    continue
                v = unplanes(packed)
                at = np.frombuffer(at, np.uint16 if len(at) == 2 * len(v) else np.uint32)
                keep = at != np.iinfo(at.dtype).max
                # Many documents of a task hold the others: they count twice here, and as no document.
                at = np.where(keep, at, 0)
                none = np.zeros((~keep).sum(), np.int64)
                values += [v, v[~keep]]
                keys += [docs[at], none]
                marks += [tags[at], none.astype(np.uint16)]
                real += [keep, none.astype(bool)]
        if not values:
            return
        values, keys, marks, real = map(np.concatenate, (values, keys, marks, real))
        o = np.argsort(values)
        values, keys, marks, real = values[o], keys[o], marks[o], real[o]
        same = values[1:] == values[:-1]
        found = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        found &= real
        for i in range(0, len(values), 1 << 18):
            f = found[i:i + (1 << 18)]
            yield pairs(*(c[i:i + (1 << 18)][f] for c in (keys, marks, values)))

    def pairs(keys: np.ndarray, marks: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(marks.astype(np.int32)),
                                           pa.array(values.view(np.int64))], ["key", "tag", "anchor"])

    cols = ["key", "tag", "data"] + (["anchors", "k"] if "anchors" in rows.columns else [])
    # After an earlier round all columns stay, so that its join shuffles the texts as the later ones do.
    packed = mapped(rows if "anchors" in rows.columns else rows.select(*cols), pack, PACKED).repartition(
        len(parts), "bucket")
    return (mapped(packed, find, "key long, tag int, anchor long")
            .groupBy("key", "tag").agg(F.collect_set("anchor").alias("anchors")))


def member(values: np.ndarray, among: list[int]) -> np.ndarray:
    """True where a value is one of ``among`` (signed longs, as Spark holds them)."""
    known = np.unique(np.array(among, np.int64).view(np.uint64))
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def anchor_runs(a: np.ndarray, among: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of windows with one and the same kept anchor."""
    kept = member(a, among)
    edge = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (kept[1:] != kept[:-1]), [True]]))
    s, e = edge[:-1], edge[1:]
    return s[kept[s]], e[kept[s]]


LOCATED = "key long, sign long, spans binary, part long, bucket int, block binary"
_LOCATED_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]


def zipped(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unzipped(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def zipped_rows(rows: DataFrame) -> DataFrame:
    """The rows with ``data`` compressed, as they are shuffled and stored."""
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            at = batch.schema.get_field_index("data")
            data = pa.array([pack.compress(x) for x in batch.column(at).to_pylist()], pa.binary())
            yield batch.set_column(at, "data", data)

    # The filter is what an inner join by key and tag adds: stated here, both uses share one shuffle.
    return mapped(rows, rows_of, rows.schema).where("key is not null and tag is not null")


def even_parts(df: DataFrame, tasks: int) -> list[int]:
    """A number for each of ``tasks`` hash partitions that falls into it, so that buckets can be
    dealt out evenly."""
    found = (df.sparkSession.range(40 * tasks + 100).select("id", F.pmod(F.hash("id"), F.lit(tasks)).alias("p"))
             .groupBy("p").agg(F.min("id").alias("id")).collect())
    return [r["id"] for r in found]


class Blocks:
    """Packed blocks by bucket, in memory while small, else in a private folder's files."""

    def __init__(self, memory_bytes: int):
        self.memory_bytes, self.held, self.sizes, self.bytes = memory_bytes, {}, {}, 0

    def __enter__(self):
        self.folder = tempfile.TemporaryDirectory(prefix="blocks-")
        return self

    def __exit__(self, *failure):
        self.folder.cleanup()

    def add(self, bucket: int, block: bytes) -> None:
        self.held.setdefault(bucket, []).append(block)
        self.bytes += len(block)
        if self.bytes > self.memory_bytes:
            for b, parts in self.held.items():
                with open(f"{self.folder.name}/{b}", "ab") as f:
                    f.writelines(parts)
                self.sizes.setdefault(b, []).extend(map(len, parts))
            self.held, self.bytes = {}, 0

    def buckets(self) -> list[int]:
        return sorted(self.held.keys() | self.sizes.keys())

    def take(self, bucket: int) -> Iterator[bytes]:
        if bucket in self.sizes:
            with open(f"{self.folder.name}/{bucket}", "rb") as f:
                yield from map(f.read, self.sizes.pop(bucket))
        yield from self.held.pop(bucket, ())


def search_windows(rows: DataFrame, kept: DataFrame, collector: Callable, search: Callable,
                   parts: list[int], memory_bytes: int = 96 << 20) -> DataFrame:
    """Round 2: (key, sign, packed spans) of all documents that lose something.

    ``collector()`` makes an object with ``add(key, sign, data, anchors)``, ``full()`` and ``flush()``;
    the latter yields (key, sign, packed spans) settled in the task and (bucket, block) tuples.
    ``search(blocks)`` yields (key, sign, packed spans) of all blocks of one bucket. Blocks wait in the
    task's own scratch files once they are over ``memory_bytes``.
    """
    names = [x.split()[0] for x in LOCATED.split(", ")]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _LOCATED_KINDS)], names)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = collector()

        def flushed():
            out, size = [], 0
            for x in held.flush():
                if len(x) == 3:
                    out.append((*x, parts[x[0] % len(parts)], None, None))
                else:
                    out.append((None, None, None, parts[x[0] % len(parts)], x[0], zipped(x[1])))
                size += len(out[-1][2] or out[-1][5])
                if size > 4 << 20:
                    yield batch_of(out)
                    out, size = [], 0
            if out:
                yield batch_of(out)

        for batch in slices(batches):
            for key, sign, data, among in zip(*(batch.column(c).to_pylist()
                                                for c in ("key", "sign", "data", "anchors"))):
                held.add(key, sign, unzipped(data), among)
            if held.full():
                yield from flushed()
        yield from flushed()

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        with Blocks(memory_bytes) as blocks:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if row[4] is None:
                        found.append(row[:3])
                    else:
                        blocks.add(row[3], row[4])
            for bucket in blocks.buckets():
                for row in search(map(unzipped, blocks.take(bucket))):
                    found.append(row)
                    if len(found) == 200_000:
                        yield from dealt(found)
                        found = []
        yield from dealt(found)

    def dealt(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        """One row per task that gathers, not one per document and bucket."""
        to: dict[int, list] = {}
        for row in found:
            to.setdefault(row[0] % len(parts), []).append(row)
        for p, rows in to.items():
            yield pa.RecordBatch.from_arrays([pa.array([parts[p]], pa.int64()),
                                              pa.array([pack_documents(rows)], pa.binary())], ["part", "found"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans: dict[tuple[int, int], list[bytes]] = {}
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                for key, sign, part in unpack_documents(packed):
                    spans.setdefault((key, sign), []).append(part)
        out = []
        for (key, sign), parts_of in spans.items():
            out.append((key, sign, pack_spans(*merged(*unpack_spans(parts_of)))))
            if len(out) == 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _LOCATED_KINDS)],
                                                 names[:3])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _LOCATED_KINDS)],
                                             names[:3])

    # All columns, needed or not: a pruned one would make this a shuffle other than the last join's.
    blocks = mapped(rows.join(kept, ["key", "tag"]), locate, LOCATED).repartition(len(parts), "part")
    found = mapped(blocks.select("key", "sign", "spans", "bucket", "block"), searched,
                   "part long, found binary").repartition(len(parts), "part")
    return mapped(found.select("found"), gathered, "key long, sign long, spans binary")


def pack_documents(rows: list[tuple[int, int, bytes]]) -> bytes:
    head = np.array([(k, s, len(x)) for k, s, x in rows], np.int64)
    return zipped(np.int64(len(rows)).tobytes() + head.tobytes() + b"".join(x for _, _, x in rows))


def unpack_documents(packed: bytes) -> Iterator[tuple[int, int, bytes]]:
    data = unzipped(packed)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    at = 8 + 24 * n
    for key, sign, size in np.frombuffer(data, np.int64, 3 * n, 8).reshape(-1, 3).tolist():
        yield key, sign, data[at:at + size]
        at += size


def with_spans(rows: DataFrame, searched: DataFrame) -> DataFrame:
    """The rows with their spans (packed, merged; null where nothing is lost).

    The rows are the same frame that round 2 has joined by key and tag, so their shuffle is used again.
    """
    tag = F.col("sign").bitwiseAND(F.lit(0xFFFF)).cast("int")
    spans = searched.select(F.col("key").alias("at_key"), tag.alias("at_tag"), F.col("sign").alias("at_sign"),
                            "spans")
    same = ((rows["key"] == spans["at_key"]) & (rows["tag"] == spans["at_tag"])
            & (rows["sign"].bitwiseXOR(spans["at_sign"]) == 0))
    return rows.join(spans, same, "left").select(*rows.columns, "spans")


def pack_spans(starts: np.ndarray, ends: np.ndarray) -> bytes:
    return np.stack([starts, ends]).astype(np.int64).T.tobytes()


def unpack_spans(parts: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(parts or ()), np.int64).reshape(-1, 2)
    return flat[:, 0], flat[:, 1]


def spans_by_doc(doc: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(document number, packed spans) of each document."""
    o = np.argsort(doc, kind="stable")
    doc, starts, ends = doc[o], starts[o], ends[o]
    at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]])) if len(doc) else []
    for i, j in zip(at, at[1:]):
        yield int(doc[i]), pack_spans(starts[i:j], ends[i:j])
