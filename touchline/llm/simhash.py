"""SimHash near-duplicates through vantage-point trees.

The distinct fingerprints are partitioned by Hamming distance: a tree of vantage points
and median radii, whose shape comes from a bounded sample, gives every fingerprint one
shard. A query with radius r visits the inner side of a vantage point if its distance is at
most radius + r and the outer side if it is above radius - r (triangle inequality), so
fingerprints near a boundary are queried in the shards on both sides and no pair is missed.
A fingerprint leaves its own path for outer sides only: the one on the inner side finds the
pair, so the other need not look for it and each pair of shards is visited from one of them.
Inside a shard the same tree search goes on until blocks are small; pairs are exact.
Equal fingerprints are one node, and a task returns a spanning forest of the pairs
it finds, so neither copies nor dense groups are expanded into all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.components import components, stars
from touchline.llm.tables import free_names, mapped, slices, stored, whole

SEED = 42


def fingerprint(text: bytes, words_in: int = 3) -> int:
    """SimHash of the word shingles of a UTF-8 text (A-Z lower-cased); no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < words_in:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths)[:len(words) - words_in + 1].tolist(), ends[words_in - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    n, ones = len(starts), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in
                         zip(starts[i:i + (1 << 16)], stops[i:i + (1 << 16)])), np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words_in: int = 3) -> DataFrame:
    """doc_id and its fingerprint ``fp`` (as a signed long), a row per document."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t, words_in) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))],
                                             ["doc_id", "fp"])

    return mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              whole(text_col).cast("binary")), rows, "doc_id long, fp long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def split_of(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius that part the points best of a few candidates, or None."""
    best = None
    for vp in points[np.linspace(0, len(points) - 1, 5).astype(int)]:
        d = distance(points, vp).astype(int)
        r = int(np.median(d))
        r -= r == d.max()
        inner = (d <= r).mean()
        if 0 < inner < 1:
            near = ((d >= r - 2) & (d <= r + 3)).mean() + abs(inner - 0.5)
            if best is None or near < best[0]:
                best = (near, vp, r)
    return best and best[1:]


def grow(sample: np.ndarray, levels: int):
    """Tree as nested tuples (vantage point, radius, inner, outer); None is a shard."""
    split = split_of(sample) if levels and len(sample) > 16 else None
    if split is None:
        return None
    vp, r = split
    inner = distance(sample, vp) <= r
    return vp, r, grow(sample[inner], levels - 1), grow(sample[~inner], levels - 1)


def route(tree, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, its members, the other fingerprints that visit it) of these points."""
    todo = [(tree, 1, points, points[:0])]
    while todo:
        node, name, members, visitors = todo.pop()
        if node is None:
            if len(members) or len(visitors):
                yield name, members, visitors
            continue
        vp, r, inner, outer = node
        dm, dv = distance(members, vp).astype(int), distance(visitors, vp).astype(int)
        crossing = members[(dm <= r) & (dm > r - reach)]
        todo.append((inner, 2 * name, members[dm <= r], visitors[dv <= r + reach]))
        todo.append((outer, 2 * name + 1, members[dm > r],
                     np.concatenate([visitors[dv > r - reach], crossing])))


def blocks_of(points: np.ndarray, k: int, shift: int) -> list[np.ndarray]:
    """The points in ``k`` blocks by hash, the same block for a point wherever it is met."""
    if k == 1:
        return [points]
    block = (points * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(shift)) % np.uint64(k)
    order = np.argsort(block, kind="stable")
    return np.split(points[order], np.searchsorted(block[order], np.arange(1, k)))


def near_pairs(members: np.ndarray, queries: np.ndarray, reach: int, block: int = 1024,
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Exact pairs (query, member), different and at most ``reach`` bits apart."""
    todo = [(members, queries)]
    while todo:
        m, q = todo.pop()
        if not len(m) or not len(q):
            continue
        split = split_of(m[::max(1, len(m) // 512)]) if len(m) > 128 and len(q) > 128 else None
        if split is not None:
            vp, r = split
            dm, dq = distance(m, vp), distance(q, vp).astype(int)
            visits = (dq <= r + reach), (dq > r - reach)
            # Go on where the triangle bounds save work; else compare directly.
            if sum(v.sum() * s for v, s in zip(visits, ((dm <= r).sum(), (dm > r).sum()))) < 0.95 * len(m) * len(q):
                todo.append((m[dm <= r], q[visits[0]]))
                todo.append((m[dm > r], q[visits[1]]))
                continue
        for i in range(0, len(q), block):
            for j in range(0, len(m), block):
                x = q[i:i + block, None] ^ m[None, j:j + block]
                a, b = np.nonzero(np.bitwise_count(x) <= reach)
                a, b = q[i + a], m[j + b]
                other = a != b
                if other.any():
                    yield a[other], b[other]


def routed_points(nodes: DataFrame, reach: int, shard_rows: int, sample_rows: int) -> DataFrame:
    """Rows (shard, n_members, n_visitors, members, visitors): a task's fingerprints by shard, packed."""
    n = nodes.count()
    levels = max(0, int(np.ceil(np.log2(max(n, 1) / shard_rows))))
    sample = np.array([r[0] for r in nodes.orderBy(F.xxhash64("fp"), "fp")
                       .limit(min(sample_rows, 64 << levels)).collect()] if levels else [], np.int64)
    tree = grow(sample.view(np.uint64), levels)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def out():
            found = list(route(tree, np.concatenate(held).view(np.uint64), reach))
            cols = list(zip(*((s, len(m), len(v), m.tobytes(), v.tobytes()) for s, m, v in found)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                              ["shard", "n_members", "n_visitors", "members", "visitors"])

        for batch in batches:
            held.append(batch.column(0).to_numpy())
            rows += len(held[-1])
            if rows >= 50_000:
                yield out()
                held, rows = [], 0
        if rows:
            yield out()

    return mapped(nodes.select("fp"), routed,
                  "shard long, n_members long, n_visitors long, members binary, visitors binary")


def link(nodes: DataFrame, reach: int = 3, shard_rows: int = 4096, sample_rows: int = 100_000,
         shard_work: int = 1 << 29) -> DataFrame:
    """Edges (a, b) that join all fingerprints ``fp`` at most ``reach`` bits apart: a spanning
    forest of the links of each shard.

    ``sample_rows`` bounds the sample that shapes the tree, and with it the number of shards. A
    shard that holds more than the square root of ``shard_work`` members or queries is dealt
    into blocks of each; a task gets one block of either kind and compares no more than
    ``shard_work`` pairs, so its memory and time are bounded whatever the input.
    """
    packed = stored(routed_points(nodes, reach, shard_rows, sample_rows), "shards")
    side = float(np.sqrt(shard_work))
    blocks = (packed.groupBy("shard")
              .agg(F.sum("n_members").alias("m"), F.sum(F.col("n_members") + F.col("n_visitors")).alias("q"))
              .where("m > 0")
              .select("shard", F.ceil(F.col("m") / side).cast("int").alias("km"),
                      F.ceil(F.col("q") / side).cast("int").alias("kq")))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for shard, members, visitors, km, kq in zip(*(c.to_pylist() for c in batch.columns)):
                m, v = np.frombuffer(members, np.uint64), np.frombuffer(visitors, np.uint64)
                for j, q in enumerate(blocks_of(np.concatenate([m, v]), kq, 40)):
                    found = [(shard, i, j, x.tobytes(), q.tobytes())
                             for i, x in enumerate(blocks_of(m, km, 32)) if len(x) or len(q)]
                    if found:
                        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                            ["shard", "m_block", "q_block", "members", "queries"])

    def searched(table: pa.Table) -> pa.Table:
        members = np.frombuffer(b"".join(table["members"].to_pylist()), np.uint64)
        queries = np.frombuffer(b"".join(table["queries"].to_pylist()), np.uint64)
        a = b = np.zeros(0, np.int64)
        held, size = [(a, b)], 0
        for x, y in near_pairs(members, queries, reach):
            held.append((x.view(np.int64), y.view(np.int64)))
            size += len(x)
            if size > 1_000_000:
                held, size = [stars(*map(np.concatenate, zip(*held)))], 0
        a, b = stars(*map(np.concatenate, zip(*held)))
        return pa.table({"a": a, "b": b})

    spread = mapped(packed.join(blocks, "shard").select("shard", "members", "visitors", "km", "kq"), dealt,
                    "shard long, m_block int, q_block int, members binary, queries binary")
    return spread.groupBy("shard", "m_block", "q_block").applyInArrow(searched, "a long, b long")


def simhash_dedup(docs: DataFrame, words_in: int = 3, reach: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 lower-case hex digits), component_id (the smallest doc_id
    reachable by links).

    Null and empty texts have fingerprint 0 and link with each other and with near
    fingerprints like any other; a row with a null doc_id takes part, and its component_id is
    null only if its component holds no id; repeated rows get one row each; an empty table gives none.
    """
    rows = stored(fingerprints(docs, id_col, text_col, words_in), "fingerprints")
    # One row per fingerprint, with the smallest id that has it.
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"),
                                          F.count(F.lit(1)).alias("n")), "nodes")
    roots = components(link(nodes, reach))
    rooted = (nodes.join(roots, nodes.fp == roots.node, "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = rooted.join(lowest, "root").select("fp", "component_id")
    salts = 16  # one fingerprint may hold a third of all rows
    spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
            .join(spread, ["fp", "salt"])
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one_near(docs: DataFrame, words_in: int = 3, reach: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id is its component's smallest, with all their columns.
    Rows that share the smallest doc_id all stay; a row without id stays if its component has none."""
    own, = free_names(docs, "kept_id")
    kept = (simhash_dedup(docs, words_in, reach, id_col, text_col)
            .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias(own)).distinct())
    return docs.join(kept, docs[id_col].eqNullSafe(F.col(own)), "left_semi")
