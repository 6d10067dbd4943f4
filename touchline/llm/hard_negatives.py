"""Hard negatives by angular triangle filtering.

Every row keeps its norm and its angles to a few reference directions. For two rows the triangle
inequality on the sphere bounds their angle: at least the largest difference of their angles to
one reference, at most the smallest sum (or what that leaves of a full turn). The cosines of these
ends, times both norms and widened for rounding, bound the integer score; only rows whose interval
meets a wanted window are scored.

Rows lie in blocks, ordered by label and nearest reference. Anchors (the stated query set) go to
those blocks whose own bounds can meet their windows; a task holds one block and streams the anchors
that were sent to it, so its memory is that of a block. Best partners per block are ranked again over
all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.tables import mapped, stored
from touchline.llm.vectors import finite, matrices, scaled

ANGLE_SLACK = 1e-6   # arc cosines near 0 and pi lose half of the digits
MOST = float(1 << 62)
SUMMARIES = 1 << 16  # block summaries that the driver broadcasts at most

ROW = "dim int, label long, near int, angle double, vec_id long, x binary, norm double, angles binary"
PACKED = ("block int, kind int, dim int, n int, ids binary, uids binary, labels binary, x binary, "
          "norms binary, angles binary, windows binary")


def references(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors of the sample, each the one farthest from those taken before."""
    norms = np.sqrt((sample * sample).sum(1))
    unit = sample[norms > 0] / norms[norms > 0, None]
    taken: list[int] = []
    closest = np.full(len(unit), -2.0)
    for _ in range(min(count, len(unit))):
        at = int(closest.argmin())
        if taken and closest[at] > 1 - 1e-9:
            break
        taken.append(at)
        closest = np.maximum(closest, unit @ unit[at])
    return unit[taken]


def angles_to(x: np.ndarray, norms: np.ndarray, refs: np.ndarray | None, count: int) -> np.ndarray:
    """Angles of rows to ``count`` references; a right angle, which bounds nothing, for missing ones."""
    out = np.full((len(x), count), np.pi / 2)
    if refs is not None and len(refs):
        cos = x @ refs.T / np.where(norms > 0, norms, 1.0)[:, None]
        out[:, :len(refs)] = np.arccos(np.clip(cos, -1, 1))
    return out


def score_bounds(gap: np.ndarray, reach: np.ndarray, norms) -> tuple[np.ndarray, np.ndarray]:
    """Integer (low, high) that surely hold every score of rows whose angle lies in [gap, reach]."""
    high = np.cos(np.clip(gap - ANGLE_SLACK, 0, np.pi)) * norms
    low = np.cos(np.clip(reach + ANGLE_SLACK, 0, np.pi)) * norms
    slack = 1.0 + norms * 1e-12
    return np.ceil(low - slack), np.floor(high + slack)


def intervals(mine: np.ndarray, theirs: np.ndarray, norms) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds of one row (its angles) with many (angles by reference, products of norms)."""
    if not len(theirs):
        return -np.ceil(norms + 1), np.ceil(norms + 1)
    total = theirs + mine[:, None]
    gap = np.abs(theirs - mine[:, None]).max(0)
    reach = np.minimum(total, 2 * np.pi - total).min(0)
    return score_bounds(gap, reach, norms)


class Block:
    """Rows of one vector length in one block."""

    def __init__(self, dim: int, parts: list[dict]):
        def joined(name, kind):
            return np.concatenate([np.frombuffer(p[name], kind) for p in parts])

        self.ids, self.uids, self.labels = (joined(c, np.int64) for c in ("ids", "uids", "labels"))
        self.x = joined("x", np.int64).reshape(len(self.ids), dim)
        self.norms = joined("norms", np.float64)
        self.angles = np.ascontiguousarray(joined("angles", np.float64).reshape(len(self.ids), -1).T)
        # Products and sums below 2**52 are exact in doubles too, and faster.
        self.doubles = self.x.astype(np.float64)
        self.most = self.norms.max(initial=0.0)

    def scores(self, rows: np.ndarray, a: np.ndarray, norm: float) -> np.ndarray:
        if norm * self.most < float(1 << 52):
            return (self.doubles[rows] @ a.astype(np.float64)).astype(np.int64)
        return self.x[rows] @ a


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores first, then smaller ids."""
    if len(scores) > 4 * k:
        keep = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def positives_in(block: Block, uid: int, label: int, x, norm, angles, k: int) -> list[tuple]:
    """The block's k best other rows of the anchor's label: (id, uid, score)."""
    rows = np.flatnonzero((block.labels == label) & (block.uids != uid))
    if not len(rows):
        return []
    high = intervals(angles, block.angles[:, rows], block.norms[rows] * norm)[1]
    first = np.argpartition(-high, min(8 * k, len(rows)) - 1)[:8 * k]
    scores = block.scores(rows[first], x, norm)
    bar = np.sort(scores)[-k] if len(scores) >= k else -np.inf
    rest = high >= bar
    rest[first] = False
    more = rows[rest]
    found = np.concatenate([rows[first], more])
    scores = np.concatenate([scores, block.scores(more, x, norm)])
    top = best(scores, block.ids[found], k)
    return [(block.ids[found[t]], block.uids[found[t]], scores[t]) for t in top]


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def negatives_in(block: Block, label: int, x, norm, angles, windows: np.ndarray, k: int) -> list[tuple]:
    """The block's k best rows of other labels in each window: (window, id, uid, score)."""
    rows = np.flatnonzero(block.labels != label)
    if not len(rows):
        return []
    low, high = intervals(angles, block.angles[:, rows], block.norms[rows] * norm)
    near = np.zeros(len(rows), bool)
    for a, b in windows.tolist():
        if a <= b:
            near |= (high >= a) & (low <= b)
    rows = rows[near]
    scores = block.scores(rows, x, norm)
    out = []
    for w, (a, b) in enumerate(windows.tolist()):
        inside = np.flatnonzero((scores >= a) & (scores <= b))
        for t in inside[best(scores[inside], block.ids[rows[inside]], k)]:
            out.append((w, block.ids[rows[t]], block.uids[rows[t]], scores[t]))
    return out


def _prepared(rows: DataFrame, refs, count: int) -> DataFrame:
    """Rows with norm, angles and nearest reference."""
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, label = batch.column("vec_id"), batch.column("label")
            for at, x in matrices(batch.column("x")):
                f = x.astype(np.float64)
                norms = np.sqrt((f * f).sum(1))
                fits = norms * norms < MOST
                at, x, f, norms = at[fits], x[fits], f[fits], norms[fits]
                theta = angles_to(f, norms, refs.value.get(x.shape[1]), count)
                near = theta.argmin(1) if count else np.zeros(len(x), int)
                own = theta[np.arange(len(x)), near] if count else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), x.shape[1]), pa.int32()), label.take(pa.array(at)),
                     pa.array(near, pa.int32()), pa.array(own), ids.take(pa.array(at)),
                     pa.array([r.tobytes() for r in x], pa.binary()), pa.array(norms),
                     pa.array([r.tobytes() for r in theta], pa.binary())],
                    ["dim", "label", "near", "angle", "vec_id", "x", "norm", "angles"])

    return mapped(rows, out, ROW)


def _blocks(rows: DataFrame, blocks: int, count: int) -> DataFrame:
    """Packed rows of at most 1024 vectors, and their bounds; a block is a range of the order."""
    order = ["dim", "label", "near", "angle", "vec_id"]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                for i in range(0, len(at), 1024):
                    part = batch.take(pa.array(at[i:i + 1024]))
                    label, norm = part.column("label").to_numpy(), part.column("norm").to_numpy()
                    theta = np.frombuffer(b"".join(part.column("angles").to_pylist())).reshape(len(label), count)
                    uid = np.int64(block << 40) + np.arange(seen, seen + len(label))
                    seen += len(label)
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block], pa.int32()), "kind": pa.array([0], pa.int32()),
                        "dim": pa.array([dim], pa.int32()), "n": pa.array([len(label)], pa.int32()),
                        "ids": pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()),
                        "uids": pa.array([uid.tobytes()], pa.binary()),
                        "labels": pa.array([label.tobytes()], pa.binary()),
                        "x": pa.array([b"".join(part.column("x").to_pylist())], pa.binary()),
                        "norms": pa.array([norm.tobytes()], pa.binary()),
                        "angles": pa.array([theta.tobytes()], pa.binary()),
                        "windows": pa.array([b""], pa.binary()),
                        "low_label": pa.array([label.min()], pa.int64()),
                        "high_label": pa.array([label.max()], pa.int64()),
                        "most_norm": pa.array([norm.max()], pa.float64()),
                        "low": pa.array([theta.min(0).tolist()], pa.list_(pa.float64())),
                        "high": pa.array([theta.max(0).tolist()], pa.list_(pa.float64()))})

    return mapped(rows.repartitionByRange(blocks, *order).sortWithinPartitions(*order), out,
                  PACKED + ", low_label long, high_label long, most_norm double, low array<double>, "
                           "high array<double>")


def _summaries(packed: DataFrame, blocks: int, count: int) -> list[dict]:
    """Bounds of runs of consecutive blocks (``SUMMARIES`` runs at most, one block each up to that)."""
    per = -(-blocks // SUMMARIES)
    ends = [F.min(F.col("low")[k]).alias(f"low{k}") for k in range(count)]
    ends += [F.max(F.col("high")[k]).alias(f"high{k}") for k in range(count)]
    rows = (packed.groupBy(F.floor(F.col("block") / per).cast("int").alias("run"), "dim")
            .agg(F.min("low_label").alias("low_label"), F.max("high_label").alias("high_label"),
                 F.max("most_norm").alias("norm"), F.collect_set("block").alias("blocks"), *ends).collect())
    return [{"dim": r["dim"], "low_label": r["low_label"], "high_label": r["high_label"], "norm": r["norm"],
             "blocks": sorted(r["blocks"]), "low": np.array([r[f"low{k}"] for k in range(count)]),
             "high": np.array([r[f"high{k}"] for k in range(count)])} for r in rows]


def _routed(anchors: DataFrame, summaries) -> DataFrame:
    """Anchors (rows dim, vec_id, uid, label, x, norm, angles, windows) packed once per block that may
    hold partners: without windows those of its label, else those with another label whose scores
    can lie in a window."""
    def wanted(s, label, norm, theta, window):
        if window is None:
            return s["low_label"] <= label <= s["high_label"]
        spans = [(a, b) for a, b in window.tolist() if a <= b]
        if not spans or s["low_label"] == s["high_label"] == label:
            return False
        if not len(theta):
            return True
        gap = np.maximum(np.maximum(s["low"] - theta, theta - s["high"]), 0).max()
        high = score_bounds(np.array([gap]), np.array([np.pi]), np.array([norm * s["norm"]]))[1][0]
        # The norm of a row may be as small as zero, so a score bound is never below zero here.
        return max(high, 0.0) >= min(a for a, _ in spans)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["theta"] = np.frombuffer(r["angles"])
                r["spans"] = None if r["windows"] is None else np.frombuffer(r["windows"], np.int64).reshape(-1, 2)
            for s in summaries.value:
                mine = [r for r in rows if r["dim"] == s["dim"]
                        and wanted(s, r["label"], r["norm"], r["theta"], r["spans"])]
                if not mine:
                    continue
                k = len(s["blocks"])
                widths = np.array([len(r["windows"] or b"") // 16 for r in mine], np.int64)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(s["blocks"], pa.int32()), "kind": pa.array([1] * k, pa.int32()),
                    "dim": pa.array([s["dim"]] * k, pa.int32()), "n": pa.array([len(mine)] * k, pa.int32()),
                    "ids": pa.array([np.array([r["vec_id"] for r in mine], np.int64).tobytes()] * k, pa.binary()),
                    "uids": pa.array([np.array([r["uid"] for r in mine], np.int64).tobytes()] * k, pa.binary()),
                    "labels": pa.array([np.array([r["label"] for r in mine], np.int64).tobytes()] * k, pa.binary()),
                    "x": pa.array([b"".join(r["x"] for r in mine)] * k, pa.binary()),
                    "norms": pa.array([np.array([r["norm"] for r in mine]).tobytes()] * k, pa.binary()),
                    "angles": pa.array([b"".join(r["angles"] for r in mine)] * k, pa.binary()),
                    "windows": pa.array([widths.tobytes() + b"".join(r["windows"] or b"" for r in mine)] * k,
                                        pa.binary())})

    return mapped(anchors, out, PACKED)


def _searched(packed: DataFrame, queries: DataFrame, blocks: int, k: int, negatives: bool) -> DataFrame:
    """Best partners of every routed anchor in each block: uid, window, other_id, other_uid, score."""
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = None, {}, {}
        for batch in batches:
            for r in (row for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
                if r["block"] != now:
                    now, parts, held = r["block"], {}, {}
                if r["kind"] == 0:
                    parts.setdefault(r["dim"], []).append(r)
                    continue
                if r["dim"] in parts:
                    held[r["dim"]] = Block(r["dim"], parts.pop(r["dim"]))
                if r["dim"] not in held:
                    continue
                rows, found = held[r["dim"]], []
                n = r["n"]
                uids, labels = (np.frombuffer(r[c], np.int64) for c in ("uids", "labels"))
                x = np.frombuffer(r["x"], np.int64).reshape(n, r["dim"])
                norms, theta = np.frombuffer(r["norms"]), np.frombuffer(r["angles"]).reshape(n, -1)
                numbers = np.frombuffer(r["windows"], np.int64)
                ends = np.cumsum(numbers[:n]) * 2 + n
                for i in range(n):
                    if negatives:
                        spans = numbers[ends[i] - 2 * numbers[i]:ends[i]].reshape(-1, 2)
                        hits = negatives_in(rows, labels[i], x[i], norms[i], theta[i], spans, k)
                    else:
                        hits = [(0, *h) for h in positives_in(rows, uids[i], labels[i], x[i], norms[i], theta[i], k)]
                    found += [(int(uids[i]), *map(int, h)) for h in hits]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int32(), pa.int64(),
                                                                      pa.int64(), pa.int64()))],
                        ["uid", "window", "other_id", "other_uid", "score"])

    names = [c.split()[0] for c in PACKED.split(", ")]
    hits = mapped(packed.select(*names).union(queries).repartition(blocks, "block")
                  .sortWithinPartitions("block", "kind"), out,
                  "uid long, window int, other_id long, other_uid long, score long")
    ranked = F.row_number().over(Window.partitionBy("uid", "window")
                                 .orderBy(F.desc("score"), "other_id", "other_uid"))
    return hits.withColumn("rank", ranked).where(F.col("rank") <= k)


def _anchors(packed: DataFrame, every: int) -> DataFrame:
    """One row per anchor, out of the packed blocks."""
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["n"]
                ids, uids, labels = (np.frombuffer(r[c], np.int64) for c in ("ids", "uids", "labels"))
                at = np.flatnonzero(ids % every == 0)
                x = np.frombuffer(r["x"], np.int64).reshape(n, -1) if r["dim"] else np.zeros((n, 0), np.int64)
                norms = np.frombuffer(r["norms"])
                theta = np.frombuffer(r["angles"]).reshape(n, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), r["dim"]), pa.int32()), pa.array(ids[at]), pa.array(uids[at]),
                     pa.array(labels[at]), pa.array([x[i].tobytes() for i in at], pa.binary()),
                     pa.array(norms[at]), pa.array([theta[i].tobytes() for i in at], pa.binary())],
                    ["dim", "vec_id", "uid", "label", "x", "norm", "angles"])

    return mapped(packed, out, "dim int, vec_id long, uid long, label long, x binary, norm double, angles binary")


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3,
         low_percent: int = 50, high_percent: int = 95, reference_count: int = 8,
         sample_rows: int = 2000, block_rows: int = 1 << 16, id_col: str = "vec_id",
         vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``, against all rows. The references are
    picked from at most ``sample_rows`` rows; results do not depend on them. Defined cases: rows with a null label, id or
    vector, or null or non-finite components, take no part, nor do rows whose squared norm
    reaches 2^62 (scores would leave a long); zero vectors do. Vectors of different lengths have no
    score and never meet. Rows that repeat an id are rows of their own, and a repeated anchor returns
    its rows again. A positive score below zero leaves no window. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & finite(F.col(vector_col))
                         ).select(F.col(id_col).cast("long").alias("vec_id"),
                                  F.col(label_col).cast("long").alias("label"), scaled(F.col(vector_col)).alias("x"))
    n = rows.count()
    blocks = max(-(-n // block_rows), min(2 * spark.sparkContext.defaultParallelism, -(-n // 1024)), 1)
    sample: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("x").collect():
        sample.setdefault(len(r[0]), []).append(r[0])
    refs = spark.sparkContext.broadcast(
        {d: references(np.array(x, np.float64), reference_count) for d, x in sample.items() if d})
    packed = stored(_blocks(_prepared(rows, refs, reference_count), blocks, reference_count), "mining-blocks")
    summaries = spark.sparkContext.broadcast(_summaries(packed, blocks, reference_count))
    anchors = stored(_anchors(packed, every), "mining-anchors")
    queries = _routed(anchors.withColumn("windows", F.lit(None).cast("binary")), summaries)
    found = stored(_searched(packed, queries, blocks, positives, False), "mining-positives")
    pairs = (found.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found"))
             .join(anchors, "uid"))
    queries = _routed(_with_windows(pairs, low_percent, high_percent), summaries)
    hits = _searched(packed, queries, blocks, negatives, True).select(
        "uid", (F.col("window") + 1).alias("nth"), "rank", F.col("other_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return (hits.join(found.select("uid", F.col("rank").alias("nth"), F.col("other_id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["uid", "nth"])
            .join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))


def _with_windows(pairs: DataFrame, low: int, high: int) -> DataFrame:
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [np.array([window_of(f["score"], low, high) for f in found], np.int64).tobytes()
                     for found in batch.column("found").to_pylist()]
            keep = [batch.column(c) for c in ("dim", "vec_id", "uid", "label", "x", "norm", "angles")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(spans, pa.binary())],
                                             ["dim", "vec_id", "uid", "label", "x", "norm", "angles", "windows"])

    return mapped(pairs, out, "dim int, vec_id long, uid long, label long, x binary, norm double, "
                              "angles binary, windows binary")


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_dot_product(a.x, b.x)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other)::INT AS rank,
       s.other AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""
