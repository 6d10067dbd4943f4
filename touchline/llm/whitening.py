"""Embedding whitening from a pivoted Cholesky factor and one-sided Jacobi rotations.

The distinct integer vectors are the fit list. Their sums are exact; the scatter of the centred
vectors is summed per task and added up entry by entry, so no task or driver holds more than a
matrix of one vector length. One task per length factors it: Cholesky with diagonal pivots gives a
triangular factor whose columns, one per rank, are rotated pairwise until they are orthogonal. Their squared
norms are the eigenvalues and the normalised columns the eigenvectors, without ever forming the
product again, so small eigenvalues keep their relative accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import mapped, stored
from touchline.llm.vectors import finite, matrices, scaled

SAFE = 1 << 62
HELD = 64 << 20  # bytes of partial matrices that a task holds before it hands them on


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Columns l (one per rank, rows in the order of ``a``) with l @ l.T equal to ``a``.

    Each step takes the largest remaining diagonal entry as its pivot and stops once that is
    rounding noise of the first.
    """
    d = len(a)
    left = np.diag(a).astype(np.float64).copy()
    noise = d * np.finfo(np.float64).eps * max(left.max(initial=0.0), 0.0)
    cols: list[np.ndarray] = []
    taken = np.zeros(d, bool)
    done = np.zeros((d, d))
    for k in range(d):
        p = int(np.where(taken, -1.0, left).argmax())
        if taken[p] or left[p] <= noise:
            break
        col = (a[:, p] - done[:, :k] @ done[p, :k]) / np.sqrt(left[p])
        col[taken] = 0.0
        col[p] = np.sqrt(left[p])
        taken[p] = True
        left -= col * col
        done[:, k] = col
        cols.append(col)
    return done[:, :len(cols)]


def rounds(r: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint column pairs (a tournament) that meet every pair of ``r`` columns once."""
    order = list(range(r + r % 2))
    for _ in range(len(order) - 1):
        half = len(order) // 2
        pairs = [sorted(p) for p in zip(order[:half], order[:half - 1:-1]) if max(p) < r]
        if pairs:
            yield tuple(np.array(pairs).T)
        order = [order[0], order[-1], *order[1:-1]]


def one_sided_jacobi(l: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of l @ l.T, by rotating column pairs
    until all are orthogonal to working precision."""
    u = np.array(l, np.float64)
    tight = np.finfo(np.float64).eps * max(1.0, np.sqrt(len(u)))
    pairing = list(rounds(u.shape[1]))
    for _ in range(sweeps):
        worst = 0.0
        for p, q in pairing:
            x, y = u[:, p], u[:, q]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(c) / np.sqrt(a * b)
            worst = max(worst, float(off.max()))
            turn = off > tight
            if not turn.any():
                continue
            zeta = (b - a) / np.where(turn, 2 * c, 1.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            cs = 1 / np.hypot(1.0, t)
            sn = cs * t
            u[:, p], u[:, q] = cs * x - sn * y, sn * x + cs * y
        if worst <= tight:
            break
    norms = np.sqrt((u * u).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, u[:, order] / norms[order]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: longs where they fit, Python integers otherwise."""
    far = n * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) + max(map(abs, sums), default=0)
    if far < SAFE:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(dev: np.ndarray) -> list[int]:
    """Exact sums of squares of the rows."""
    if dev.dtype != object and dev.size:
        far = int(np.abs(dev).max())
        if far * far * dev.shape[1] < SAFE:
            return (dev * dev).sum(1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in dev]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, place, total): sums per place, and the number of vectors at place -1."""
    held: dict[int, list[int]] = {}

    def out():
        rows = [(d, j - 1, v) for d, t in held.items() for j, v in enumerate(t)]
        held.clear()
        d, j, v = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(d, pa.int32()), pa.array(j, pa.int32()),
             pa.array([Decimal(t) for t in v], pa.decimal128(38, 0))], ["dim", "place", "total"])

    for batch in batches:
        for _, x in matrices(batch.column(0)):
            d = x.shape[1]
            big = len(x) * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) >= SAFE
            total = x.astype(object).sum(0) if big else x.sum(0)
            now = held.setdefault(d, [0] * (d + 1))
            held[d] = [now[0] + len(x)] + [a + int(b) for a, b in zip(now[1:], total)]
            if sum(map(len, held.values())) * 64 > HELD:
                yield out()
    if held:
        yield out()


def _factor(table: pa.Table) -> pa.Table:
    """The first components of one vector length from the entries of its centred scatter."""
    d, n, most = (table[c][0].as_py() for c in ("dim", "n", "most"))
    a = np.zeros((d, d))
    i, j, v = (table[c].to_numpy() for c in ("i", "j", "v"))
    a[i, j] = v
    a[j, i] = v
    e, vectors = one_sided_jacobi(pivoted_cholesky(a))
    k = min(most, len(e))
    trace = float(np.trace(a))
    return pa.table({"dim": pa.array([d] * k, pa.int32()), "component": pa.array(range(1, k + 1), pa.int32()),
                     "eigenvalue": pa.array(e[:k] / n, pa.float64()),
                     "explained": pa.array(e[:k] / trace if k else [], pa.float64()),
                     "direction": pa.array([vectors[:, c].tolist() for c in range(k)], pa.list_(pa.float64()))})


class Model:
    """Per vector length: n, S, and the components with their eigenvalues."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.eigenvalues = self.explained = np.zeros(0)
        self.directions = np.zeros((len(sums), 0))

    def learn(self, rows: list) -> None:
        rows = sorted(rows, key=lambda r: r["component"])
        self.eigenvalues = np.array([r["eigenvalue"] for r in rows])
        self.explained = np.array([r["explained"] for r in rows])
        self.directions = np.array([r["direction"] for r in rows]).T

    def centred(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(deviations(x, self.n, self.sums) / self.n, np.float64)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.eigenvalues)


def _chunks(lengths: list[tuple[int, int]], most: int, held: int = HELD) -> list[dict[int, int]]:
    """Vector lengths in groups whose models (sums and components) stay under ``held`` bytes."""
    out: list[dict[int, int]] = []
    room = 0
    for d, n in sorted(lengths):
        need = (most + 2) * d * 8
        if not out or need > room:
            out.append({})
            room = max(held, need)
        out[-1][d] = n
        room -= need
    return out


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained,
    identity_error (and eigenvalue).

    Defined cases: rows whose vector is null or holds null or non-finite entries are dropped; rows
    with a null or repeated id are whitened like others; copies enter the fit once.
    Vectors of each length are fitted on their own (identity_error is the largest of
    all). Components without variance have no whitened value and are left out, so a table of one
    distinct vector, of empty vectors or of no rows gives no rows. ``deviation`` is exact (a decimal);
    a task needs memory for one square matrix of the vector length.
    """
    spark = vectors.sparkSession
    usable = vectors.where(finite(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("x"))
    fit = stored(usable.select("x").distinct(), "whitening-fit")
    totals = stored(mapped(fit, _sums, "dim int, place int, total decimal(38,0)")
                    .groupBy("dim", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total")),
                    "whitening-sums")
    lengths = [(r["dim"], int(r["total"])) for r in totals.where("place = -1 and dim > 0").collect()]
    parts, worst = [], 0.0
    for chunk in _chunks(lengths, components):
        low, high = min(chunk), max(chunk)
        model = {d: Model(n, [0] * d) for d, n in chunk.items()}
        for r in totals.where(F.col("place") >= 0).where(F.col("dim").between(low, high)).collect():
            model[r["dim"]].sums[r["place"]] = int(r["total"])
        within = F.size("x").between(low, high)
        for r in _components(fit.where(within), spark.sparkContext.broadcast(model), components).items():
            model[r[0]].learn(r[1])
        shared = spark.sparkContext.broadcast(model)
        parts.append(_whitened(usable.where(within), shared))
        worst = max(worst, _identity_error(fit.where(within), shared, components))
    schema = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
              "explained double, eigenvalue double")
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    return rows.withColumn("identity_error", F.lit(worst))


def _components(fit: DataFrame, model, most: int) -> dict[int, list]:
    """Rows of the components by vector length (collected: at most ``most`` vectors a length)."""
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def out():
            for d, s in held.items():
                i, j = np.triu_indices(d)
                for k in range(0, len(i), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(i[part]), d), pa.int32()), pa.array(i[part], pa.int32()),
                         pa.array(j[part], pa.int32()), pa.array(s[i[part], j[part]])], ["dim", "i", "j", "v"])
            held.clear()

        for batch in batches:
            for _, x in matrices(batch.column(0)):
                z = model.value[x.shape[1]].centred(x)
                held[x.shape[1]] = held.get(x.shape[1], 0.0) + z.T @ z
                if sum(s.nbytes for s in held.values()) > HELD:
                    yield from out()
        yield from out()

    entries = (mapped(fit, scatter, "dim int, i int, j int, v double")
               .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")))
    known = {d: m.n for d, m in model.value.items()}
    counts = fit.sparkSession.createDataFrame(list(known.items()), "dim int, n long")
    found: dict[int, list] = {}
    for r in (entries.join(F.broadcast(counts), "dim").withColumn("most", F.lit(most))
              .groupBy("dim").applyInArrow(_factor, "dim int, component int, eigenvalue double, "
                                                    "explained double, direction array<double>").collect()):
        found.setdefault(r["dim"], []).append(r)
    return found


def _whitened(rows: DataFrame, model) -> DataFrame:
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for at, x in matrices(batch.column("x")):
                m = model.value[x.shape[1]]
                k = len(m.eigenvalues)
                if not k:
                    continue
                exact = [Decimal(v) for v in squares(deviations(x, m.n, m.sums))]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(at, k))),
                     pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                     pa.array(np.full(len(at) * k, m.n), pa.int64()),
                     pa.array([v for v in exact for _ in range(k)], pa.decimal128(38, 0)),
                     pa.array(m.whiten(x).ravel()), pa.array(np.tile(m.explained, len(at))),
                     pa.array(np.tile(m.eigenvalues, len(at)))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "eigenvalue"])

    return mapped(rows, out, "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
                             "explained double, eigenvalue double")


def _identity_error(fit: DataFrame, model, most: int) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    names = [f"w{k}" for k in range(most)]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                w = model.value[x.shape[1]].whiten(x)
                cols = [pa.array(w[:, k]) if k < w.shape[1] else pa.nulls(len(x), pa.float64())
                        for k in range(most)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1]), pa.int32()), *cols],
                                                 ["dim", *names])

    # covar_pop merges centred partial results; it is null where a length has fewer components.
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    gaps = [F.coalesce(F.abs(F.covar_pop(a, b) - float(a == b)), F.lit(0.0)) for a, b in pairs]
    found = (mapped(fit, out, "dim int, " + ", ".join(f"{c} double" for c in names)).groupBy("dim")
             .agg(F.array_max(F.array(*gaps)).alias("gap")).agg(F.max("gap")).first()[0])
    return float(found or 0.0)
