"""Near-duplicate embeddings by product quantisation.

Equal vectors of a label are one class, so copies are never paired with each other. Each class
vector, scaled to unit length, lies in the inverted list of its nearest coarse centroid;
its residual is coded by the nearest codeword in each subspace, and the length of what the
codes miss is stored. A query probes every list whose cell can hold a vector within the
search radius (distance to the bisecting plane), compares its table of query-to-codeword distances
with the codes (asymmetric distance), and keeps a member if that distance is at most the radius plus
the member's stored error. Both bounds are safe, so no link is lost; the exact cosine in double
precision decides. A pair in two lists is found from the one with the smaller number only, so a
vector probes its own list and later ones.

Links are never written out: each searched part gives the number of links per class, and a spanning forest
of the links it found, so that a dense group costs what its vectors cost, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from touchline.llm.components import components, stars
from touchline.llm.tables import mapped, stored

SALTS = 16


def usable(embedding: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    ok = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok, F.lit(False)) & F.coalesce(F.exists(embedding, lambda x: x != 0), F.lit(False))


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids of Lloyd's rounds from evenly spaced rows; an empty cluster keeps its place."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])


class Quantiser:
    """Coarse centroids and one codebook per subspace, trained on unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int, codewords: int):
        self.coarse = kmeans(sample, lists)
        residual = sample - self.coarse[nearest(sample, self.coarse)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        self.books = [kmeans(residual[:, p], min(codewords, 256)) for p in self.parts]
        d = np.sqrt(squared(self.coarse, self.coarse))
        np.fill_diagonal(d, 1.0)
        self.between = np.maximum(d, 1e-12)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of the residual's part that the codes miss)."""
        at = nearest(x, self.coarse)
        residual = x - self.coarse[at]
        codes = np.stack([nearest(residual[:, p], b) for p, b in zip(self.parts, self.books)], 1)
        for j, (p, b) in enumerate(zip(self.parts, self.books)):
            residual[:, p] -= b[codes[:, j]]
        return at, codes.astype(np.uint8), np.sqrt((residual * residual).sum(1))

    def probes(self, x: np.ndarray, at: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: lists whose cell comes within the radius of the vector."""
        d = squared(x, self.coarse)
        own = d[np.arange(len(x)), at]
        return np.nonzero((d - own[:, None]) / (2 * self.between[at]) <= radius + 1e-9)

    def distances(self, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries to the coded members of one list, by table look-up."""
        residual = queries - self.coarse[at]
        total = np.zeros((len(queries), len(codes)))
        for j, (p, b) in enumerate(zip(self.parts, self.books)):
            total += squared(residual[:, p], b)[:, codes[:, j]]
        return np.sqrt(total)


def unit(rows: list[bytes], kind: type) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def classes_of(vectors: DataFrame) -> DataFrame:
    """One row per label and distinct usable vector: cid, label, embedding, n, first_id."""
    return stored(vectors.where(F.col("label").isNotNull() & usable(F.col("embedding")))
                  .groupBy("label", "embedding")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
                  .withColumn("cid", F.monotonically_increasing_id()), "classes")


def links(classes: DataFrame, threshold: float = 0.98, sample_rows: int = 20_000,
          list_rows: int = 256, subspaces: int = 8, part_work: int = 1 << 25) -> DataFrame:
    """What the links between classes of one label (cosine >= threshold) come to: rows (a, b, null) are a
    spanning forest of them, and rows (a, null, n) add n linked vectors to class a.

    The quantiser of each vector length is fitted on at most ``sample_rows`` rows in all; every
    class is indexed. There is a list for every ``list_rows`` classes, as long as a list has 8 rows of the sample;
    beyond that lists grow, and are searched in more parts. ``part_work`` splits the queries of a list so that one task compares about
    that many pairs.
    """
    spark = classes.sparkSession
    n = classes.count()
    kind = np.float64 if classes.schema["embedding"].dataType.elementType == DoubleType() else np.float32
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    sample: dict[int, list] = {}
    for r in (classes.orderBy(F.xxhash64("embedding"), "cid").limit(sample_rows)
              .select("embedding").collect()):
        sample.setdefault(len(r[0]), []).append(np.array(r[0], kind).tobytes())
    lists = int(max(1, min(sample_rows // 8, n // list_rows)))
    model = spark.sparkContext.broadcast(
        {d: Quantiser(unit(x, kind), lists, subspaces, 256) for d, x in sample.items() if len(x) >= 16})

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cid, label, n_of = (batch.column(c).to_numpy() for c in ("cid", "label", "n"))
            column = batch.column("embedding")
            sizes = np.diff(column.offsets.to_numpy())
            values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), kind)
            ends = np.cumsum(sizes)
            for dim in np.unique(sizes).tolist():
                for rows in np.array_split(f := np.flatnonzero(sizes == dim), len(f) // 2000 + 1):
                    raw = [values[ends[i] - dim:ends[i]].tobytes() for i in rows.tolist()]
                    x, q = unit(raw, kind), model.value.get(dim)
                    if q is None:  # a rare vector length: one list, every member is compared
                        at, codes, miss = np.zeros(len(x), int), np.zeros((len(x), 0), np.uint8), np.zeros(len(x))
                        row, probe = np.arange(len(x)), at
                    else:
                        at, codes, miss = q.encode(x)
                        row, probe = q.probes(x, at, radius)
                        onward = probe >= at[row]
                        row, probe = row[onward], probe[onward]
                    yield pa.RecordBatch.from_pydict({
                        "label": pa.array(np.concatenate([label[rows], label[rows[row]]]), pa.int32()),
                        "dim": pa.array(np.full(len(x) + len(row), dim), pa.int32()),
                        "list": pa.array(np.concatenate([at, probe]), pa.int32()),
                        "member": pa.array(np.arange(len(x) + len(row)) < len(x)),
                        "home": pa.array(np.concatenate([np.ones(len(x), bool), probe == at[row]])),
                        "cid": pa.array(np.concatenate([cid[rows], cid[rows[row]]]), pa.int64()),
                        "n": pa.array(np.concatenate([n_of[rows], n_of[rows[row]]]), pa.int64()),
                        "vector": pa.array(raw + [raw[i] for i in row.tolist()], pa.binary()),
                        "codes": pa.array([c.tobytes() for c in codes] + [None] * len(row), pa.binary()),
                        "miss": pa.array(np.concatenate([miss, np.zeros(len(row))]), pa.float64())})

    cell = ["label", "dim", "list"]
    entries = stored(mapped(classes.select("cid", F.col("label").cast("int"), "n", "embedding"), index,
                            "label int, dim int, list int, member boolean, home boolean, cid long, n long, "
                            "vector binary, codes binary, miss double"), "entries")
    # Large lists are searched in parts: each has some of the queries and some of the members.
    sizes = (entries.groupBy(*cell).agg(F.sum(F.col("member").cast("long")).alias("m"),
                                        F.count(F.lit(1)).alias("all"))
             .where("m > 0").select(*cell,
                                    F.ceil(F.col("m") / 8192).cast("int").alias("k"),
                                    F.ceil(F.least(F.col("m"), F.lit(8192)) * (F.col("all") - F.col("m"))
                                           / part_work).cast("int").alias("kq")))
    here = entries.join(sizes, cell)
    salt = F.pmod(F.xxhash64("cid"), F.when(F.col("member"), F.col("k")).otherwise(F.col("kq")))
    parts = here.withColumn("salt", salt.cast("int")).select(
        *cell, "member", "home", "cid", "n", "vector", "codes", "miss",
        F.explode(F.when(F.col("member"), F.transform(F.sequence(F.lit(0), F.col("kq") - 1),
                                                      lambda j: F.struct(F.col("salt").alias("m"), j.alias("q"))))
                  .otherwise(F.transform(F.sequence(F.lit(0), F.col("k") - 1),
                                         lambda j: F.struct(j.alias("m"), F.col("salt").alias("q"))))).alias("part"))

    def search(table: pa.Table) -> pa.Table:
        member, home = table["member"].to_numpy(), table["home"].to_numpy()
        cid, n_of, miss = (table[c].to_numpy() for c in ("cid", "n", "miss"))
        raw = table["vector"].to_pylist()
        m, q = np.flatnonzero(member), np.flatnonzero(~member)
        counts = np.zeros(len(raw), np.int64)
        a = b = np.zeros(0, np.int64)
        if len(m) and len(q):
            quantiser = model.value.get(table["dim"][0].as_py())
            at = table["list"][0].as_py()
            x, y = unit([raw[i] for i in m], kind), unit([raw[i] for i in q], kind)
            codes = np.frombuffer(b"".join(table["codes"].take(pa.array(m)).to_pylist()), np.uint8).reshape(len(m), -1)
            for i in range(0, len(q), 256):
                part = y[i:i + 256]
                # In its own list a vector meets each other one once, the one with the larger number.
                near = ~home[q[i:i + 256], None] | (cid[q[i:i + 256], None] < cid[None, m])
                if quantiser is not None:
                    near &= quantiser.distances(part, at, codes) <= radius + miss[None, m]
                u, v = np.nonzero(near)
                for j in range(0, len(u), 1 << 15):
                    s, t = q[i + u[j:j + (1 << 15)]], m[v[j:j + (1 << 15)]]
                    hit = exact_cosine([raw[k] for k in s], [raw[k] for k in t], kind) >= threshold
                    s, t = s[hit], t[hit]
                    np.add.at(counts, s, n_of[t])
                    np.add.at(counts, t, n_of[s])
                    a, b = stars(np.concatenate([a, cid[s]]), np.concatenate([b, cid[t]]))
        some = np.flatnonzero(counts)
        return pa.table({"a": pa.array(np.concatenate([a, cid[some]]), pa.int64()),
                         "b": pa.array(b.tolist() + [None] * len(some), pa.int64()),
                         "links": pa.array([None] * len(a) + counts[some].tolist(), pa.int64())})

    return (parts.groupBy(*cell, F.col("part.m").alias("pm"), F.col("part.q").alias("pq"))
            .applyInArrow(search, "a long, b long, links long"))


def exact_cosine(x: list[bytes], y: list[bytes], kind: type) -> np.ndarray:
    """Cosine in double precision, pair by pair."""
    x, y = (np.frombuffer(b"".join(v), kind).reshape(len(v), -1).astype(np.float64) for v in (x, y))
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def embedding_dedup(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", **search) -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest vec_id reachable by links), kept.

    Null, zero or non-finite vectors, vectors with null components and rows without label link
    with nothing (n_links 0, their own component); vectors of different lengths never link.
    Repeated rows are linked vectors of their own; a null vec_id takes part (its component is
    null only without any id); an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).alias("embedding"), F.col(label_col).alias("label"))
    classes = classes_of(rows)
    found = stored(links(classes, threshold, **search), "links")
    partners = found.where("b is null").groupBy("a").agg(F.sum("links").alias("n_partners"))
    roots = components(found.where("b is not null").select("a", "b"))
    rooted = (classes.join(roots, classes.cid == roots.node, "left")
              .withColumn("root", F.coalesce("root", "cid")))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = (rooted.join(lowest, "root").join(partners, rooted.cid == partners.a, "left")
              .select("label", "embedding", "component_id",
                      (F.col("n") - 1 + F.coalesce("n_partners", F.lit(0))).alias("n_links"))
              .where("n_links > 0"))
    spread = linked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int"))
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (salted.join(spread, ["label", "embedding", "salt"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (
  SELECT vec_id AS u, vec_id AS w FROM embeddings
  UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.u = e.vec_id) AS n_links,
       (SELECT min(w) FROM r WHERE r.u = e.vec_id) AS component_id,
       e.vec_id = (SELECT min(w) FROM r WHERE r.u = e.vec_id) AS kept
FROM embeddings e
"""
