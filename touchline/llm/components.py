"""Connected components of an edge table, without collecting it.

Edges are first contracted inside each task (a spanning forest of the edges it holds, as stars),
then large-star and small-star rounds join every node to the smallest node of its component.
Every round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import mapped, stored


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component), for the nodes of these edges that aren't smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        np.minimum.at(label, before, label.copy())
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def contracted(edges: DataFrame) -> DataFrame:
    """The edges (a, b) of each task as stars (a greater than b)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.zeros(0, np.int64)
        for batch in batches:
            a, b = stars(np.concatenate([a, batch.column(0).to_numpy()]),
                         np.concatenate([b, batch.column(1).to_numpy()]))
            if len(a) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                a = b = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return mapped(edges, rows, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root): for every node of an edge (a, b) that isn't the smallest of its
    component, that smallest node."""
    now = stored(contracted(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), "edges")
    mark = None
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        # Large star: neighbours above a node move to its smallest neighbour (or itself).
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        now = stored(small, "edges")
        found = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")
                                                            ).alias("h")).first()
        if tuple(found) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(found)
