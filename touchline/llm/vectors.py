"""Reading vector columns: usable rows, and the integers floor(256 c) as matrices by length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256


def finite(vector: Column) -> Column:
    """Neither null nor with null or non-finite components (zero vectors count as finite)."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))),
                      F.lit(False))


def scaled(vector: Column) -> Column:
    """floor(256 c) of every component, as longs (beyond a long's range: its nearest end)."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(SCALE))))


def matrices(column: pa.ListArray, rows: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of longs) of each vector length, at most ``rows`` rows at a time."""
    sizes = np.diff(column.offsets.to_numpy())
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64)
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        for i in range(0, len(at), rows):
            part = at[i:i + rows]
            yield part, values[starts[part, None] + np.arange(dim)[None, :]].reshape(len(part), dim)
