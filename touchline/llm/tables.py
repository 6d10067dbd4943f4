"""Reading inputs and writing intermediate tables to the shared work folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.session import work_root


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder of this run under ``spark.checkpoint.dir``."""
    return f"{work_root(spark)}/touchline-llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a later executor loss re-reads files instead of repeating the work.
    """
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores before it as make it none of the caller's."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def whole(text: Column | str) -> Column:
    """The text with null read as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most_bytes`` (one row at least), so that what a task
    makes of a batch stays small whatever the texts' lengths."""
    for batch in batches:
        step = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def lean(fn: Callable) -> Callable:
    """``fn`` over a task's batches, where freed memory goes back to the system before and after:
    Python workers outlive their tasks, and what their allocators keep adds up over stages."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from fn(batches)
        give_back()
    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # the C library may lack it
        trim(0)


_SHIPPED: set[str] = set()


def mapped(df: DataFrame, fn: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with this package shipped to the executors by Spark (once a session),
    so that a session needs no ``--py-files``."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).parent.parent
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in package.rglob("*.py"):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(fn, schema)
