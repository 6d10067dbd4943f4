"""Tables as snapshots: run folders, and a pointer that is written last.

A run writes its rows into a folder of its own, which nobody reads yet. The commit then adds one small file
that names the partition folders of the table from now on: the new ones, and the old ones that
the run does not own. Readers look that file up once and read just those folders, so they see the
table before a run or after it, never between; a run that dies before its commit has changed
nothing. Folders that no kept pointer names are removed by ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from touchline.files import children, delete, exists, partition_folders, publish_file, read_text

POINTERS = "_snapshots"


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: its folders (below ``base``) with their partition values."""

    version: int
    schema: StructType
    base: str
    parts: dict[str, dict[str, str]] = field(default_factory=dict)
    tags: dict[str, object] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "base": self.base, "parts": self.parts,
                           "tags": self.tags})


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in children(spark, f"{path}/{POINTERS}") if n.endswith(".json"))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest (or the given) version of the table at ``path``; None if it has none."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    found = json.loads(read_text(spark, f"{path}/{POINTERS}/{version:012d}.json"))
    return Snapshot(version, StructType.fromJson(found["schema"]), found["base"], found["parts"], found["tags"])


def read_snapshot(spark: SparkSession, snap: Snapshot, fmt: str = "parquet",
                  only: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
    """The rows of a version, or of those of its partitions that ``only`` names."""
    folders = [f for f, values in snap.parts.items() if only is None or only(values)]
    if not folders:
        return spark.createDataFrame([], snap.schema)
    return (spark.read.schema(snap.schema).option("basePath", snap.base).format(fmt)
            .load([f"{snap.base}/{f}" for f in folders]).select(*snap.schema.names))


def new_run(base: str) -> str:
    """The folder name of a new run; the letter keeps it from being read as a number."""
    return f"run=r{uuid.uuid4().hex[:16]}"


def table_schema(df: DataFrame, partition_by: Sequence[str]) -> StructType:
    """Columns as a partitioned table is read: partition columns last, all nullable."""
    fields = {f.name: StructField(f.name, f.dataType, True) for f in df.schema}
    return StructType([f for n, f in fields.items() if n not in partition_by] + [fields[n] for n in partition_by])


def commit(spark: SparkSession, path: str, schema: StructType, base: str, folder: str, depth: int,
           owned: Callable[[dict[str, str]], bool] | None = None, extra: dict[str, str] | None = None,
           tags: dict[str, object] | None = None) -> Snapshot:
    """Point the table at ``path`` to the partitions of the run ``folder`` (``depth`` folders deep) and to
    the old ones that the run neither owns nor has written again.

    ``extra`` are partition values that the folders themselves don't show. Another commit in between
    takes this version number first, and this one raises.
    """
    old = snapshot(spark, path)
    found = partition_folders(spark, f"{base}/{folder}", depth)
    new = {f"{folder}/{f}".rstrip("/"): v | (extra or {}) for f, v in found.items()}
    written = [json.dumps(v, sort_keys=True) for v in new.values()]
    kept = {f: v for f, v in (old.parts if old else {}).items()
            if json.dumps(v, sort_keys=True) not in written and not (owned and owned(v))}
    if kept and old.base != base:
        raise ValueError(f"{path} has its rows in {old.base}, not in {base}")
    snap = Snapshot((old.version if old else 0) + 1, schema, base, kept | new, tags or {})
    publish_file(spark, f"{path}/{POINTERS}/{snap.version:012d}.json", snap.text())
    return snap


def vacuum(spark: SparkSession, paths: Iterable[str], base: str, keep: int = 3, older_seconds: int = 86_400) -> list[str]:
    """Remove pointers but the ``keep`` newest of each table in ``paths``, and the run folders in ``base`` that
    no remaining pointer names and that are older than ``older_seconds`` (younger ones may be
    runs that have yet to commit). ``paths`` must be all tables with rows in ``base``."""
    named = set()
    for path in paths:
        known = versions(spark, path)
        for v in known[:-keep]:
            delete(spark, f"{path}/{POINTERS}/{v:012d}.json")
        for v in known[-keep:]:
            named |= {f.split("/")[0] for f in snapshot(spark, path, v).parts}
    gone = [f for f in children(spark, base, older_seconds) if f.startswith("run=") and f not in named]
    for f in gone:
        delete(spark, f"{base}/{f}")
    return gone


def has_snapshot(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{POINTERS}")
