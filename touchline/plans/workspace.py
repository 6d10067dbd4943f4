"""Where a demo run keeps its tables: a folder under the shared work root per session and input.

Landing the demo records and replaying them are idempotent: records are written once
(a ``_SUCCESS`` marker says so) and a stream re-run with its checkpoint reads nothing it
has read before.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession

from touchline.config import Settings
from touchline.files import exists, fs_path, publish_folder
from touchline.session import release, work_root
from touchline.sources.demo import late_records, log_stretches
from touchline.sources.stream import StreamSource


def input_state(spark: SparkSession, sf_dir: str) -> str:
    """Changes when a file of the input folder is replaced (path, size or time)."""
    fs, p = fs_path(spark, sf_dir)
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()[:12]


def demo_root(spark: SparkSession, sf_dir: str) -> str:
    """The work folder of this session for this state of the input: stored runs are never
    reused by another process, whose code or input may differ."""
    app = spark.sparkContext.applicationId
    return f"{work_root(spark)}/touchline-demo/{app}-{input_state(spark, sf_dir)}"


def land(spark: SparkSession, sf_dir: str, data_type: str, root: str) -> str:
    """Write the demo broker records of one topic as files (once)."""
    path = f"{root}/landing/{data_type}"
    if not exists(spark, f"{path}/_SUCCESS"):
        # Written aside and moved into place: two processes landing the same topic at once
        # never see each other's half-written files.
        tmp = f"{root}/landing/.{data_type}-{uuid.uuid4().hex[:12]}"
        # Files hold contiguous, time-ordered stretches of the log, as a topic partition would.
        log_stretches(spark, sf_dir, data_type).write.mode("overwrite").parquet(tmp)
        release(spark)
        if not publish_folder(spark, tmp, path) and not exists(spark, f"{path}/_SUCCESS"):
            raise RuntimeError(f"{path} holds an incomplete landing: remove it and run again")
    return path


def land_late(spark: SparkSession, sf_dir: str, root: str, folder: str) -> str:
    """Write the records that arrive after all others (once), beside the landed ones, into a folder that
    belongs to one reader: it must not see them before its first run."""
    path = f"{root}/{folder}/livescores"
    if not exists(spark, f"{path}/_SUCCESS"):
        tmp = f"{root}/{folder}/.livescores-{uuid.uuid4().hex[:12]}"
        late_records(spark, sf_dir).write.parquet(tmp)
        if not publish_folder(spark, tmp, path) and not exists(spark, f"{path}/_SUCCESS"):
            raise RuntimeError(f"{path} holds an incomplete landing: remove it and run again")
    return path


def replay_sources(spark: SparkSession, sf_dir: str, settings: Settings,
                   types=("fixtures", "livescores", "leagues", "events"),
                   max_files: int | None = None) -> dict[str, StreamSource]:
    return {t: StreamSource(kind="files", path=land(spark, sf_dir, t, settings.root),
                            max_per_trigger=max_files) for t in types}
