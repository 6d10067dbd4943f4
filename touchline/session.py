"""Session creation and the shared work folder."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "touchline", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with UTC as the session time zone.

    Spark 4 already enables adaptive execution, partition coalescing and skew-join
    handling, so nothing of that is repeated here. The UI stays off: no port is opened.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.sources.partitionOverwriteMode", "dynamic"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return tune(builder.getOrCreate())


# Session settings the pipeline relies on. Message texts take some thirty times their stored size in memory: a
# task reads so little that its rows fit there, and the files of a table's days are written side by side
# instead of sorting whole messages by day first. Texts repeat themselves, which zstd stores in less than snappy.
TUNING = {"spark.sql.session.timeZone": "UTC",
          "spark.sql.files.maxPartitionBytes": str(16 << 20),
          "spark.sql.maxConcurrentOutputFileWriters": "64",
          "spark.sql.parquet.compression.codec": "zstd"}


def session_key(spark: SparkSession) -> tuple:
    """Identifies a live session (a stopped one's object id may be reused)."""
    try:
        return (id(spark), spark.sparkContext.applicationId)
    except Exception:  # noqa: BLE001
        return (id(spark), spark.conf.get("spark.app.id", ""))


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``TUNING`` to a session (runtime SQL settings only)."""
    for k, v in TUNING.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def release(spark: SparkSession) -> None:
    """Collect garbage on the driver: Spark deletes the shuffle files of ended jobs when it no longer holds
    their plans, and a driver with memory to spare holds them for long. Twice, as one pass leaves the newest plan;
    frames that Python has just dropped can take a second more."""
    gc.collect()
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, stream checkpoints and landed files.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system). Only when the
    session has none (local tests) a folder is created and registered as the checkpoint
    directory, so ``DataFrame.checkpoint()`` and our tables agree on one place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = getattr(spark, "sparkContext", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="touchline-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root.rstrip("/")
