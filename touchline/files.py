"""Folders of stored tables, through the session's Hadoop file systems."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def fs_path(spark: SparkSession, path: str):
    """(file system, path object) of a folder or file."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = fs_path(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str, older_seconds: int = 0) -> list[str]:
    """Names in a folder (none if there is no such folder) that are at least so old."""
    fs, p = fs_path(spark, path)
    if not fs.exists(p):
        return []
    latest = (time.time() - older_seconds) * 1000
    return [s.getPath().getName() for s in fs.listStatus(p) if s.getModificationTime() <= latest or not older_seconds]


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = fs_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside and rename it into place; raises if it is there already."""
    fs, target = fs_path(spark, path)
    _, aside = fs_path(spark, f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex[:12]}")
    fs.mkdirs(target.getParent())
    out = fs.create(aside, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise RuntimeError(f"{path} is there already: another writer was first")


def publish_folder(spark: SparkSession, tmp: str, path: str) -> bool:
    """Move a finished folder into place; False if another writer got there first."""
    fs, src = fs_path(spark, tmp)
    _, dst = fs_path(spark, path)
    if fs.exists(dst):
        return False
    fs.mkdirs(dst.getParent())
    return bool(fs.rename(src, dst))


def partition_folders(spark: SparkSession, path: str, depth: int) -> dict[str, dict[str, str]]:
    """Relative folder -> partition values, for the partitions of a table stored ``depth`` deep."""
    fs, root = fs_path(spark, path)
    found = {"": {}} if fs.exists(root) else {}
    for _ in range(depth):
        deeper = {}
        for folder, values in found.items():
            for s in fs.listStatus(fs_path(spark, f"{path}/{folder}")[1]):
                name, eq, value = s.getPath().getName().partition("=")
                if s.isDirectory() and eq:
                    deeper[f"{folder}/{name}={value}".lstrip("/")] = values | {name: value}
        found = deeper
    return found


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, p = fs_path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0
