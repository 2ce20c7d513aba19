"""Directory moves and small files on whatever file system the cluster shares.

Only names and notes of versions are touched here; the data is written by Spark jobs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def delete(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    path, fs = _path(spark, source)
    goal, _ = _path(spark, target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(path, goal):
        raise OSError(f"could not move {source} to {target}")


def create_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a small new file; one that exists is left alone and is an error."""
    path, fs = _path(spark, name)
    if fs.exists(path):
        raise FileExistsError(name)
    stream = fs.create(path, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def read_text(spark: SparkSession, name: str) -> str:
    """A small file as text."""
    path, fs = _path(spark, name)
    if not fs.exists(path):
        raise FileNotFoundError(name)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def children(spark: SparkSession, name: str) -> list[str]:
    path, fs = _path(spark, name)
    if not fs.exists(path):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(path)]


def sibling(name: str, tag: str) -> str:
    """A fresh hidden name beside a directory."""
    parent, _, last = name.rstrip("/").rpartition("/")
    return f"{parent}/.{last}.{tag}.{uuid.uuid4().hex}"


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished directory in place; the previous one returns on failure."""
    backup = None
    if exists(spark, target):
        backup = sibling(target, "backup")
        move(spark, target, backup)
    try:
        move(spark, staged, target)
    except BaseException:
        if backup is not None:
            move(spark, backup, target)
        raise
    if backup is not None:
        delete(spark, backup)
