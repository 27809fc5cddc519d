"""Folders on the shared storage, through Spark's Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _located(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    system, where = _located(spark, path)
    system.delete(where, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    system, where = _located(spark, path)
    system.create(where, True).close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to where nothing is yet."""
    system, where = _located(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(to.getParent())
    if not system.rename(where, to):
        raise OSError(f"could not move {source} to {target}")


def folders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths below ``root``, relative to it, that fit a glob pattern."""
    system, where = _located(spark, f"{root}/{pattern}")
    found = system.globStatus(where) or []
    depth = pattern.count("/") + 1
    return sorted("/".join(str(f.getPath()).split("/")[-depth:]) for f in found)
