"""Hadoop file-system calls the writers need (rename, delete, exists)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    _, t = _fs(spark, target)
    if not fs.rename(p, t):
        raise OSError(f"could not rename {source} to {target}")


def folders(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return [s.getPath().toString() for s in (fs.globStatus(p) or []) if s.isDirectory()]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, which is no pattern."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def newest_file(spark: SparkSession, pattern: str) -> str | None:
    """Greatest path matching a glob, from a listing of names only."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    names = [s.getPath().toString() for s in (found or []) if s.isFile()]
    return max(names, default=None)


def any_file(spark: SparkSession, pattern: str) -> bool:
    fs, p = _fs(spark, pattern)
    return bool(fs.globStatus(p))


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0
