"""Folders on whatever store the cluster uses, through the file system that Spark itself reads them with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, sorted; none if it doesn't exist."""
    fs, where = _opened(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Names of the files directly under ``path`` that end with ``suffix``, sorted."""
    fs, where = _opened(spark, path)
    names = (s.getPath().getName() for s in fs.listStatus(where) if s.isFile())
    return sorted(n for n in names if n.endswith(suffix))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote ``path`` committed."""
    fs, _ = _opened(spark, path)
    return fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that doesn't exist is no error."""
    fs, where = _opened(spark, path)
    fs.delete(where, True)


def remove_uri(spark: SparkSession, uri: str) -> None:
    """Delete a folder named as Spark's file metadata names it, with escapes."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
