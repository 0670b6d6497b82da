"""File-system look-ups without a Spark job, on whatever store the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths for a glob pattern; an empty list when there are none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(matching(spark, path))
