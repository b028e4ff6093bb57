"""Folders in the file system of a table's path: what is in them, marks, removal."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries; none if there is no such folder."""
    system, place = _located(spark, path)
    if not system.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(place))


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, there at once or not at all."""
    system, place = _located(spark, path)
    system.create(place, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """The folder or file and all below it; nothing if it is not there."""
    system, place = _located(spark, path)
    system.delete(place, True)
