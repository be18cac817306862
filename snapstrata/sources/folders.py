"""Folders of the file system that Spark writes to: names, existence, removal. Never file contents."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none where there is no folder."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it; nothing happens where there is none."""
    system, place = _opened(spark, path)
    system.delete(place, True)


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders called ``<prefix>=<number>`` below a folder, rising."""
    found = [n.removeprefix(f"{prefix}=") for n in names(spark, path) if n.startswith(f"{prefix}=")]
    return sorted(int(n) for n in found if n.lstrip("-").isdigit())


def finished(spark: SparkSession, path: str) -> bool:
    """Whether the write of a folder was committed as a whole."""
    return exists(spark, f"{path}/_SUCCESS")
