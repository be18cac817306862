"""Tables kept as numbered versions, each with a mark that says what it holds.

A version is written whole, in a folder of its own, and counts from the moment its
commit is there: a one-row table with the mark, written after it. A crash before that
leaves the earlier version in force, and the next attempt overwrites what was left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.sources import folders

COMMIT_SCHEMA = "mark string"


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    mark: str


def version_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/version={number}"


def _commit_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/commits/version={number}"


def current_version(spark: SparkSession, root: str) -> Version | None:
    """The newest committed version, or ``None``."""
    commits = f"{root.rstrip('/')}/commits"
    for number in reversed(folders.numbered(spark, commits, "version")):
        if folders.finished(spark, _commit_path(root, number)):
            mark = spark.read.schema(COMMIT_SCHEMA).parquet(_commit_path(root, number)).first()["mark"]
            return Version(number, version_path(root, number), mark)
    return None


def write_version(root: str, number: int, table: DataFrame) -> None:
    """Write a version that nobody reads yet, over what an earlier attempt may have left."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(version_path(root, number))


def commit_version(spark: SparkSession, root: str, number: int, mark: str) -> Version:
    row = spark.range(1).select(F.lit(mark).alias("mark")).coalesce(1)
    row.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_commit_path(root, number))
    return Version(number, version_path(root, number), mark)


def publish(spark: SparkSession, root: str, table: DataFrame, mark: str) -> Version:
    """Write the next version and put it in force."""
    held = current_version(spark, root)
    number = 0 if held is None else held.number + 1
    write_version(root, number, table)
    return commit_version(spark, root, number, mark)


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` committed versions, commits last.

    Readers that planned on an earlier version can finish while it is among those kept.
    """
    held = current_version(spark, root)
    if held is None:
        return
    for number in folders.numbered(spark, root, "version"):
        if number <= held.number - keep:
            folders.remove(spark, version_path(root, number))
    for number in folders.numbered(spark, f"{root.rstrip('/')}/commits", "version"):
        if number <= held.number - keep:
            folders.remove(spark, _commit_path(root, number))
