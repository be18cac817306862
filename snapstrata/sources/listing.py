"""What files a lake holds: listed at once, or kept as an inventory."""

from __future__ import annotations

import datetime
import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapstrata.functions.paths import below_root
from snapstrata.operators.metrics import observed_counts
from snapstrata.sources import folders, versions
from snapstrata.sources.versions import Version

INVENTORY_SCHEMA = "prefix string, path string, length bigint, modified_at timestamp"
#: Files that a task hands on at once.
LISTED_AT_ONCE = 4096


def lake_listing(spark: SparkSession, base_path: str, pattern: str = "*.csv") -> DataFrame:
    """``path, length, modified_at`` of the files below ``base_path``, listed by Spark.

    File contents are never read: only these three columns are selected. The driver holds all
    files while it plans; for a lake of very many use ``refresh_inventory``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(base_path)
    )
    return files.select("path", "length", F.col("modificationTime").alias("modified_at"))


def lake_prefixes(spark: SparkSession, base_path: str, levels: int = 2) -> DataFrame:
    """``prefix`` of every folder ``levels`` below the lake, the unit in which tasks list.

    Only these outer levels, events and regions by default, are looked at by the driver.
    """
    found = [""]
    for _ in range(levels):
        found = [
            f"{prefix}{name}/"
            for prefix in found
            for name in folders.names(spark, f"{base_path.rstrip('/')}/{prefix}")
            if not name.startswith(("_", "."))
        ]
    return spark.createDataFrame([(p.rstrip("/"),) for p in found], "prefix string")


def listed_by_tasks(prefixes: DataFrame, base_path: str, pattern: str = "*.csv") -> DataFrame:
    """``prefix, path, length, modified_at`` of the files below each prefix, one task per prefix.

    A task walks folder by folder and hands its files on as it goes, so it never holds a prefix. A
    prefix that does not exist has no files.
    """
    base = base_path.rstrip("/")

    def walk(prefix: str) -> Iterator[dict]:
        system, root = fs.FileSystem.from_uri(base if "://" in base or base.startswith("file:") else f"file://{base}")
        waiting = [f"{root.rstrip('/')}/{prefix}" if prefix else root.rstrip("/")]
        while waiting:
            for info in system.get_file_info(fs.FileSelector(waiting.pop(), allow_not_found=True)):
                if info.base_name.startswith(("_", ".")):
                    continue
                if info.type == fs.FileType.Directory:
                    waiting.append(info.path)
                elif fnmatch.fnmatch(info.base_name, pattern):
                    path = f"{base}/{info.path[len(root.rstrip('/')) + 1 :]}"
                    yield {"prefix": prefix, "path": path, "length": info.size, "modified_at": info.mtime}

    schema = pa.schema(
        [("prefix", pa.string()), ("path", pa.string()), ("length", pa.int64()),
         ("modified_at", pa.timestamp("us", "UTC"))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = []
        for batch in batches:
            for prefix in batch.column("prefix").to_pylist():
                for file in walk(prefix):
                    files.append(file)
                    if len(files) >= LISTED_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(files, schema)
                        files = []
        yield pa.RecordBatch.from_pylist(files, schema)

    asked = prefixes.select("prefix").distinct()
    # Neighbouring prefixes differ in size; each is a task's work of its own.
    spread = asked.repartition(asked.sparkSession.sparkContext.defaultParallelism * 4, "prefix")
    return spread.mapInArrow(run, INVENTORY_SCHEMA)


@dataclass(frozen=True)
class InventoryRefresh:
    version: Version
    new: int
    gone: int
    changed: int


def merged_inventory(held: DataFrame, fresh: DataFrame, asked: DataFrame) -> DataFrame:
    """The inventory after a fresh listing of the prefixes ``asked``, with ``state`` of each file.

    ``state`` is ``new``, ``gone``, ``changed`` or ``same``; files of other prefixes are ``same``.
    """
    old = held.join(asked.select("prefix").distinct(), "prefix", "left_semi").withColumnsRenamed(
        {"prefix": "_prefix", "path": "_path", "length": "_length", "modified_at": "_modified"}
    )
    both = fresh.join(old, F.col("path") == F.col("_path"), "full_outer")
    differs = (F.col("length") != F.col("_length")) | (F.col("modified_at") != F.col("_modified"))
    state = (
        F.when(F.col("_path").isNull(), "new").when(F.col("path").isNull(), "gone").when(differs, "changed").otherwise("same")
    )
    listed = both.select(
        F.coalesce("prefix", "_prefix").alias("prefix"), F.coalesce("path", "_path").alias("path"),
        F.coalesce("length", "_length").alias("length"), F.coalesce("modified_at", "_modified").alias("modified_at"),
        state.alias("state"),
    )
    others = held.join(asked.select("prefix").distinct(), "prefix", "left_anti")
    return listed.unionByName(others.withColumn("state", F.lit("same")).select(*listed.columns))


def refresh_inventory(
    spark: SparkSession, root: str, base_path: str, prefixes: DataFrame | None = None, pattern: str = "*.csv"
) -> InventoryRefresh:
    """List the lake, or the prefixes given, and write the next version of the inventory at ``root``.

    What is listed comes from tasks and goes into the stored table by a join, so the driver sees
    counts only. All prefixes that are there or were there are listed by default.
    """
    held = versions.current_version(spark, root)
    before = spark.createDataFrame([], INVENTORY_SCHEMA)
    if held is not None:
        before = spark.read.schema(INVENTORY_SCHEMA).parquet(held.path)
    asked = prefixes
    if asked is None:
        asked = lake_prefixes(spark, base_path).unionByName(before.select("prefix")).distinct()
    merged = merged_inventory(before, listed_by_tasks(asked, base_path, pattern), asked)
    seen = Observation("inventory")
    states = {s: F.count_if(F.col("state") == s).alias(s) for s in ("new", "gone", "changed")}
    observed = merged.observe(seen, *states.values())
    number = 0 if held is None else held.number + 1
    versions.write_version(root, number, observed.where(F.col("state") != "gone").drop("state"))
    counts = observed_counts(seen)
    version = versions.commit_version(spark, root, number, datetime.datetime.now(datetime.UTC).isoformat())
    versions.drop_versions(spark, root)
    return InventoryRefresh(version, *[counts.get(s, 0) for s in ("new", "gone", "changed")])


def read_inventory(spark: SparkSession, root: str) -> DataFrame:
    """The inventory in force, for the audit operators: they take any table with a ``path``."""
    held = versions.current_version(spark, root)
    if held is None:
        raise ValueError(f"no inventory at {root}; make one with refresh_inventory")
    return spark.read.schema(INVENTORY_SCHEMA).parquet(held.path)


def partition_listing(listing: DataFrame, root: str = "bronze") -> DataFrame:
    """Distinct logical object paths, whatever names the part files have."""
    folder = F.regexp_replace(below_root(F.col("path")), "/[^/]+$", "")
    return listing.select(
        F.concat(F.lit(f"{root}/"), folder, F.lit("/data.csv")).alias("path")
    ).distinct()
