"""Ledger against the files that exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.functions.paths import partition_path, path_prefix, path_snapshot
from snapstrata.operators.ledger import completed_date_projection, scraped_partitions
from snapstrata.session import kept


def expected_paths(ledger: DataFrame, root: str = "bronze") -> DataFrame:
    """Scraped ledger rows with the path their file should have."""
    rows = completed_date_projection(scraped_partitions(ledger))
    return rows.withColumn(
        "path",
        partition_path(
            F.col("event_id"), F.col("region_abbr"), F.col("map_name"), F.col("agent"),
            F.col("snapshot_date"), root,
        ),
    )


def ledger_lake_audit(ledger: DataFrame, listing: DataFrame, root: str = "bronze") -> DataFrame:
    """One row per scraped ledger row: does its file exist?"""
    present = listing.select(F.col("path").alias("_present")).distinct()
    rows = expected_paths(ledger, root)
    return rows.join(present, rows["path"] == present["_present"], "left").select(
        "id", "event_id", "map_name", F.col("region_abbr").alias("region"), "agent",
        "snapshot_date", "path", F.col("_present").isNotNull().alias("exists"),
    )


def missing_partitions(ledger: DataFrame, listing: DataFrame, root: str = "bronze") -> DataFrame:
    """Marked as scraped, but no file."""
    return expected_paths(ledger, root).join(listing.select("path"), "path", "left_anti")


def orphan_partitions(ledger: DataFrame, listing: DataFrame, root: str = "bronze") -> DataFrame:
    """Files whose partition the ledger does not have as scraped."""
    known = expected_paths(ledger, root).select("path")
    return listing.select("path").distinct().join(known, "path", "left_anti")


def snapshot_files(listing: DataFrame) -> DataFrame:
    """``prefix, snapshot_date, path`` of the files that lie below a snapshot."""
    return listing.select(
        path_prefix(F.col("path")).alias("prefix"),
        path_snapshot(F.col("path")).alias("snapshot_date"),
        "path",
    ).where(F.col("snapshot_date") != "")


def snapshot_file_groups(listing: DataFrame, prefixes: DataFrame | None = None) -> DataFrame:
    """Files per prefix and snapshot: one row per file, with its group's size.

    Rows rather than a list per group, so that no task ever holds a whole
    group. The listing is read once, cut to the files wanted and kept; counts and rows
    come from there. The counts are unique on the join key; a hot group is split by the
    skew join. ``prefixes(prefix)`` restricts the report, with or without a slash at the
    end; one without files is a row of its own, with no date, no path and 0 files.
    """
    files = snapshot_files(listing)
    if prefixes is None:
        return _with_group_size(kept(files, "snapshot-files"))
    asked = prefixes.select(F.regexp_replace("prefix", "/+$", "").alias("prefix")).distinct()
    groups = _with_group_size(kept(files.join(asked, "prefix", "left_semi"), "snapshot-files"))
    return asked.join(groups, "prefix", "left").select(
        "prefix", "snapshot_date", "path", F.coalesce("n_files", F.lit(0)).alias("n_files")
    )


def _with_group_size(files: DataFrame) -> DataFrame:
    group = ["prefix", "snapshot_date"]
    return files.join(files.groupBy(*group).agg(F.count(F.lit(1)).alias("n_files")), group)
