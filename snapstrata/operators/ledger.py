"""Ingestion ledger: which partitions are pending, which are done, and marking them."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Batch size of the dispatcher and of the audit report.
DISPATCH_BATCH = 200
AUDIT_LIMIT = 500


def pending_partitions(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("is_completed") & ~F.col("is_scrapped"))


def scraped_partitions(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("is_completed") & F.col("is_scrapped"))


def pending_batch(ledger: DataFrame, size: int = DISPATCH_BATCH) -> DataFrame:
    """First pending rows by id; a distributed top-k, not a sort of the table."""
    return pending_partitions(ledger).orderBy("id").limit(size)


def recent_scrapes(ledger: DataFrame, size: int = AUDIT_LIMIT) -> DataFrame:
    """Newest scrapes first, nulls placed as the ledger's database places them.

    ``id`` ends the order so that the cut is total.
    """
    order = [F.col("last_scraped").desc_nulls_first()]
    for c in ("event_id", "map_id", "map_name", "region_abbr", "agent", "id"):
        order.append(F.col(c).asc_nulls_last())
    return completed_date_projection(scraped_partitions(ledger)).orderBy(*order).limit(size)


def typed_job_projection(jobs: DataFrame) -> DataFrame:
    """The five columns a scrape needs; all text but the row id."""
    return jobs.select(
        F.col("id").cast("bigint").alias("row_id"),
        *[F.col(c).cast("string").alias(c) for c in ("event_id", "region_abbr", "map_id", "agent")],
    )


def dispatch_projection(jobs: DataFrame, snapshot_date: datetime.date) -> DataFrame:
    return jobs.select(
        F.col("id").alias("row_id"),
        "event_id",
        "map_id",
        "map_name",
        F.col("region_abbr").alias("region"),
        "agent",
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
    )


def completed_date_projection(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        "id", "event_id", "map_id", "map_name", "region_abbr", "agent",
        F.to_date("last_scraped").alias("snapshot_date"),
        "last_scraped",
    )


def map_dimension_join(jobs: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach ``map_name`` by ``map_id``; jobs with an unknown map fall out.

    No broadcast hint: the inline dimension has an exact size estimate, and a
    larger one supplied by the caller must stay free to shuffle.
    """
    return jobs.drop("map_name").join(dimension, "map_id", "inner")


def unknown_map_filter(jobs: DataFrame, dimension: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept with their map name, rejected because the map id is unknown)."""
    return (
        map_dimension_join(jobs, dimension),
        jobs.join(dimension.select("map_id"), "map_id", "left_anti"),
    )


def _mark(
    ledger: DataFrame, marks: DataFrame, chosen: Column, eligible: Column, with_named: bool
) -> DataFrame:
    # Grouping the marks first folds any number of repeats of an id in the map
    # tasks, so the join sees each id once and cannot multiply ledger rows.
    per_id = marks.groupBy(F.col("row_id").alias("_row_id")).agg(chosen.alias("_marked_at"))
    named = F.col("_row_id").isNotNull()
    changed = named & eligible
    columns = {
        "changed": changed,
        "is_scrapped": F.when(changed, F.lit(True)).otherwise(F.col("is_scrapped")),
        "last_scraped": F.when(changed, F.col("_marked_at")).otherwise(F.col("last_scraped")),
    }
    if with_named:
        columns["named"] = named
    joined = ledger.join(per_id, F.col("id") == F.col("_row_id"), "left")
    return joined.withColumns(columns).drop("_row_id", "_marked_at")


def mark_scraped_bulk(ledger: DataFrame, marks: DataFrame, with_named: bool = False) -> DataFrame:
    """Set flag and time for every id in ``marks(row_id, marked_at)``.

    A later mark of the same id moves its time forward. ``changed`` tells
    which rows were touched, ``named`` which ones a mark names.
    """
    return _mark(ledger, marks, F.max("marked_at"), F.lit(True), with_named)


def mark_scraped_guarded(ledger: DataFrame, marks: DataFrame, with_named: bool = False) -> DataFrame:
    """The same, but only rows completed and not yet scraped change.

    The first mark wins, because after it a row no longer qualifies.
    """
    open_row = F.coalesce(F.col("is_completed") & ~F.col("is_scrapped"), F.lit(False))
    return _mark(ledger, marks, F.min("marked_at"), open_row, with_named)


def observe_marks(marked: DataFrame, observation: Observation) -> DataFrame:
    """Counts rows ``changed``, and ``refused`` ones that a mark names in vain, while the table is written.

    Takes a table marked with ``with_named``; the counts cost no pass of their own.
    """
    return marked.observe(
        observation,
        F.count_if("changed").alias("changed"),
        F.count_if(F.col("named") & ~F.col("changed")).alias("refused"),
    )
