"""Ledger against lake: one dated report of every scraped partition and whether its file exists."""

from __future__ import annotations

import datetime
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapstrata.operators.audit import ledger_lake_audit
from snapstrata.operators.ledger import recent_scrapes
from snapstrata.operators.metrics import observed_counts
from snapstrata.sources import versions
from snapstrata.sources.ledger_store import read_ledger, write_audit_csv
from snapstrata.sources.listing import partition_listing, read_inventory, refresh_inventory

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class AuditReport:
    path: str
    rows: int
    missing: int


def audit_report(
    ledger: DataFrame, listing: DataFrame, reports_path: str, report_date: datetime.date | str, newest: int | None = None
) -> AuditReport:
    """Write the audit of ``ledger`` against ``listing(path)`` as CSV below the date, and count it on the way.

    ``newest`` restricts the report to so many of the latest scrapes, in one file. A report of the
    same date is replaced.
    """
    rows = ledger
    if newest is not None:
        rows = ledger.join(recent_scrapes(ledger, newest).select("id"), "id", "left_semi")
    seen = Observation("audit")
    report = ledger_lake_audit(rows, listing).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("exists")).alias("missing")
    )
    path = f"{reports_path.rstrip('/')}/report_date={report_date}"
    write_audit_csv(report, path, single_file=newest is not None)
    counts = observed_counts(seen)
    found = AuditReport(path, counts.get("rows", 0), counts.get("missing", 0))
    log.info("audit of %s: %d partitions, %d without a file", report_date, found.rows, found.missing)
    if found.missing:
        log.warning("%d scraped partitions have no file", found.missing)
    return found


def refresh_audit(
    spark: SparkSession,
    ledger_root: str,
    inventory_root: str,
    base_path: str,
    reports_path: str,
    report_date: datetime.date | str,
    newest: int | None = None,
) -> AuditReport:
    """Bring the inventory up to date and audit the stored ledger against it, in one call."""
    held = versions.current_version(spark, ledger_root)
    if held is None:
        raise ValueError(f"no ledger at {ledger_root}; store one with start_ledger")
    refresh_inventory(spark, inventory_root, base_path)
    present = partition_listing(read_inventory(spark, inventory_root))
    return audit_report(read_ledger(spark, held.path), present, reports_path, report_date, newest)
