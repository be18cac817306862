"""Bronze to Silver for one snapshot date."""

from __future__ import annotations

import datetime
import logging

from pyspark.sql import Observation, SparkSession

from snapstrata.operators.cleaning import silver_transform
from snapstrata.operators.metrics import observe_nulls, observe_rows, observed_counts
from snapstrata.schemas import PIPELINE_VERSION
from snapstrata.sources.lake import read_bronze, write_silver

log = logging.getLogger(__name__)


def refresh_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    snapshot_date: datetime.date | str | None,
    version: str = PIPELINE_VERSION,
    newest_file_wins: bool = True,
) -> dict[str, int]:
    """Clean one snapshot in a single pass and return its counts.

    ``None`` as the date takes all snapshots. The counts are observed while
    the write runs; they inform and never fail the job.
    """
    read, written = Observation("read"), Observation("written")
    bronze = read_bronze(spark, bronze_path, snapshot_date, with_version=newest_file_wins)
    silver = silver_transform(
        observe_rows(bronze, read), version, "_row_version" if newest_file_wins else None
    )
    write_silver(observe_nulls(silver, written), silver_path)

    before, after = observed_counts(read), observed_counts(written)
    counts = {"rows_read": before.get("rows", 0), "rows_written": after.get("rows", 0)}
    nulls = {c: n for c, n in after.items() if c != "rows" and n > 0}
    log.info("snapshot %s: %s", snapshot_date, counts)
    for column, count in nulls.items():
        log.warning("nulls in %s: %d", column, count)
    return counts | {f"nulls_{c}": n for c, n in nulls.items()}
