"""Completion marks into the next version of the ledger.

The stream leaves a folder per batch. This job applies the marks of all whole batches
that the ledger does not hold yet, writes the next version of the ledger, commits it
with the last batch it holds as its mark, and only then removes the folders up to that
batch. Whatever step it stops at, running it again gives the same ledger: before the
commit the old version is in force, after it the batches left over are known to be held.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapstrata.operators.ledger import mark_scraped_bulk, mark_scraped_guarded, observe_marks
from snapstrata.operators.metrics import observed_counts
from snapstrata.schemas import LEDGER_COLUMNS
from snapstrata.sources import folders, versions
from snapstrata.sources.ledger_store import read_ledger
from snapstrata.sources.versions import Version
from snapstrata.streaming.completion import batch_folder, current_ledger, outcome_marks, read_outcomes

log = logging.getLogger(__name__)

#: The mark of a ledger that holds no batch.
NO_BATCH = -1


@dataclass(frozen=True)
class LedgerRefresh:
    """``version`` is in force; ``changed`` and ``refused`` are rows named by the marks of this run."""

    version: Version
    batches: int
    changed: int
    refused: int

    @property
    def through(self) -> int:
        return int(self.version.mark)


def start_ledger(spark: SparkSession, root: str, ledger: DataFrame) -> Version:
    """Store a first version; a ledger that is there already stays in force."""
    held = versions.current_version(spark, root)
    if held is not None:
        return held
    return versions.publish(spark, root, ledger.select(*LEDGER_COLUMNS), str(NO_BATCH))


def whole_batches(spark: SparkSession, outcomes_path: str, after: int) -> list[int]:
    """Batches after ``after`` that are written as a whole, up to the first one that is not."""
    found = []
    for batch in folders.numbered(spark, outcomes_path, "batch_id"):
        if batch > after:
            if not folders.finished(spark, batch_folder(outcomes_path, batch)):
                break
            found.append(batch)
    return found


def _remove_held(spark: SparkSession, outcomes_path: str, through: int) -> None:
    for batch in folders.numbered(spark, outcomes_path, "batch_id"):
        if batch <= through:
            folders.remove(spark, batch_folder(outcomes_path, batch))


def refresh_ledger(spark: SparkSession, root: str, outcomes_path: str, guarded: bool = False) -> LedgerRefresh:
    """Write the next version of the ledger at ``root`` and remove the batches it holds.

    Costs one pass over the ledger and the batches since the last one. Without new batches no
    version is written. The counts are observed while the version is written; a run whose
    marks change no row is warned about.
    """
    held = versions.current_version(spark, root)
    if held is None:
        raise ValueError(f"no ledger at {root}; store one with start_ledger")
    after = int(held.mark)
    batches = whole_batches(spark, outcomes_path, after)
    if not batches:
        _remove_held(spark, outcomes_path, after)
        return LedgerRefresh(held, 0, 0, 0)
    through = batches[-1]
    marks = outcome_marks(read_outcomes(spark, outcomes_path), after, through)
    mark = mark_scraped_guarded if guarded else mark_scraped_bulk
    seen = Observation("marks")
    marked = observe_marks(mark(read_ledger(spark, held.path), marks, with_named=True), seen)
    versions.write_version(root, held.number + 1, marked.select(*LEDGER_COLUMNS))
    counts = observed_counts(seen)
    changed, refused = counts.get("changed", 0), counts.get("refused", 0)
    version = versions.commit_version(spark, root, held.number + 1, str(through))
    _remove_held(spark, outcomes_path, through)
    versions.drop_versions(spark, root)
    log.info("ledger version %d: %d rows changed by batches %d to %d", version.number, changed, batches[0], through)
    if changed == 0:
        log.warning("batches %d to %d changed no row of the ledger", batches[0], through)
    if refused:
        log.warning("%d rows were not open and stay as they are", refused)
    return LedgerRefresh(version, len(batches), changed, refused)


def read_current_ledger(
    spark: SparkSession, root: str, outcomes_path: str, guarded: bool = False
) -> DataFrame:
    """The version in force with the marks of later whole batches applied.

    A refresh that runs in the meantime may remove the batches this reads; plan again then.
    """
    held = versions.current_version(spark, root)
    if held is None:
        raise ValueError(f"no ledger at {root}; store one with start_ledger")
    ledger = read_ledger(spark, held.path)
    later = whole_batches(spark, outcomes_path, int(held.mark))
    if not later:
        return ledger
    outcomes = read_outcomes(spark, outcomes_path).where(F.col("batch_id") <= later[-1])
    return current_ledger(ledger, outcomes, guarded, after_batch=int(held.mark))
