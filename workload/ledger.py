"""Ledger states, dispatch, marking, and the audit against the files that exist."""

from __future__ import annotations

import datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from snapstrata.functions.paths import partition_path, path_snapshot
from snapstrata.operators import audit, filters
from snapstrata.operators import ledger as L
from snapstrata.operators.metrics import observed_counts
from snapstrata.schemas import LEDGER_COLUMNS, map_dimension, map_values_sql
from snapstrata.session import scratch_dir
from snapstrata.sources import ledger_store
from workload.registry import query
from workload.views import FILES, LEDGER, LISTING, MESSAGES, ledger, run

WITH_LEDGER = f"WITH ledger AS ({LEDGER})"
WITH_LISTING = f"{WITH_LEDGER}, listing AS ({LISTING})"
DIMENSION = f"(SELECT * FROM (VALUES {map_values_sql()}) AS t(map_id, map_name))"
PENDING = "is_completed AND NOT is_scrapped"
SCRAPED = "is_completed AND is_scrapped"


def path_sql(date: str, root: str = "bronze") -> str:
    return f"""'{root}/event_id=' || CAST(event_id AS VARCHAR) || '/region=' || region_abbr
    || '/map=' || map_name || '/agent=' || agent || '/snapshot_date='
    || CAST({date} AS VARCHAR) || '/data.csv'"""


@query("pending_partitions", f"{WITH_LEDGER} SELECT * FROM ledger WHERE {PENDING}")
def _(spark, sf_dir):
    return L.pending_partitions(ledger(spark, sf_dir))


@query("scraped_partitions", f"{WITH_LEDGER} SELECT * FROM ledger WHERE {SCRAPED}")
def _(spark, sf_dir):
    return L.scraped_partitions(ledger(spark, sf_dir))


@query(
    "typed_job_projection",
    f"""{WITH_LEDGER} SELECT CAST(id AS BIGINT) AS row_id, CAST(event_id AS VARCHAR) AS event_id,
    region_abbr, map_id, agent FROM ledger WHERE {PENDING}""",
)
def _(spark, sf_dir):
    return L.typed_job_projection(L.pending_partitions(ledger(spark, sf_dir)))


@query(
    "dispatch_projection",
    f"""{WITH_LEDGER} SELECT id AS row_id, event_id, map_id, map_name, region_abbr AS region,
    agent, DATE '2001-09-01' AS snapshot_date FROM ledger WHERE {PENDING}""",
)
def _(spark, sf_dir):
    return L.dispatch_projection(
        L.pending_partitions(ledger(spark, sf_dir)), datetime.date(2001, 9, 1)
    )


@query(
    "completed_date_projection",
    f"""{WITH_LEDGER} SELECT id, event_id, map_id, map_name, region_abbr, agent,
    CAST(last_scraped AS DATE) AS snapshot_date, last_scraped FROM ledger WHERE {SCRAPED}""",
)
def _(spark, sf_dir):
    return L.completed_date_projection(L.scraped_partitions(ledger(spark, sf_dir)))


@query(
    "pending_batch",
    f"{WITH_LEDGER} SELECT * FROM ledger WHERE {PENDING} ORDER BY id LIMIT 200",
)
def _(spark, sf_dir):
    return L.pending_batch(ledger(spark, sf_dir))


@query(
    "recent_scrapes",
    f"""{WITH_LEDGER} SELECT id, event_id, map_id, map_name, region_abbr, agent,
    CAST(last_scraped AS DATE) AS snapshot_date, last_scraped FROM ledger WHERE {SCRAPED}
    ORDER BY last_scraped DESC NULLS FIRST, event_id NULLS LAST, map_id NULLS LAST,
      map_name NULLS LAST, region_abbr NULLS LAST, agent NULLS LAST, id LIMIT 500""",
)
def _(spark, sf_dir):
    return L.recent_scrapes(ledger(spark, sf_dir))


@query(
    "required_fields_split",
    f"""{WITH_LEDGER} SELECT id, map_id, map_name, map_name IS NOT NULL AS valid FROM ledger""",
)
def _(spark, sf_dir):
    valid, rejected = filters.required_fields_split(ledger(spark, sf_dir))
    return (
        valid.withColumn("valid", F.lit(True))
        .unionByName(rejected.withColumn("valid", F.lit(False)))
        .select("id", "map_id", "map_name", "valid")
    )


@query(
    "map_dimension_join",
    f"""{WITH_LEDGER} SELECT l.id, l.map_id, d.map_name FROM ledger l
    JOIN {DIMENSION} d ON d.map_id = l.map_id""",
)
def _(spark, sf_dir):
    jobs = ledger(spark, sf_dir)
    return L.map_dimension_join(jobs, map_dimension(spark)).select("id", "map_id", "map_name")


@query(
    "unknown_map_filter",
    f"""{WITH_LEDGER} SELECT l.id, l.map_id, d.map_id IS NOT NULL AS kept FROM ledger l
    LEFT JOIN {DIMENSION} d ON d.map_id = l.map_id WHERE {PENDING}""",
)
def _(spark, sf_dir):
    jobs = L.pending_partitions(ledger(spark, sf_dir))
    kept, rejected = L.unknown_map_filter(jobs, map_dimension(spark))
    return (
        kept.select("id", "map_id", F.lit(True).alias("kept"))
        .unionByName(rejected.select("id", "map_id", F.lit(False).alias("kept")))
    )


@query(
    "partition_path_build",
    f"{WITH_LEDGER} SELECT id, {path_sql('CAST(last_scraped AS DATE)')} AS path FROM ledger",
)
def _(spark, sf_dir):
    rows = ledger(spark, sf_dir)
    path = partition_path(
        F.col("event_id"), F.col("region_abbr"), F.col("map_name"), F.col("agent"),
        F.to_date("last_scraped"),
    )
    return rows.select("id", path.alias("path"))


@query(
    "partition_path_parse",
    f"""WITH files AS ({FILES}) SELECT path,
    split_part(split_part(path, 'snapshot_date=', 2), '/', 1) AS snapshot_date
    FROM files WHERE contains(path, '/snapshot_date=')""",
)
def _(spark, sf_dir):
    rows = run(spark, sf_dir, FILES)
    return rows.withColumn("snapshot_date", path_snapshot(F.col("path"))).where(
        F.col("snapshot_date") != ""
    )


EXPECTED = f"""expected AS (SELECT id, event_id, map_id, map_name, region_abbr, agent,
  CAST(last_scraped AS DATE) AS snapshot_date, last_scraped,
  {path_sql('CAST(last_scraped AS DATE)')} AS path FROM ledger WHERE {SCRAPED})"""


@query(
    "ledger_lake_audit",
    f"""{WITH_LISTING}, {EXPECTED} SELECT id, event_id, map_name, region_abbr AS region, agent,
    snapshot_date, path, coalesce(path IN (SELECT path FROM listing), FALSE) AS exists
    FROM expected""",
)
def _(spark, sf_dir):
    return audit.ledger_lake_audit(ledger(spark, sf_dir), run(spark, sf_dir, LISTING))


@query(
    "missing_partitions",
    f"""{WITH_LISTING}, {EXPECTED} SELECT * FROM expected e
    WHERE NOT EXISTS (SELECT 1 FROM listing s WHERE s.path = e.path)""",
)
def _(spark, sf_dir):
    return audit.missing_partitions(ledger(spark, sf_dir), run(spark, sf_dir, LISTING))


@query(
    "orphan_partitions",
    f"""{WITH_LISTING}, {EXPECTED} SELECT DISTINCT path FROM listing s
    WHERE NOT EXISTS (SELECT 1 FROM expected e WHERE s.path = e.path)""",
)
def _(spark, sf_dir):
    return audit.orphan_partitions(ledger(spark, sf_dir), run(spark, sf_dir, LISTING))


@query(
    "snapshot_file_groups",
    f"""WITH files AS ({FILES}), inside AS (SELECT path,
      split_part(path, '/snapshot_date=', 1) AS prefix,
      split_part(split_part(path, '/snapshot_date=', 2), '/', 1) AS snapshot_date
      FROM files WHERE contains(path, '/snapshot_date='))
    SELECT prefix, snapshot_date, path,
      count(*) OVER (PARTITION BY prefix, snapshot_date) AS n_files FROM inside""",
)
def _(spark, sf_dir):
    return audit.snapshot_file_groups(run(spark, sf_dir, FILES))


# Successful messages as marks, in both forms of the update.
MARKS = f"""SELECT row_id, CAST(ts AS TIMESTAMP) AS marked_at FROM ({MESSAGES}) AS sent
WHERE success AND kind = 'whole'"""


@query(
    "mark_scraped_bulk",
    f"""{WITH_LEDGER}, marks AS (SELECT row_id, max(marked_at) AS marked_at FROM ({MARKS}) AS done
      GROUP BY row_id)
    SELECT id, event_id, map_id, map_name, region_abbr, agent, is_completed,
      is_scrapped OR row_id IS NOT NULL AS is_scrapped,
      coalesce(marked_at, last_scraped) AS last_scraped, row_id IS NOT NULL AS changed
    FROM ledger LEFT JOIN marks ON row_id = id""",
)
def _(spark, sf_dir):
    return L.mark_scraped_bulk(ledger(spark, sf_dir), run(spark, sf_dir, MARKS))


@query(
    "mark_scraped_guarded",
    f"""{WITH_LEDGER}, marks AS (SELECT row_id, min(marked_at) AS marked_at FROM ({MARKS}) AS done
      GROUP BY row_id)
    SELECT id, event_id, map_id, map_name, region_abbr, agent, is_completed,
      is_scrapped OR (row_id IS NOT NULL AND {PENDING}) AS is_scrapped,
      CASE WHEN {PENDING} AND row_id IS NOT NULL THEN marked_at ELSE last_scraped END
        AS last_scraped,
      row_id IS NOT NULL AND {PENDING} AS changed
    FROM ledger LEFT JOIN marks ON row_id = id""",
)
def _(spark, sf_dir):
    return L.mark_scraped_guarded(ledger(spark, sf_dir), run(spark, sf_dir, MARKS))


@query(
    "mark_scraped_counts",
    f"""{WITH_LEDGER}, marks AS (SELECT DISTINCT row_id FROM ({MARKS}) AS done)
    SELECT count(*) FILTER ({PENDING}) AS changed, count(*) FILTER (NOT coalesce({PENDING}, FALSE)) AS refused
    FROM ledger JOIN marks ON row_id = id""",
)
def _(spark, sf_dir):
    """What is counted while the guarded marks are written: rows changed, and rows named in vain."""
    seen = Observation("marks")
    marked = L.mark_scraped_guarded(ledger(spark, sf_dir), run(spark, sf_dir, MARKS), with_named=True)
    observed = L.observe_marks(marked, seen).select(*LEDGER_COLUMNS)
    ledger_store.write_ledger(observed, f"{scratch_dir(spark, 'ledger')}/version=1")
    counts = observed_counts(seen)
    return spark.range(1).select(*[F.lit(counts[c]).cast("bigint").alias(c) for c in ("changed", "refused")])
