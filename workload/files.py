"""Sources and sinks: the views written as lakes below the scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from snapstrata.functions.paths import below_root
from snapstrata.operators import audit
from snapstrata.operators.cleaning import silver_transform
from snapstrata.operators.gold import gold_map_metrics
from snapstrata.operators.latest import latest_state
from snapstrata.schemas import BRONZE_FIELDS, LINEAGE_COLUMNS, PARTITION_COLUMNS
from snapstrata.session import kept, scratch_dir
from snapstrata.sources import lake, ledger_store, listing
from workload.gold import CLUTCHES, COUNTS, KILL_DEATHS, RATES, distinct
from workload.ledger import EXPECTED, WITH_LISTING
from workload.registry import query
from workload.silver import DEDUP, SILVER, WITH_LATEST
from workload.views import BRONZE, LEDGER, LISTING, bronze, ledger, run

# The lake is written once with all rows; then some of its partitions are replaced.
REPLACED = "event_id = 1 AND region = 'eu'"
WITH_LAKE = f"""WITH bronze AS (
  SELECT * REPLACE (CASE WHEN {REPLACED} THEN kills + 1 ELSE kills END AS kills) FROM ({BRONZE}))"""
WITH_LAKE_SILVER = f"{WITH_LAKE}, dedup AS ({DEDUP}), silver AS ({SILVER})"
# CSV does not tell an empty text from a missing one.
AS_READ = "* REPLACE (nullif(headshot_percentage, '') AS headshot_percentage)"
FOLDER = """'event_id=' || CAST(event_id AS VARCHAR) || '/region=' || region || '/map=' || map
  || '/agent=' || agent || '/snapshot_date=' || CAST(snapshot_date AS VARCHAR)"""

_LAKES: dict[tuple[str, str], str] = {}


def bronze_lake(spark: SparkSession, sf_dir: str) -> str:
    """All rows as a partitioned CSV lake, made once per application.

    A second write replaces the partitions that it brings and leaves the others.
    """
    owner = (spark.sparkContext.applicationId, sf_dir)
    if owner not in _LAKES:
        path = f"{scratch_dir(spark, 'lake')}/bronze"
        rows = bronze(spark, sf_dir)
        lake.write_bronze_csv(rows, path, fresh=True)
        # The rows to replace are few and lie in folders of their own: they are read there, not joined again.
        again = lake.read_bronze(spark, path).where(REPLACED).select(*BRONZE_FIELDS, *PARTITION_COLUMNS)
        again = kept(again.withColumn("kills", F.col("kills") + 1), "replaced")
        lake.write_bronze_csv(again, path)
        _LAKES[owner] = path
    return _LAKES[owner]


@query(
    "scan_bronze_snapshot",
    f"{WITH_LAKE} SELECT {AS_READ} FROM bronze WHERE snapshot_date = DATE '1998-01-01'",
)
def _(spark, sf_dir):
    rows = lake.read_bronze(spark, bronze_lake(spark, sf_dir), "1998-01-01")
    return rows.select(*BRONZE_FIELDS, *PARTITION_COLUMNS)


@query("infer_schema", f"{WITH_LAKE} SELECT {AS_READ} FROM bronze")
def _(spark, sf_dir):
    rows = lake.read_bronze(spark, bronze_lake(spark, sf_dir), infer_schema=True)
    return rows.select(*BRONZE_FIELDS, *PARTITION_COLUMNS)


@query(
    "partition_promotion",
    f"""{WITH_LAKE} SELECT event_id, region, map, agent, snapshot_date, count(*) AS n_rows
    FROM bronze GROUP BY event_id, region, map, agent, snapshot_date""",
)
def _(spark, sf_dir):
    rows = lake.read_bronze(spark, bronze_lake(spark, sf_dir))
    return rows.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "source_file_lineage",
    f"""{WITH_LAKE} SELECT {FOLDER} AS folder, count(*) AS n_rows FROM bronze
    GROUP BY event_id, region, map, agent, snapshot_date""",
)
def _(spark, sf_dir):
    """The folder part of the path; file names are given by the writer."""
    rows = lake.read_bronze(spark, bronze_lake(spark, sf_dir))
    folder = F.regexp_replace(below_root(F.col("_source_file")), "/[^/]+$", "")
    return rows.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "ingestion_timestamp",
    f"""{WITH_LAKE} SELECT snapshot_date, count(*) AS n_rows, TRUE AS all_stamped,
    CAST(1 AS BIGINT) AS n_stamps FROM bronze GROUP BY snapshot_date""",
)
def _(spark, sf_dir):
    """The time itself differs per run; what holds is one value for all rows that a read takes in."""
    rows = lake.read_bronze(spark, bronze_lake(spark, sf_dir))
    return rows.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.col("_ingested_at").isNotNull()).alias("all_stamped"),
        F.count_distinct("_ingested_at").alias("n_stamps"),
    )


@query(
    "lake_listing_source",
    f"""{WITH_LAKE} SELECT DISTINCT 'bronze/' || {FOLDER} || '/data.csv' AS path FROM bronze""",
)
def _(spark, sf_dir):
    """The inventory of the lake, listed by tasks, event by event and region by region."""
    root = f"{scratch_dir(spark, 'inventory')}/files"
    listing.refresh_inventory(spark, root, bronze_lake(spark, sf_dir))
    return listing.partition_listing(listing.read_inventory(spark, root).where(F.col("length") > 0))


@query("bronze_csv_sink", f"{WITH_LAKE} SELECT {AS_READ} FROM bronze")
def _(spark, sf_dir):
    """Every row after both writes: the second replaces the partitions that it brings and leaves the others."""
    rows = lake.read_bronze(spark, bronze_lake(spark, sf_dir))
    return rows.select(*BRONZE_FIELDS, *PARTITION_COLUMNS)


@query(
    "empty_partition_policy",
    f"""{WITH_LAKE}, partitions AS (SELECT snapshot_date, count(*) AS n_rows,
      count(DISTINCT (event_id, region, map, agent)) AS present,
      count(DISTINCT (event_id, region, map, agent)) FILTER (event_id = 1) AS headers
      FROM bronze GROUP BY snapshot_date)
    SELECT snapshot_date, n_rows, TRUE AS refused, present, headers, CAST(0 AS BIGINT) AS header_rows FROM partitions""",
)
def _(spark, sf_dir):
    """Writing nothing with ``skip`` and ``error`` leaves what is there. With ``header``, the partitions of an
    event that has no rows get a file each: the audit finds them, and a read takes them as no rows."""
    path, headers = bronze_lake(spark, sf_dir), f"{scratch_dir(spark, 'empty')}/bronze"
    rows = bronze(spark, sf_dir)
    nothing = rows.where(F.col("event_id") < 0)
    lake.write_bronze_csv(nothing, path, if_empty="skip")
    try:
        lake.write_bronze_csv(nothing, path, if_empty="error")
        refused = False
    except lake.EmptyWriteError:
        refused = True
    partitions = rows.select(*PARTITION_COLUMNS).distinct()
    nobody = partitions.where(F.col("event_id") == 1).withColumn("event_id", F.lit(99))
    lake.write_bronze_csv(nothing, headers, "header", asked=nobody, fresh=True)
    # Every partition asked for is a scraped row of a ledger; the audit looks for its file.
    expected = partitions.unionByName(nobody).select(
        F.xxhash64(*PARTITION_COLUMNS).alias("id"), F.col("event_id").cast("bigint").alias("event_id"),
        F.lit("1").alias("map_id"), F.col("map").alias("map_name"), F.col("region").alias("region_abbr"), "agent",
        F.lit(True).alias("is_completed"), F.lit(True).alias("is_scrapped"),
        F.col("snapshot_date").cast("timestamp").alias("last_scraped"),
    )
    files = None
    for base in (path, headers):
        root = f"{scratch_dir(spark, 'inventory')}/files"
        listing.refresh_inventory(spark, root, base)
        held = listing.partition_listing(listing.read_inventory(spark, root))
        files = held if files is None else files.unionByName(held)
    found = audit.ledger_lake_audit(expected, files).where("exists").groupBy("snapshot_date").agg(
        F.count_if(F.col("event_id") != 99).alias("present"),
        F.count_if(F.col("event_id") == 99).alias("headers"),
    )
    read = lake.read_bronze(spark, path).withColumn("header", F.lit(0)).unionByName(
        lake.read_bronze(spark, headers).withColumn("header", F.lit(1))
    )
    counts = read.groupBy("snapshot_date").agg(
        F.count_if(F.col("header") == 0).alias("n_rows"), F.lit(refused).alias("refused"),
        F.count_if(F.col("header") == 1).alias("header_rows"),
    )
    return counts.join(found, "snapshot_date")


@query(
    "silver_parquet_sink",
    f"""{WITH_LAKE_SILVER} SELECT * EXCLUDE (_pipeline_version),
    CASE WHEN snapshot_date = DATE '1998-01-01' AND event_id = 1 THEN '1.0.1' ELSE '1.0.0' END AS _pipeline_version
    FROM silver""",
)
def _(spark, sf_dir):
    """All snapshots are written, then those of one event and date again under a new version."""
    path = f"{scratch_dir(spark, 'silver')}/silver"
    base = bronze_lake(spark, sf_dir)
    lake.write_silver(silver_transform(lake.read_bronze(spark, base)), path, fresh=True)
    again = silver_transform(lake.read_bronze(spark, base, "1998-01-01"), "1.0.1")
    lake.write_silver(again.where(F.col("event_id") == 1), path)
    return lake.read_silver(spark, path).drop("_ingested_at", "_source_file")


@query(
    "gold_parquet_sink",
    f"""{WITH_LATEST} SELECT map, count(*) AS entities,
    {distinct(players='player_id', agents='agent', events='event_id')},
    {COUNTS}, {KILL_DEATHS}, {RATES}, {CLUTCHES} FROM latest GROUP BY map""",
)
def _(spark, sf_dir):
    gold_path = f"{scratch_dir(spark, 'gold')}/gold"
    silver = silver_transform(bronze(spark, sf_dir)).drop(*LINEAGE_COLUMNS)
    state = lake.write_gold(latest_state(silver), gold_path, "latest_state")
    table = gold_map_metrics(spark.read.parquet(state))
    return spark.read.parquet(lake.write_gold(table, gold_path, "map_metrics"))


@query(
    "ledger_source",
    f"""WITH ledger AS ({LEDGER}) SELECT * FROM ledger
    WHERE is_completed AND NOT is_scrapped""",
)
def _(spark, sf_dir):
    """A stored ledger version, read with its filter pushed to the files."""
    path = f"{scratch_dir(spark, 'ledger')}/version=1"
    ledger_store.write_ledger(ledger(spark, sf_dir), path)
    rows = ledger_store.read_ledger(spark, path)
    return rows.where(F.col("is_completed") & ~F.col("is_scrapped"))


@query(
    "audit_csv_sink",
    f"""{WITH_LISTING}, {EXPECTED} SELECT id, event_id, map_name, region_abbr AS region, agent,
    snapshot_date, path, coalesce(path IN (SELECT path FROM listing), FALSE) AS exists
    FROM expected""",
)
def _(spark, sf_dir):
    path = f"{scratch_dir(spark, 'audit')}/report"
    report = audit.ledger_lake_audit(ledger(spark, sf_dir), run(spark, sf_dir, LISTING))
    ledger_store.write_audit_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)
