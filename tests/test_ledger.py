import datetime

from pyspark.sql import functions as F

from snapstrata.operators import audit, filters
from snapstrata.operators import ledger as L
from snapstrata.schemas import LEDGER_SCHEMA, MAP_NAMES, map_dimension
from snapstrata.sources.ledger_store import jdbc_options

NOW = datetime.datetime(2024, 3, 1, 12)
THEN = datetime.datetime(2024, 2, 1, 8)


def ledger(spark):
    rows = [
        (1, 1, "1", "bind", "eu", "jett", True, True, THEN),
        (2, 1, "2", "haven", "eu", "jett", True, False, None),
        (5, 1, "4", None, "eu", "jett", True, False, None),
        (9, 2, "2", "haven", "kr", "omen", False, False, None),
        (12, 2, "2", "", "kr", "omen", False, True, THEN),
        (14, 2, "3", "split", "kr", "omen", True, True, THEN + datetime.timedelta(days=1)),
    ]
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def ids(df):
    return [r.id for r in df.collect()]


def test_states(spark):
    rows = ledger(spark)
    assert sorted(ids(L.pending_partitions(rows))) == [2, 5]
    assert sorted(ids(L.scraped_partitions(rows))) == [1, 14]
    assert ids(L.pending_batch(rows, 1)) == [2]
    assert ids(L.recent_scrapes(rows)) == [14, 1]
    unknown = rows.withColumn("is_scrapped", F.lit(None).cast("boolean"))
    assert ids(L.pending_partitions(unknown)) == []


def test_projections(spark):
    rows = L.pending_partitions(ledger(spark))
    typed = L.typed_job_projection(rows)
    assert dict(typed.dtypes) == {
        "row_id": "bigint", "event_id": "string", "region_abbr": "string", "map_id": "string",
        "agent": "string",
    }
    dispatched = L.dispatch_projection(rows, datetime.date(2024, 3, 1))
    assert dispatched.columns == [
        "row_id", "event_id", "map_id", "map_name", "region", "agent", "snapshot_date",
    ]


def test_required_fields(spark):
    valid, rejected = filters.required_fields_split(ledger(spark))
    assert sorted(ids(valid)) == [1, 2, 9, 14] and sorted(ids(rejected)) == [5, 12]


def test_unknown_maps(spark):
    kept, rejected = L.unknown_map_filter(ledger(spark), map_dimension(spark))
    assert {r.id: r.map_name for r in kept.collect()} == {
        1: "bind", 2: "haven", 9: "haven", 12: "haven", 14: "split",
    }
    assert ids(rejected) == [5]
    assert len(MAP_NAMES) == 12 and "4" not in MAP_NAMES and "7" not in MAP_NAMES


def marks(spark, *rows):
    return spark.createDataFrame(list(rows), "row_id bigint, marked_at timestamp")


def state(df):
    return {r.id: (r.is_scrapped, r.last_scraped, r.changed) for r in df.collect()}


def test_bulk_mark(spark):
    later = NOW + datetime.timedelta(hours=1)
    found = state(L.mark_scraped_bulk(
        ledger(spark), marks(spark, (2, NOW), (2, later), (1, NOW), (9, NOW), (404, NOW), (None, NOW))
    ))
    assert found[2] == (True, later, True)
    assert found[1] == (True, NOW, True)
    assert found[9] == (True, NOW, True)
    assert found[5] == (False, None, False)
    assert len(found) == 6


def test_guarded_mark(spark):
    later = NOW + datetime.timedelta(hours=1)
    found = state(L.mark_scraped_guarded(
        ledger(spark), marks(spark, (2, later), (2, NOW), (1, NOW), (9, NOW))
    ))
    assert found[2] == (True, NOW, True)
    assert found[1] == (True, THEN, False)
    assert found[9] == (False, None, False)


def listing(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


BIND = "bronze/event_id=1/region=eu/map=bind/agent=jett/snapshot_date=2024-02-01/data.csv"
SPLIT = "bronze/event_id=2/region=kr/map=split/agent=omen/snapshot_date=2024-02-02/data.csv"
STRAY = "bronze/event_id=9/region=kr/map=split/agent=omen/snapshot_date=2024-02-02/data.csv"


def test_audit(spark):
    rows, files = ledger(spark), listing(spark, BIND, BIND, STRAY)
    report = audit.ledger_lake_audit(rows, files)
    assert {(r.id, r.path, r.exists) for r in report.collect()} == {
        (1, BIND, True), (14, SPLIT, False),
    }
    assert report.count() == 2
    assert ids(audit.missing_partitions(rows, files)) == [14]
    assert [r.path for r in audit.orphan_partitions(rows, files).collect()] == [STRAY]


def test_file_groups(spark):
    prefix = "bronze/event_id=1/region=eu/map=bind/agent=jett"
    files = listing(
        spark, f"{prefix}/snapshot_date=2024-01-01/a.csv", f"{prefix}/snapshot_date=2024-01-01/b.csv",
        f"{prefix}/snapshot_date=2024-01-02/a.csv", f"{prefix}/readme.txt",
        f"{prefix}2/snapshot_date=2024-01-02/a.csv",
    )
    found = audit.snapshot_file_groups(files).collect()
    assert sorted((r.prefix, r.snapshot_date, r.n_files) for r in found) == [
        (prefix, "2024-01-01", 2), (prefix, "2024-01-01", 2), (prefix, "2024-01-02", 1),
        (f"{prefix}2", "2024-01-02", 1),
    ]
    only = spark.createDataFrame([(f"{prefix}/",), ("bronze/none",)], "prefix string")
    found = audit.snapshot_file_groups(files, only).collect()
    assert sorted((r.prefix, r.n_files) for r in found) == [(prefix, 1), (prefix, 2), (prefix, 2), ("bronze/none", 0)]


def test_jdbc_options():
    plain = jdbc_options("jdbc:x://h/db", "ledger")
    assert "user" not in plain and "partitionColumn" not in plain
    sliced = jdbc_options("jdbc:x://h/db", "ledger", user="u", password="p", id_range=(1, 900))
    assert sliced["partitionColumn"] == "id" and sliced["upperBound"] == "900"
