"""The ingestion of pages and the audit, from pages to the marked ledger and the report."""

import datetime

import pytest
from pyspark.sql import functions as F

from snapstrata.plans import audit_job, ingest_job, ledger_job
from snapstrata.schemas import LEDGER_SCHEMA, map_dimension
from snapstrata.sources.lake import read_bronze
from snapstrata.sources.ledger_store import read_ledger
from snapstrata.streaming import completion as C
from tests.test_pages import cells, page

DAY = datetime.date(2024, 1, 1)
PAGES = "row_id long, event_id long, region_abbr string, agent string, map_id string, snapshot_date date, html string"


def pages(spark):
    rows = [
        (1, 7, "eu", "jett", "1", DAY, page(cells(name="One"), cells(name="Two"))),
        (2, 7, "eu", "jett", "1", DAY, page(cells(name="Three"))),
        (3, 7, "eu", "jett", "2", DAY, page()),
        (4, 7, "eu", "jett", "4", DAY, page(cells())),
        (5, 7, "", "jett", "1", DAY, page(cells())),
        (6, 7, "eu", None, "1", DAY, page(cells())),
        (7, 7, "kr", "omen", "3", DAY, None),
    ]
    return spark.createDataFrame(rows, PAGES)


def path(map_name, region="eu", agent="jett"):
    return f"bronze/event_id=7/region={region}/map={map_name}/agent={agent}/snapshot_date=2024-01-01/data.csv"


def test_pages_become_rows_and_messages(spark, tmp_path):
    base = str(tmp_path / "bronze")
    done = ingest_job.ingest_pages(pages(spark), map_dimension(spark), base)
    found = {r.row_id: (r.success, r.error, r.blob_path) for r in done.messages.collect()}
    assert found == {
        1: (True, None, path("bind")), 2: (True, None, path("bind")), 3: (True, None, path("haven")),
        4: (False, "unknown map", None), 5: (False, "missing field", None), 6: (False, "missing field", None),
        7: (False, "no page", path("split", "kr", "omen")),
    }
    rows = read_bronze(spark, base, DAY)
    assert sorted((r.player, r.map, r.kills) for r in rows.collect()) == [("One", "bind", 1), ("Three", "bind", 1), ("Two", "bind", 1)]
    header_only = list((tmp_path / "bronze").glob("**/map=haven/**/*.csv"))
    assert len(header_only) == 1 and header_only[0].read_text().count("\n") == 1
    assert not list((tmp_path / "bronze").glob("**/map=split"))

    again = ingest_job.ingest_pages(pages(spark).where("row_id = 2"), map_dimension(spark), base)
    assert again.messages.count() == 1 and read_bronze(spark, base).count() == 1


def test_pages_to_ledger_to_audit(spark, tmp_path, caplog):
    """Messages of the ingestion mark the ledger, and the audit finds every file but one removed."""
    base, outcomes, root = str(tmp_path / "bronze"), str(tmp_path / "outcomes"), str(tmp_path / "ledger")
    names = {"1": "bind", "2": "haven", "3": "split", "4": None}
    rows = [
        (i, 7, m, names[m], "kr" if i == 7 else "eu", "omen" if i == 7 else "jett", True, False, None)
        for i, m in ((1, "1"), (3, "2"), (4, "4"), (7, "3"))
    ]
    ledger_job.start_ledger(spark, root, spark.createDataFrame(rows, LEDGER_SCHEMA))
    messages = ingest_job.ingest_pages(pages(spark), map_dimension(spark), base).messages
    batch = messages.select(F.col("row_id").cast("string").alias("ack_id"), F.struct("data").alias("message"))
    C.store_outcomes(C.completion_triage(batch), 0, outcomes)
    refreshed = ledger_job.refresh_ledger(spark, root, outcomes, guarded=True)
    ledger = read_ledger(spark, refreshed.version.path)
    assert {r.id for r in ledger.where("is_scrapped").collect()} == {1, 3} and refreshed.changed == 2

    # Scraped today, as the stream stamps it: the audit looks for files of that date.
    today = ledger.where("id = 1").first().last_scraped.date()
    dated = ingest_job.ingest_pages(pages(spark).withColumn("snapshot_date", F.lit(today)), map_dimension(spark), base)
    assert dated.messages.count() == 7
    inventory, reports = str(tmp_path / "inventory"), str(tmp_path / "reports")
    report = audit_job.refresh_audit(spark, root, inventory, base, reports, DAY)
    assert (report.rows, report.missing) == (2, 0) and report.path.endswith("report_date=2024-01-01")
    for file in (tmp_path / "bronze").glob(f"**/map=haven/**/snapshot_date={today}/*.csv"):
        file.unlink()
    with caplog.at_level("WARNING"):
        later = audit_job.refresh_audit(spark, root, inventory, base, reports, DAY)
    assert (later.rows, later.missing) == (2, 1) and "1 scraped partitions have no file" in caplog.text
    written = spark.read.option("header", True).csv(later.path)
    assert {(r.id, r.exists) for r in written.collect()} == {("1", "true"), ("3", "false")}
    newest = audit_job.refresh_audit(spark, root, inventory, base, reports, "2024-01-02", newest=1)
    assert newest.rows == 1


def test_no_ledger_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no ledger"):
        audit_job.refresh_audit(spark, str(tmp_path / "none"), str(tmp_path / "i"), str(tmp_path), str(tmp_path / "r"), DAY)


def test_messages_do_not_read_the_pages_again(spark, tmp_path):
    done = ingest_job.ingest_pages(pages(spark), map_dimension(spark), str(tmp_path / "bronze"))
    assert "html" not in done.messages._jdf.queryExecution().optimizedPlan().toString()
    assert done.messages.count() == 7
