import base64
import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from snapstrata.plans import ledger_job
from snapstrata.schemas import ENVELOPE_SCHEMA, LEDGER_SCHEMA
from snapstrata.sources import folders, versions
from snapstrata.sources.ledger_store import read_ledger
from snapstrata.streaming import completion as C


def message(ack, body):
    raw = body if isinstance(body, str) else base64.b64encode(json.dumps(body).encode()).decode()
    return {"ack_id": ack, "message": {"data": raw}}


def done(ack, row, **more):
    return message(ack, {"row_id": row, "blob_path": f"p{row}", "success": True, **more})


def failed(ack, row):
    return message(ack, {"row_id": row, "blob_path": "", "success": False, "error": "503"})


CASES = [
    (done("a", 1), "success"),
    (failed("b", 2), "failed"),
    (message("c", "!!!"), "malformed"),
    (message("d", base64.b64encode(b"nope").decode()), "malformed"),
    (message("e", {"row_id": 3, "blob_path": "p"}), "failed"),
    (message("f", {"blob_path": "p", "success": True}), "malformed"),
    (message("g", {"blob_path": "p", "success": False}), "failed"),
    (message("h", [1, 2]), "malformed"),
    ({"ack_id": "i", "message": None}, "malformed"),
    (done("j", 1), "success"),
]


def test_triage(spark):
    rows = spark.createDataFrame([c for c, _ in CASES], ENVELOPE_SCHEMA)
    triaged = C.completion_triage(rows)
    assert {r.ack_id: r.outcome for r in triaged.collect()} == {c["ack_id"]: o for c, o in CASES}
    assert C.triage_counts(triaged).first() == (10, 2, 7, 3)
    assert [r.error for r in triaged.where("ack_id = 'b'").collect()] == ["503"]
    unique = C.stream_dedup(triaged.where(F.col("outcome") == C.SUCCESS))
    assert [tuple(r) for r in unique.collect()] == [(1, "p1", 2)]


class Feed:
    def __init__(self, root):
        self.path, self.count = root / "in", 0
        self.path.mkdir()

    def send(self, *messages):
        self.count += 1
        text = "\n".join(json.dumps(m) for m in messages)
        file = self.path / f"{self.count:03d}.json"
        file.write_text(text)
        # The source takes files by age, and these are written within one millisecond.
        os.utime(file, (1_700_000_000 + self.count,) * 2)


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path)


def ledger(spark):
    rows = [(i, 1, "1", "bind", "eu", "jett", i != 4, False, None) for i in range(1, 6)]
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def apply(spark, feed, root):
    stream = C.message_files(spark, str(feed.path), files_per_batch=1)
    writer = C.completion_apply(stream, str(root / "outcomes"), str(root / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return C.read_outcomes(spark, str(root / "outcomes"))


def marked(df):
    return {r.id for r in df.where("is_scrapped").collect()}


def test_apply_resumes_and_replays_change_nothing(spark, feed, tmp_path):
    feed.send(done("a", 1), failed("b", 2), message("c", "!!!"))
    feed.send(done("d", 4), done("e", 404))
    outcomes = apply(spark, feed, tmp_path)
    assert marked(C.current_ledger(ledger(spark), outcomes)) == {1, 4}
    assert marked(C.current_ledger(ledger(spark), outcomes, guarded=True)) == {1}

    feed.send(done("f", 2), done("a", 1))
    outcomes = apply(spark, feed, tmp_path)
    after = C.current_ledger(ledger(spark), outcomes)
    assert marked(after) == {1, 2, 4} and after.count() == 5
    assert marked(C.current_ledger(ledger(spark), outcomes, after_batch=1)) == {1, 2}
    assert outcomes.count() == 7
    assert {r.batch_id for r in outcomes.select("batch_id").collect()} == {0, 1, 2}

    batch = C.completion_triage(spark.read.schema(ENVELOPE_SCHEMA).json(f"{feed.path}/001.json"))
    C.store_outcomes(batch, 0, str(tmp_path / "outcomes"))
    again = C.read_outcomes(spark, str(tmp_path / "outcomes"))
    assert again.count() == 7
    assert marked(C.current_ledger(ledger(spark), again)) == {1, 2, 4}


def route(spark, feed, root):
    stream = C.message_files(spark, str(feed.path), files_per_batch=1)
    writer = C.dead_letter_route(stream, str(root / "letters"), str(root / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    letters = spark.read.schema(C.DEAD_LETTER_SCHEMA).parquet(str(root / "letters"))
    return sorted((r.row_id, r.failures, r.batch_id) for r in letters.collect())


def test_dead_letters_are_routed_once(spark, feed, tmp_path):
    feed.send(*[failed(f"a{i}", 1) for i in range(4)], done("x", 2), failed("y", 2))
    assert route(spark, feed, tmp_path) == []
    feed.send(failed("b", 1))
    assert route(spark, feed, tmp_path) == [(1, 5, 1)]
    feed.send(failed("c", 1), *[failed(f"d{i}", 3) for i in range(7)])
    feed.send(failed("e", 3))
    assert route(spark, feed, tmp_path) == [(1, 5, 1), (3, 7, 2)]


def test_dead_letter_batch_can_be_replayed(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5)], C.ROUTED_SCHEMA)
    path = str(tmp_path / "letters")
    C.store_dead_letters(rows.where("false"), 0, path)
    C.store_dead_letters(rows, 1, path)
    C.store_dead_letters(rows, 1, path)
    assert spark.read.schema(C.DEAD_LETTER_SCHEMA).parquet(path).count() == 1


def test_one_letter_per_row_over_many_batches(spark, feed, tmp_path, monkeypatch):
    """Whatever follows a letter; and no batch reads what earlier ones wrote."""
    read = []
    plain = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: read.append(p) or plain(self, *p, **k))
    for n in range(8):
        feed.send(*[failed(f"{n}-{r}-{i}", r) for r in (1, 2, 3) for i in range(r)], failed(f"{n}-x", None))
    stream = C.message_files(spark, str(feed.path), files_per_batch=1)
    writer = C.dead_letter_route(stream, str(tmp_path / "letters"), str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert read == []
    letters = spark.read.schema(C.DEAD_LETTER_SCHEMA).parquet(str(tmp_path / "letters"))
    found = sorted((r.row_id, r.failures, r.batch_id) for r in letters.collect())
    assert found == [(1, 5, 4), (2, 6, 2), (3, 6, 1)]


def test_marks_carry_their_time(spark, feed, tmp_path):
    feed.send(done("a", 1))
    row = C.current_ledger(ledger(spark), apply(spark, feed, tmp_path)).where("id = 1").first()
    assert abs((datetime.datetime.now() - row.last_scraped).total_seconds()) < 86_400


@pytest.fixture
def places(spark, tmp_path):
    root, outcomes = str(tmp_path / "ledger"), str(tmp_path / "outcomes")
    ledger_job.start_ledger(spark, root, ledger(spark))
    return root, outcomes


def stored(spark, root):
    return read_ledger(spark, versions.current_version(spark, root).path)


def test_ledger_versions_hold_the_batches_they_remove(spark, feed, tmp_path, places):
    root, outcomes = places
    assert ledger_job.refresh_ledger(spark, root, outcomes).version.number == 0
    feed.send(done("a", 1), failed("b", 2))
    feed.send(done("c", 4))
    apply(spark, feed, tmp_path)
    first = ledger_job.refresh_ledger(spark, root, outcomes)
    assert (first.version.number, first.through, first.batches, first.changed, first.refused) == (1, 1, 2, 2, 0)
    assert folders.numbered(spark, outcomes, "batch_id") == []
    assert marked(stored(spark, root)) == {1, 4}

    feed.send(done("d", 2))
    apply(spark, feed, tmp_path)
    assert marked(ledger_job.read_current_ledger(spark, root, outcomes)) == {1, 2, 4}
    assert marked(stored(spark, root)) == {1, 4}
    second = ledger_job.refresh_ledger(spark, root, outcomes)
    assert (second.version.number, second.through, marked(stored(spark, root))) == (2, 2, {1, 2, 4})
    assert ledger_job.refresh_ledger(spark, root, outcomes).version == second.version
    assert folders.numbered(spark, root, "version") == [1, 2]
    assert ledger_job.start_ledger(spark, root, ledger(spark)) == second.version


def test_a_held_batch_that_is_replayed_changes_nothing(spark, feed, tmp_path, places):
    root, outcomes = places
    feed.send(done("a", 1), done("b", 3))
    apply(spark, feed, tmp_path)
    before = ledger_job.refresh_ledger(spark, root, outcomes)
    batch = C.completion_triage(spark.read.schema(ENVELOPE_SCHEMA).json(f"{feed.path}/001.json"))
    rows = sorted(stored(spark, root).collect())
    C.store_outcomes(batch, 0, outcomes)
    assert sorted(ledger_job.read_current_ledger(spark, root, outcomes).collect()) == rows
    assert ledger_job.refresh_ledger(spark, root, outcomes).version == before.version
    assert sorted(stored(spark, root).collect()) == rows
    assert folders.numbered(spark, outcomes, "batch_id") == []


@pytest.mark.parametrize("step", ["write_version", "commit_version", "_remove_held", "drop_versions"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_crash_at_any_step_leaves_the_same_ledger(spark, feed, tmp_path, places, monkeypatch, step, when):
    root, outcomes = places
    feed.send(done("a", 1), failed("b", 2))
    feed.send(done("c", 4))
    apply(spark, feed, tmp_path)
    owner = ledger_job if step == "_remove_held" else versions
    whole = getattr(owner, step)

    def crash(*args):
        if when == "after":
            whole(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, crash)
        with pytest.raises(RuntimeError, match="lost"):
            ledger_job.refresh_ledger(spark, root, outcomes)
    assert marked(ledger_job.read_current_ledger(spark, root, outcomes)) == {1, 4}
    ledger_job.refresh_ledger(spark, root, outcomes)
    assert marked(stored(spark, root)) == {1, 4} and stored(spark, root).count() == 5
    assert versions.current_version(spark, root).mark == "1"
    assert folders.numbered(spark, outcomes, "batch_id") == []


def test_a_batch_that_is_not_whole_waits(spark, feed, tmp_path, places):
    root, outcomes = places
    feed.send(done("a", 1))
    feed.send(done("b", 2))
    feed.send(done("c", 3))
    apply(spark, feed, tmp_path)
    (tmp_path / "outcomes" / "batch_id=1" / "_SUCCESS").unlink()
    assert marked(ledger_job.read_current_ledger(spark, root, outcomes)) == {1}
    assert ledger_job.refresh_ledger(spark, root, outcomes).through == 0
    assert marked(stored(spark, root)) == {1}
    assert folders.numbered(spark, outcomes, "batch_id") == [1, 2]
    (tmp_path / "outcomes" / "batch_id=1" / "_SUCCESS").touch()
    ledger_job.refresh_ledger(spark, root, outcomes)
    assert marked(stored(spark, root)) == {1, 2, 3}


def test_changed_and_refused_rows_are_counted_and_warned_about(spark, feed, tmp_path, places, caplog):
    root, outcomes = places
    feed.send(done("a", 1), done("b", 4), done("c", 404))
    apply(spark, feed, tmp_path)
    done_once = ledger_job.refresh_ledger(spark, root, outcomes, guarded=True)
    assert (done_once.changed, done_once.refused) == (1, 1) and marked(stored(spark, root)) == {1}
    feed.send(done("d", 1))
    apply(spark, feed, tmp_path)
    with caplog.at_level("WARNING"):
        again = ledger_job.refresh_ledger(spark, root, outcomes, guarded=True)
    assert (again.changed, again.refused) == (0, 1)
    assert "changed no row" in caplog.text


def test_no_ledger_is_an_error(spark, tmp_path):
    for job in (ledger_job.refresh_ledger, ledger_job.read_current_ledger):
        with pytest.raises(ValueError, match="no ledger"):
            job(spark, str(tmp_path / "nowhere"), str(tmp_path / "outcomes"))
