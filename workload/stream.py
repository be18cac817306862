"""Completion messages: coding, triage, and the streams that apply them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.functions.messages import base64_line, decode_message, encode_completion
from snapstrata.plans import ledger_job
from snapstrata.session import scratch_dir
from snapstrata.sources.ledger_store import read_ledger
from snapstrata.streaming import completion as C
from workload.registry import query
from workload.views import LEDGER, MESSAGE_BODIES, MESSAGES, ledger, run

SENT = f"sent AS ({MESSAGES})"
OUTCOME = """CASE WHEN kind IN ('not base64', 'not json', 'not an object', 'trailing') THEN 'malformed'
  WHEN kind = 'no success' OR NOT success THEN 'failed'
  WHEN kind = 'no row id' THEN 'malformed' ELSE 'success' END"""
TRIAGED = f"triaged AS (SELECT *, {OUTCOME} AS outcome FROM sent)"
# What can be read from a body of each kind.
SPELT = "'text id', 'decimal id', 'number success', 'text success'"
BODY_ROW = f"CASE WHEN kind IN ('whole', 'no success', {SPELT}) THEN row_id END"
READABLE = f"kind IN ('whole', 'no success', 'no row id', {SPELT})"


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the transport delivers them, with the event they came from."""
    bodies = run(spark, sf_dir, MESSAGE_BODIES)
    data = F.when(F.col("kind") == "not base64", F.lit("!not base64!")).otherwise(
        base64_line(F.encode("body", "UTF-8"))
    )
    return bodies.select("event_id", "ack_id", F.struct(data.alias("data")).alias("message"))


def message_folder(spark: SparkSession, sf_dir: str, root: str) -> str:
    """The messages as JSON-lines files, as many as the events have splits."""
    path = f"{root}/messages"
    envelopes(spark, sf_dir).drop("event_id").write.json(path)
    return path


@query(
    "encode_completion",
    f"""WITH {SENT} SELECT event_id, to_base64(encode('{{"row_id":' || CAST(row_id AS VARCHAR)
    || ',"blob_path":"' || blob_path || '","success":' || CAST(success AS VARCHAR) || '}}')) AS data
    FROM sent""",
)
def _(spark, sf_dir):
    data = encode_completion(F.col("row_id"), F.col("blob_path"), F.col("success"))
    return run(spark, sf_dir, MESSAGES).select("event_id", data.alias("data"))


@query(
    "decode_message",
    f"""WITH {SENT} SELECT event_id, {READABLE} AS readable, {BODY_ROW} AS row_id,
    CASE WHEN {READABLE} THEN blob_path END AS blob_path,
    CASE WHEN kind IN ('whole', 'no row id', {SPELT}) THEN success END AS success FROM sent""",
)
def _(spark, sf_dir):
    rows = envelopes(spark, sf_dir).withColumn("b", decode_message(F.col("message.data")))
    return rows.select(
        "event_id", F.col("b").isNotNull().alias("readable"), "b.row_id", "b.blob_path", "b.success"
    )


@query(
    "completion_triage",
    f"""WITH {SENT}, {TRIAGED} SELECT event_id, ack_id, {BODY_ROW} AS row_id,
    CASE WHEN {READABLE} THEN blob_path END AS blob_path, CAST(NULL AS VARCHAR) AS error, outcome
    FROM triaged""",
)
def _(spark, sf_dir):
    return C.completion_triage(envelopes(spark, sf_dir))


@query(
    "triage_counts",
    f"""WITH {SENT}, {TRIAGED} SELECT count(*) AS messages,
    count(*) FILTER (outcome = 'success') AS to_mark,
    count(*) FILTER (outcome <> 'failed') AS to_ack,
    count(*) FILTER (outcome = 'failed') AS redelivered FROM triaged""",
)
def _(spark, sf_dir):
    return C.triage_counts(C.completion_triage(envelopes(spark, sf_dir)))


@query(
    "stream_dedup",
    f"""WITH {SENT}, {TRIAGED} SELECT row_id, min(blob_path) AS blob_path, count(*) AS deliveries
    FROM triaged WHERE outcome = 'success' GROUP BY row_id""",
)
def _(spark, sf_dir):
    triaged = C.completion_triage(envelopes(spark, sf_dir))
    return C.stream_dedup(triaged.where(F.col("outcome") == C.SUCCESS))


@query(
    "message_source",
    f"""WITH {SENT} SELECT ack_id, CASE kind
      WHEN 'not base64' THEN '!not base64!'
      ELSE to_base64(encode(body)) END AS data FROM ({MESSAGE_BODIES}) AS sent_bodies""",
)
def _(spark, sf_dir):
    root = scratch_dir(spark, "messages")
    stream = C.message_files(spark, message_folder(spark, sf_dir, root), files_per_batch=1)
    reading = (
        stream.select("ack_id", "message.data")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/received")
    )
    reading.awaitTermination()
    return spark.read.schema("ack_id string, data string").parquet(f"{root}/received")


@query(
    "completion_apply",
    f"""WITH ledger AS ({LEDGER}), {SENT}, {TRIAGED},
    done AS (SELECT DISTINCT row_id FROM triaged WHERE outcome = 'success')
    SELECT id, event_id, is_completed, is_scrapped OR row_id IS NOT NULL AS is_scrapped,
      row_id IS NOT NULL OR is_scrapped AS has_time
    FROM ledger LEFT JOIN done ON row_id = id""",
)
def _(spark, sf_dir):
    """The ledger version written after the stream, which then has no batch folders left."""
    root = scratch_dir(spark, "apply")
    stream = C.message_files(spark, message_folder(spark, sf_dir, root), files_per_batch=1)
    writer = C.completion_apply(stream, f"{root}/outcomes", f"{root}/checkpoint")
    ledger_job.start_ledger(spark, f"{root}/ledger", ledger(spark, sf_dir))
    writer.trigger(availableNow=True).start().awaitTermination()
    refreshed = ledger_job.refresh_ledger(spark, f"{root}/ledger", f"{root}/outcomes")
    return read_ledger(spark, refreshed.version.path).select(
        "id", "event_id", "is_completed", "is_scrapped",
        F.col("last_scraped").isNotNull().alias("has_time"),
    )


@query(
    "dead_letter_route",
    f"""WITH {SENT}, {TRIAGED} SELECT row_id, TRUE AS reached FROM triaged
    WHERE outcome = 'failed' GROUP BY row_id HAVING count(*) >= 5""",
)
def _(spark, sf_dir):
    """Each row once, however many failures follow; the batch decides the count seen."""
    root = scratch_dir(spark, "letters")
    stream = C.message_files(spark, message_folder(spark, sf_dir, root), files_per_batch=1)
    writer = C.dead_letter_route(stream, f"{root}/letters", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    letters = spark.read.schema(C.DEAD_LETTER_SCHEMA).parquet(f"{root}/letters")
    return letters.select("row_id", (F.col("failures") >= C.MAX_FAILURES).alias("reached"))
