"""Completion messages to ledger marks and dead letters.

The ledger itself is not rewritten per micro-batch. Each batch adds its marks
in a folder of its own; a replayed batch overwrites its own folder, so replays
change nothing. Offsets are committed after the batch function returns: update
first, acknowledge second. ``plans.ledger_job`` applies the folders to the next
version of the ledger and removes them; readers apply those that are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from snapstrata.functions.messages import base64_line, decode_message
from snapstrata.operators.ledger import mark_scraped_bulk, mark_scraped_guarded
from snapstrata.schemas import ENVELOPE_SCHEMA

SUCCESS, FAILED, MALFORMED = "success", "failed", "malformed"

# Fixed value: failures of one row after which it goes to the dead letters.
MAX_FAILURES = 5

# Fixed value: messages that the scheduled poll takes at once; pass it to keep its pace.
MESSAGES_PER_BATCH = 200

OUTCOME_SCHEMA = (
    "ack_id string, row_id bigint, blob_path string, error string, "
    "received_at timestamp, batch_id bigint, outcome string"
)
DEAD_LETTER_SCHEMA = "row_id bigint, failures bigint, batch_id bigint"


def message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of envelopes from JSON-lines files, a bounded number of files per batch."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def message_topic(
    spark: SparkSession, servers: str, topic: str, per_batch: int | None = None
) -> DataFrame:
    """The same stream from a Kafka topic; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().select(
        F.concat_ws("-", "topic", "partition", "offset").alias("ack_id"),
        F.struct(base64_line(F.col("value")).alias("data")).alias("message"),
    )


def completion_triage(messages: DataFrame) -> DataFrame:
    """Add body fields and ``outcome``.

    ``success`` marks the row, ``failed`` leaves it pending, ``malformed``
    (not base64, not a JSON object, or a success that names no row) is dropped
    so that it cannot block the stream.
    """
    decoded = messages.withColumn("_body", decode_message(F.col("message.data")))
    succeeded = F.coalesce(F.col("_body.success"), F.lit(False))
    outcome = (
        F.when(F.col("_body").isNull(), MALFORMED)
        .when(~succeeded, FAILED)
        .when(F.col("_body.row_id").isNull(), MALFORMED)
        .otherwise(SUCCESS)
    )
    return decoded.select(
        *[c for c in messages.columns if c != "message"],
        F.col("_body.row_id").alias("row_id"),
        F.col("_body.blob_path").alias("blob_path"),
        F.col("_body.error").alias("error"),
        outcome.alias("outcome"),
    )


def triage_counts(triaged: DataFrame) -> DataFrame:
    """Messages seen, rows to mark, messages to acknowledge, messages redelivered."""
    outcome = F.col("outcome")
    return triaged.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(outcome == SUCCESS).alias("to_mark"),
        F.count_if(outcome != FAILED).alias("to_ack"),
        F.count_if(outcome == FAILED).alias("redelivered"),
    )


def stream_dedup(successes: DataFrame) -> DataFrame:
    """One row per row id of an at-least-once batch; repeats fold in the map tasks."""
    return successes.groupBy("row_id").agg(
        F.min("blob_path").alias("blob_path"), F.count(F.lit(1)).alias("deliveries")
    )


def batch_folder(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def store_outcomes(batch: DataFrame, batch_id: int, outcomes_path: str) -> None:
    """Write one triaged batch into its own folder, split by outcome, in a single pass."""
    rows = batch.withColumn("received_at", F.current_timestamp())
    (
        rows.select("ack_id", "row_id", "blob_path", "error", "received_at", "outcome")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("outcome")
        .parquet(batch_folder(outcomes_path, batch_id))
    )


def completion_apply(
    messages: DataFrame, outcomes_path: str, checkpoint: str
) -> DataStreamWriter:
    """Writer that triages every batch and stores its outcomes; start it with a trigger."""
    return (
        completion_triage(messages)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: store_outcomes(batch, batch_id, outcomes_path))
    )


def read_outcomes(spark: SparkSession, outcomes_path: str) -> DataFrame:
    return spark.read.schema(OUTCOME_SCHEMA).parquet(outcomes_path)


def outcome_marks(
    outcomes: DataFrame, after_batch: int | None = None, through_batch: int | None = None
) -> DataFrame:
    """``row_id, marked_at`` of the successes; reads the success folders only.

    ``after_batch`` leaves out batches that a compacted ledger already holds, ``through_batch``
    those that it will not hold yet.
    """
    marks = outcomes.where(F.col("outcome") == SUCCESS)
    if after_batch is not None:
        marks = marks.where(F.col("batch_id") > after_batch)
    if through_batch is not None:
        marks = marks.where(F.col("batch_id") <= through_batch)
    return marks.select("row_id", F.col("received_at").alias("marked_at"))


def current_ledger(
    ledger: DataFrame,
    outcomes: DataFrame,
    guarded: bool = False,
    after_batch: int | None = None,
) -> DataFrame:
    """The ledger with stored marks applied. Written as a new version, it compacts them."""
    mark = mark_scraped_guarded if guarded else mark_scraped_bulk
    return mark(ledger, outcome_marks(outcomes, after_batch)).drop("changed")


def dead_letters(failures: DataFrame, threshold: int = MAX_FAILURES) -> DataFrame:
    """Rows of a table that failed ``threshold`` times or more, with their count.

    Counts recorded failures per row id, where a message broker would count
    deliveries per message: a stream commits a batch as a whole, so single
    messages are not sent again.
    """
    counts = failures.where(F.col("row_id").isNotNull()).groupBy("row_id")
    return counts.agg(F.count(F.lit(1)).alias("failures")).where(F.col("failures") >= threshold)


ROUTED_SCHEMA = "row_id bigint, failures bigint"
FAILURE_STATE = "failures bigint, routed boolean"


def routed_once(failures: DataFrame, threshold: int = MAX_FAILURES) -> DataFrame:
    """Stream of the rows that reach ``threshold`` failures, each in the batch in which it does.

    The state of a row id is its count and whether it has been routed, so a batch costs what it
    brings. Only ids are shuffled, and the failures of one id are counted batch by batch as they
    come out of the shuffle, never held together.
    """

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[Any]:
        seen, routed = state.get if state.exists else (0, False)
        seen += sum(len(batch) for batch in batches)
        reached = seen >= threshold and not routed
        state.update((seen, routed or reached))
        if reached:
            yield pd.DataFrame({"row_id": [key[0]], "failures": [seen]})

    return (
        failures.where(F.col("row_id").isNotNull())
        .select("row_id")
        .groupBy("row_id")
        .applyInPandasWithState(count, ROUTED_SCHEMA, FAILURE_STATE, "append", GroupStateTimeout.NoTimeout)
    )


def store_dead_letters(batch: DataFrame, batch_id: int, letters_path: str) -> None:
    """Write the letters of one batch into its own folder, which a replay replaces. Reads no other one."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        batch_folder(letters_path, batch_id)
    )


def dead_letter_route(
    messages: DataFrame, letters_path: str, checkpoint: str, threshold: int = MAX_FAILURES
) -> DataStreamWriter:
    """Writer that routes each row once, in the batch of its ``threshold``-th failure."""
    failed = completion_triage(messages).where(F.col("outcome") == FAILED)
    return (
        routed_once(failed, threshold)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: store_dead_letters(batch, batch_id, letters_path))
    )
