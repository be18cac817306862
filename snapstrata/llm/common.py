"""What the operators share: table access, scratch tables, deterministic buckets."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.session import scratch_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hands texts to Python workers in batches of at most 1,000 rows from now on.

    Batches go by rows; with whole documents the default of 10,000 takes much memory.
    """
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= MOST_BATCH_ROWS:
        spark.conf.set(BATCH_ROWS, str(MOST_BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(doc_id: Column, n: int) -> Column:
    """``crc32`` of the id as text, modulo ``n``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(n)


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Lets Spark remove a job's shuffle files as soon as its result is written."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write to the shared scratch folder and read again.

    Cuts the lineage with files that every executor reaches, so a lost executor
    costs only the tasks that it was running. ``path`` is given where the table is
    removed once nothing is read from it any more.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = path or scratch_dir(spark, label)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
