"""Row and null counts: as a query, or observed while a job runs."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """One row: nulls per column, one partial aggregate over the input."""
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_count_profile(df: DataFrame) -> DataFrame:
    """``column_name, null_count`` for the columns that have nulls."""
    counts = null_counts(df)
    return counts.unpivot([], list(counts.columns), "column_name", "null_count").where(
        F.col("null_count") > 0
    )


def row_count_metrics(before: DataFrame, key: list[str]) -> DataFrame:
    """Rows read and rows left after keeping one per key, without two passes.

    Counting per key first lets a hot key collapse before the shuffle.
    """
    per_key = before.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_deduplicated"),
    )


def observe_rows(df: DataFrame, observation: Observation) -> DataFrame:
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def observe_nulls(df: DataFrame, observation: Observation) -> DataFrame:
    """Row and null counts of a table while it is written; no extra pass."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *nulls)


def observed_counts(observation: Observation) -> dict[str, int]:
    """Counts of a finished action; empty when no row came by.

    Adaptive execution plans an empty input away, observation included, and
    then there is no result row to convert.
    """
    try:
        return observation.get
    except Py4JJavaError as error:
        if "assertion failed" in str(error.java_exception):
            return {}
        raise
