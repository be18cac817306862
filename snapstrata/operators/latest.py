"""Newest row per key.

Spark plans ``row_number() = 1`` as a group limit on both sides of the
shuffle: each map task sends at most one row per key, so a key that holds a
third of the table costs the reducer one row per map task.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from snapstrata.schemas import ENTITY_KEY, NATURAL_KEY
from snapstrata.session import kept

_RANK = "_rn"
_HASH = "_key_hash"
_INGESTED = "_ingested_at"
# Rewritten by the job: says nothing about which row is newer.
_NOT_ORDERING = {_INGESTED, "_pipeline_version"}
# Totals that only grow: of rows ingested at the same time, the larger is the newer.
_CUMULATIVE = ("rounds_played", "kills", "deaths", "assists", "first_kills", "first_deaths")


def keyed(df: DataFrame, key: list[str]) -> tuple[DataFrame, WindowSpec]:
    """The rows with a hash of the key, and a window partitioned by hash and key.

    The groups are those of the key alone. The sort compares the first eight
    bytes before anything else; a hash there tells nearly all keys apart,
    where a leading column with few values would not.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(*key))
    return hashed, Window.partitionBy(_HASH, *key)


def first_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    hashed, window = keyed(df, key)
    ranked = hashed.withColumn(_RANK, F.row_number().over(window.orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK, _HASH)


def newest_first(df: DataFrame, key: list[str], row_version: str | None = None) -> list[Column]:
    """Ingestion time, version and cumulative counts, latest first, then every other column.

    Rows left in a tie are equal anyway.
    """
    falling = [c for c in (_INGESTED, row_version, *_CUMULATIVE) if c in df.columns and c not in key]
    carried = [c for c in df.columns if c not in key and c not in _NOT_ORDERING and c not in falling]
    carried.sort(key=lambda c: c == "_source_file")
    return [F.col(c).desc_nulls_last() for c in falling] + [F.col(c).asc_nulls_last() for c in carried]


def dedup_latest(
    df: DataFrame, key: list[str] = NATURAL_KEY, row_version: str | None = None
) -> DataFrame:
    """One row per natural key: the latest ingested, then the highest version, then a total order.

    The result is the same however the input is partitioned.
    """
    return first_per_key(df, key, newest_first(df, key, row_version))


def latest_state(silver: DataFrame, key: list[str] = ENTITY_KEY) -> DataFrame:
    """Newest snapshot per entity of a table that is unique on the natural key."""
    return first_per_key(silver, key, [F.col("snapshot_date").desc_nulls_last()])


def _same_entity(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    """Equality on the key, where null equals null as it does within a window."""
    same = F.lit(True)
    for c in key:
        same = same & left[c].eqNullSafe(right[c])
    return same


def advance_state(
    state: DataFrame, silver: DataFrame, snapshot_date: datetime.date | str, key: list[str] = ENTITY_KEY
) -> DataFrame:
    """``latest_state`` of ``silver`` from a stored state that differs from it by one date at most.

    Reads the state and the rows of that date. The date may be new, late, or one that was written
    again. Only when a repeated date has lost entities are earlier dates looked at, and of
    these nothing but the entities lost.
    """
    date = F.lit(str(snapshot_date)).cast("date")
    brought = silver.where(F.col("snapshot_date") == date)
    held = state.where(~F.col("snapshot_date").eqNullSafe(date))
    before = state.where(F.col("snapshot_date") == date)
    lost = kept(before.select(*key).join(brought.select(*key), _same_entity(before, brought, key), "left_anti"), "lost")
    candidates = held.unionByName(brought.select(*state.columns))
    if not lost.isEmpty():
        earlier = silver.where(F.col("snapshot_date") < date)
        found = earlier.join(lost, _same_entity(earlier, lost, key), "left_semi")
        candidates = candidates.unionByName(latest_state(found, key).select(*state.columns))
    return latest_state(candidates, key)


def latest_bronze(bronze: DataFrame, row_version: str | None = None) -> DataFrame:
    """``latest_state`` of ``dedup_latest`` in one shuffle instead of two.

    The dedup winner of an entity's newest date is the first row by date,
    ingestion, version and tie-break within the entity.
    """
    order = [F.col("snapshot_date").desc_nulls_last()]
    return first_per_key(bronze, ENTITY_KEY, order + newest_first(bronze, NATURAL_KEY, row_version))
