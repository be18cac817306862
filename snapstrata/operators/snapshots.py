"""Operators over the series of snapshots of one entity, and leaderboards.

The series operators take Silver rows, unique on the natural key, so a window
group holds one row per snapshot date: its size is bounded by the number of
snapshots taken, however many rows an event, a map or a player has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.operators.latest import keyed
from snapstrata.schemas import CUMULATIVE_COLUMNS, ENTITY_KEY

TREND_COLUMNS = ["rounds_played", "kills", "deaths", "assists", "rating", "average_combat_score"]


def snapshot_trend(silver: DataFrame, columns: list[str] = TREND_COLUMNS) -> DataFrame:
    """Change of each measure since the entity's previous snapshot, null at the first."""
    hashed, window = keyed(silver, ENTITY_KEY)
    series = window.orderBy("snapshot_date")
    return hashed.select(
        *ENTITY_KEY,
        "snapshot_date",
        F.lag("snapshot_date").over(series).alias("previous_snapshot"),
        *columns,
        *[(F.col(c) - F.lag(c).over(series)).alias(f"{c}_change") for c in columns],
    )


def monotonic_violations(
    silver: DataFrame, columns: list[str] = CUMULATIVE_COLUMNS
) -> DataFrame:
    """Rows where a cumulative total is lower than at the previous snapshot."""
    hashed, window = keyed(silver, ENTITY_KEY)
    series = window.orderBy("snapshot_date")
    rows = hashed.select(
        *ENTITY_KEY,
        "snapshot_date",
        *columns,
        *[F.lag(c).over(series).alias(f"previous_{c}") for c in columns],
    )
    fell = F.lit(False)
    for c in columns:
        fell = fell | (F.col(c) < F.col(f"previous_{c}"))
    return rows.where(fell)


def event_leaderboard(players: DataFrame, measure: str = "kills", size: int = 10) -> DataFrame:
    """Best players of each event by ``measure``, places 1 to ``size``.

    ``players`` has one row per event and player. The rank is limited before
    the shuffle too, so a crowded event sends ``size`` rows per map task.
    """
    order = [F.col(measure).desc_nulls_last(), F.col("player_id").asc()]
    place = F.rank().over(Window.partitionBy("event_id").orderBy(*order))
    return players.withColumn("place", place).where(F.col("place") <= size)
