"""Hand-written Bronze rows."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from snapstrata.schemas import BRONZE_COLUMNS, PARTITION_TYPES

DDL = ", ".join(f"{c} {t}" for c, t in BRONZE_COLUMNS + PARTITION_TYPES)

WHOLE = {
    "player_id": 7, "player": " Ace ", "org": " TEAM ", "agents": "jett", "rounds_played": 20,
    "rating": 1.25, "average_combat_score": 240.0, "kill_deaths": 1.5,
    "kill_assists_survived_traded": "89%", "average_damage_per_round": 150.0,
    "kills_per_round": 0.8, "assists_per_round": 0.2, "first_kills_per_round": 0.1,
    "first_deaths_per_round": 0.05, "headshot_percentage": "39%",
    "clutch_success_percentage": "67%", "clutches_won_played_ratio": "2/3",
    "max_kills_in_single_map": 22, "kills": 30, "deaths": 20, "assists": 5, "first_kills": 3,
    "first_deaths": 1, "event_id": 1, "region": "eu", "map": "haven", "agent": "jett",
    "snapshot_date": datetime.date(2024, 1, 1),
}


def row(**changes):
    return {**WHOLE, **changes}


def bronze(spark: SparkSession, *rows: dict) -> DataFrame:
    names = [c for c, _ in BRONZE_COLUMNS + PARTITION_TYPES]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], DDL)
