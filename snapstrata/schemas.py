"""Schemas, keys and fixed reference values shared by every layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column names, their order in the CSV files, and their types.
BRONZE_COLUMNS: list[tuple[str, str]] = [
    ("player_id", "int"),
    ("player", "string"),
    ("org", "string"),
    ("agents", "string"),
    ("rounds_played", "int"),
    ("rating", "double"),
    ("average_combat_score", "double"),
    ("kill_deaths", "double"),
    ("kill_assists_survived_traded", "string"),
    ("average_damage_per_round", "double"),
    ("kills_per_round", "double"),
    ("assists_per_round", "double"),
    ("first_kills_per_round", "double"),
    ("first_deaths_per_round", "double"),
    ("headshot_percentage", "string"),
    ("clutch_success_percentage", "string"),
    ("clutches_won_played_ratio", "string"),
    ("max_kills_in_single_map", "int"),
    ("kills", "int"),
    ("deaths", "int"),
    ("assists", "int"),
    ("first_kills", "int"),
    ("first_deaths", "int"),
]
BRONZE_FIELDS: list[str] = [name for name, _ in BRONZE_COLUMNS]

# Path segments of one partition, outermost first.
PARTITION_TYPES: list[tuple[str, str]] = [
    ("event_id", "int"),
    ("region", "string"),
    ("map", "string"),
    ("agent", "string"),
    ("snapshot_date", "date"),
]
PARTITION_COLUMNS: list[str] = [name for name, _ in PARTITION_TYPES]

# Fixed values. One row per natural key in Silver; an entity is followed over its snapshots.
NATURAL_KEY: list[str] = ["player_id", "snapshot_date", "agent", "map", "event_id", "region"]
ENTITY_KEY: list[str] = [c for c in NATURAL_KEY if c != "snapshot_date"]

# Totals that can only grow from one snapshot to the next.
CUMULATIVE_COLUMNS: list[str] = [
    "kills", "deaths", "assists", "rounds_played", "first_kills", "first_deaths",
]

# Columns of Silver in their order.
SILVER_COLUMNS: list[str] = [
    "player_id", "player", "org", "rounds_played", "rating", "average_combat_score",
    "kill_deaths", "kill_assists_survived_traded", "average_damage_per_round",
    "kills_per_round", "assists_per_round", "first_kills_per_round",
    "first_deaths_per_round", "headshot_percentage", "max_kills_in_single_map",
    "kills", "deaths", "assists", "first_kills", "first_deaths",
    "clutches_won", "clutches_played", "clutch_success_rate",
    "event_id", "region", "map", "agent", "snapshot_date",
    "_ingested_at", "_source_file", "_pipeline_version",
]
LINEAGE_COLUMNS: list[str] = ["_ingested_at", "_source_file", "_pipeline_version"]

# Fixed value.
PIPELINE_VERSION = "1.0.0"

# Columns of the ledger in their order.
LEDGER_COLUMNS: list[str] = [
    "id", "event_id", "map_id", "map_name", "region_abbr", "agent",
    "is_completed", "is_scrapped", "last_scraped",
]
LEDGER_SCHEMA = (
    "id bigint, event_id bigint, map_id string, map_name string, region_abbr string, "
    "agent string, is_completed boolean, is_scrapped boolean, last_scraped timestamp"
)

# Completion message: transport envelope around a base64 JSON body.
ENVELOPE_SCHEMA = "ack_id string, message struct<data: string>"

# Map ids the producers know. 4 and 7 do not exist.
MAP_NAMES: dict[str, str] = {
    "1": "bind",
    "2": "haven",
    "3": "split",
    "5": "ascent",
    "6": "icebox",
    "8": "breeze",
    "9": "fracture",
    "10": "pearl",
    "11": "lotus",
    "12": "sunset",
    "13": "abyss",
    "14": "corrode",
}


def map_values_sql() -> str:
    """The map dimension as the body of a SQL ``VALUES`` clause."""
    return ", ".join(f"('{k}', '{v}')" for k, v in MAP_NAMES.items())


def map_dimension(spark: SparkSession) -> DataFrame:
    """``map_id, map_name``. Inline values, so the planner knows their exact size."""
    return spark.sql(f"SELECT * FROM VALUES {map_values_sql()} AS t(map_id, map_name)")


def bronze_read_schema() -> str:
    """Text for every file column, declared types for the path columns.

    Numbers are cast after the read: the CSV reader turns `` 12 `` into null
    for an int column, a cast ignores the blanks around it.
    """
    ddl = [f"`{c}` string" for c in BRONZE_FIELDS]
    ddl += [f"`{c}` {t}" for c, t in PARTITION_TYPES]
    return ", ".join(ddl)
