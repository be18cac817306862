"""Bronze to Silver steps, quality counts and snapshot series."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.operators import cleaning, filters, latest, metrics, snapshots
from snapstrata.operators.gold import event_players
from snapstrata.schemas import NATURAL_KEY
from snapstrata.session import scratch_dir
from snapstrata.sources import versions
from workload.registry import query
from workload.views import BRONZE, bronze

KEY = "player_id, snapshot_date, agent, map, event_id, region"
ENTITY = "player_id, agent, map, event_id, region"

# Larger totals are newer; then every carried column in file order, so that the winner is defined.
COUNTS_DOWN = ("rounds_played", "kills", "deaths", "assists", "first_kills", "first_deaths")
TIE = ", ".join(f"{c} DESC NULLS LAST" for c in COUNTS_DOWN) + ", " + ", ".join(
    f"{c} ASC NULLS LAST"
    for c in (
        "player", "org", "rounds_played", "rating", "average_combat_score", "kill_deaths",
        "kill_assists_survived_traded", "average_damage_per_round", "kills_per_round",
        "assists_per_round", "first_kills_per_round", "first_deaths_per_round",
        "headshot_percentage", "clutch_success_percentage", "clutches_won_played_ratio",
        "max_kills_in_single_map", "kills", "deaths", "assists", "first_kills", "first_deaths",
    )
)

KD = """CASE WHEN kill_deaths IS NOT NULL THEN kill_deaths
  WHEN deaths = 0 THEN CAST(kills AS DOUBLE)
  ELSE CAST((200 * kills + deaths) // (2 * deaths) AS DOUBLE) / 100 END"""
FKPR = """CASE WHEN first_kills_per_round IS NOT NULL THEN first_kills_per_round
  WHEN rounds_played = 0 THEN NULL
  ELSE CAST((200 * first_kills + rounds_played) // (2 * rounds_played) AS DOUBLE) / 100 END"""


def percent(column: str) -> str:
    return f"TRY_CAST(replace(trim({column}), '%', '') AS DOUBLE) / 100"


WON = "TRY_CAST(split_part(clutches_won_played_ratio, '/', 1) AS INTEGER)"
PLAYED = "TRY_CAST(split_part(clutches_won_played_ratio, '/', 2) AS INTEGER)"
CLUTCH_RATE = f"""CASE WHEN {PLAYED} > 0
  THEN CAST((200 * {WON} + {PLAYED}) // (2 * {PLAYED}) AS DOUBLE) / 100 END"""

DEDUP = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT * EXCLUDE (agents), row_number() OVER (PARTITION BY {KEY} ORDER BY {TIE}) AS rn
  FROM bronze) WHERE rn = 1"""
SILVER = f"""SELECT player_id, trim(player) AS player, trim(org) AS org, rounds_played, rating,
  average_combat_score, {KD} AS kill_deaths,
  {percent('kill_assists_survived_traded')} AS kill_assists_survived_traded,
  average_damage_per_round, kills_per_round, assists_per_round,
  {FKPR} AS first_kills_per_round, first_deaths_per_round,
  {percent('headshot_percentage')} AS headshot_percentage,
  max_kills_in_single_map, kills, deaths, assists, first_kills, first_deaths,
  {WON} AS clutches_won, {PLAYED} AS clutches_played, {CLUTCH_RATE} AS clutch_success_rate,
  event_id, region, map, agent, snapshot_date, '1.0.0' AS _pipeline_version
  FROM dedup"""
LATEST = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {ENTITY} ORDER BY snapshot_date DESC) AS rn
  FROM silver) WHERE rn = 1"""

WITH_BRONZE = f"WITH bronze AS ({BRONZE})"
WITH_DEDUP = f"{WITH_BRONZE}, dedup AS ({DEDUP})"
WITH_SILVER = f"{WITH_DEDUP}, silver AS ({SILVER})"
WITH_LATEST = f"{WITH_SILVER}, latest AS ({LATEST})"


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.silver_transform(bronze(spark, sf_dir))


def latest_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state straight from Bronze rows: one shuffle on the entity key."""
    rows = latest.latest_bronze(cleaning.drop_redundant_column(bronze(spark, sf_dir)))
    return cleaning.clean_columns(rows)


# Two ingestions: the later one wins whatever the totals say.
INGESTED = "CASE WHEN kills % 2 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END"


@query(
    "dedup_latest",
    f"""{WITH_BRONZE}, stamped AS (SELECT * EXCLUDE (agents), {INGESTED} AS _ingested_at FROM bronze)
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY {KEY} ORDER BY _ingested_at DESC, {TIE}) AS rn FROM stamped) WHERE rn = 1""",
)
def _(spark, sf_dir):
    rows = bronze(spark, sf_dir).withColumn("_ingested_at", F.expr(INGESTED))
    return latest.dedup_latest(cleaning.drop_redundant_column(rows))


@query("drop_redundant_column", f"{WITH_BRONZE} SELECT * EXCLUDE (agents) FROM bronze")
def _(spark, sf_dir):
    return cleaning.drop_redundant_column(bronze(spark, sf_dir))


@query(
    "add_metadata",
    f"{WITH_BRONZE} SELECT {KEY}, '1.0.0' AS _pipeline_version FROM bronze",
)
def _(spark, sf_dir):
    return cleaning.add_metadata(bronze(spark, sf_dir).select(*NATURAL_KEY))


@query(
    "derive_kill_deaths",
    f"{WITH_BRONZE} SELECT {KEY}, kills, deaths, {KD} AS kill_deaths FROM bronze",
)
def _(spark, sf_dir):
    rows = cleaning.derive_kill_deaths(bronze(spark, sf_dir))
    return rows.select(*NATURAL_KEY, "kills", "deaths", "kill_deaths")


@query(
    "derive_first_kills_per_round",
    f"""{WITH_BRONZE} SELECT {KEY}, first_kills, rounds_played, {FKPR} AS first_kills_per_round
    FROM bronze""",
)
def _(spark, sf_dir):
    rows = cleaning.derive_first_kills_per_round(bronze(spark, sf_dir))
    return rows.select(*NATURAL_KEY, "first_kills", "rounds_played", "first_kills_per_round")


@query(
    "percent_to_fraction",
    f"""{WITH_BRONZE} SELECT {KEY},
    {percent('kill_assists_survived_traded')} AS kill_assists_survived_traded,
    {percent('headshot_percentage')} AS headshot_percentage,
    {percent('clutch_success_percentage')} AS clutch_success_percentage FROM bronze""",
)
def _(spark, sf_dir):
    rows = cleaning.normalize_percentages(bronze(spark, sf_dir))
    return rows.select(*NATURAL_KEY, *cleaning.PERCENT_COLUMNS)


@query(
    "parse_clutch_ratio",
    f"""{WITH_BRONZE} SELECT {KEY}, clutches_won_played_ratio, {WON} AS clutches_won,
    {PLAYED} AS clutches_played FROM bronze""",
)
def _(spark, sf_dir):
    rows = cleaning.parse_clutch_ratio(bronze(spark, sf_dir))
    return rows.select(
        *NATURAL_KEY, "clutches_won_played_ratio", "clutches_won", "clutches_played"
    )


@query(
    "clutch_success_rate",
    f"{WITH_BRONZE} SELECT {KEY}, {CLUTCH_RATE} AS clutch_success_rate FROM bronze",
)
def _(spark, sf_dir):
    rows = cleaning.clutch_success_rate(cleaning.parse_clutch_ratio(bronze(spark, sf_dir)))
    return rows.select(*NATURAL_KEY, "clutch_success_rate")


@query(
    "drop_raw_clutch_columns",
    f"""{WITH_BRONZE} SELECT * EXCLUDE (clutches_won_played_ratio, clutch_success_percentage)
    FROM bronze""",
)
def _(spark, sf_dir):
    return cleaning.drop_raw_clutch_columns(bronze(spark, sf_dir))


@query(
    "trim_identity_strings",
    f"{WITH_BRONZE} SELECT {KEY}, trim(player) AS player, trim(org) AS org FROM bronze",
)
def _(spark, sf_dir):
    rows = cleaning.trim_identity_strings(bronze(spark, sf_dir))
    return rows.select(*NATURAL_KEY, "player", "org")


@query("silver_transform", f"{WITH_SILVER} SELECT * FROM silver")
def _(spark, sf_dir):
    return silver(spark, sf_dir)


def _null_profile_sql() -> str:
    columns = (
        "player_id, player, org, rounds_played, rating, average_combat_score, kill_deaths, "
        "kill_assists_survived_traded, average_damage_per_round, kills_per_round, "
        "assists_per_round, first_kills_per_round, first_deaths_per_round, headshot_percentage, "
        "max_kills_in_single_map, kills, deaths, assists, first_kills, first_deaths, "
        "clutches_won, clutches_played, clutch_success_rate, event_id, region, map, agent, "
        "snapshot_date, _pipeline_version"
    ).split(", ")
    branches = [
        f"SELECT '{c}' AS column_name, count(*) AS null_count FROM silver WHERE {c} IS NULL"
        for c in columns
    ]
    return f"""{WITH_SILVER} SELECT * FROM ({' UNION ALL '.join(branches)}) WHERE null_count > 0"""


@query("null_count_profile", _null_profile_sql())
def _(spark, sf_dir):
    return metrics.null_count_profile(silver(spark, sf_dir))


@query(
    "row_count_metrics",
    f"""{WITH_DEDUP} SELECT (SELECT count(*) FROM bronze) AS rows_read,
    (SELECT count(*) FROM dedup) AS rows_deduplicated""",
)
def _(spark, sf_dir):
    return metrics.row_count_metrics(bronze(spark, sf_dir), NATURAL_KEY)


@query(
    "stats_filter",
    f"""{WITH_SILVER} SELECT {KEY}, rounds_played, rating FROM silver
    WHERE region = 'eu' AND rounds_played >= 10 AND rating >= 0.5
      AND snapshot_date >= DATE '2000-01-01' - INTERVAL 1500 DAY
      AND snapshot_date <= DATE '2000-01-01'""",
)
def _(spark, sf_dir):
    rows = filters.stats_filter(
        silver(spark, sf_dir), region="eu", min_rounds=10, min_rating=0.5, timespan="1500",
        as_of=datetime.date(2000, 1, 1),
    )
    return rows.select(*NATURAL_KEY, "rounds_played", "rating")


@query("latest_state", f"{WITH_LATEST} SELECT * FROM latest")
def _(spark, sf_dir):
    return latest.latest_state(silver(spark, sf_dir))


@query("latest_state_advanced", f"{WITH_LATEST} SELECT * FROM latest")
def _(spark, sf_dir):
    """The stored state advanced date by date, late ones and a repeated one among them."""
    root = scratch_dir(spark, "state")
    silver(spark, sf_dir).write.partitionBy("snapshot_date").parquet(f"{root}/silver")
    rows = spark.read.parquet(f"{root}/silver")
    dates = [r[0] for r in rows.select("snapshot_date").distinct().orderBy(F.xxhash64("snapshot_date")).collect()]
    state = versions.publish(spark, f"{root}/state", latest.latest_state(rows.where(F.col("snapshot_date") == dates[0])), str(dates[0]))
    for date in [*dates[1:], dates[0]]:
        table = latest.advance_state(spark.read.parquet(state.path), rows, date)
        state = versions.publish(spark, f"{root}/state", table, str(date))
    return spark.read.parquet(state.path)


def _lag(column: str) -> str:
    return f"lag({column}) OVER (PARTITION BY {ENTITY} ORDER BY snapshot_date)"


_TREND = ["rounds_played", "kills", "deaths", "assists", "rating", "average_combat_score"]


@query(
    "snapshot_trend",
    f"""{WITH_SILVER} SELECT {ENTITY}, snapshot_date,
    {_lag('snapshot_date')} AS previous_snapshot, {', '.join(_TREND)},
    {', '.join(f'{c} - {_lag(c)} AS {c}_change' for c in _TREND)} FROM silver""",
)
def _(spark, sf_dir):
    return snapshots.snapshot_trend(silver(spark, sf_dir))


_TOTALS = ["kills", "deaths", "assists", "rounds_played", "first_kills", "first_deaths"]


@query(
    "monotonic_violations",
    f"""{WITH_SILVER} SELECT * FROM (SELECT {ENTITY}, snapshot_date, {', '.join(_TOTALS)},
    {', '.join(f'{_lag(c)} AS previous_{c}' for c in _TOTALS)} FROM silver)
    WHERE {' OR '.join(f'{c} < previous_{c}' for c in _TOTALS)}""",
)
def _(spark, sf_dir):
    return snapshots.monotonic_violations(silver(spark, sf_dir))


@query(
    "event_leaderboard",
    f"""{WITH_LATEST}, players AS (
      SELECT event_id, player_id, CAST(sum(kills) AS BIGINT) AS kills,
             CAST(sum(deaths) AS BIGINT) AS deaths,
             CAST(sum(rounds_played) AS BIGINT) AS rounds_played
      FROM latest GROUP BY event_id, player_id)
    SELECT * FROM (SELECT *, CAST(rank() OVER (
        PARTITION BY event_id ORDER BY kills DESC NULLS LAST, player_id) AS INTEGER) AS place
      FROM players) WHERE place <= 10""",
)
def _(spark, sf_dir):
    players = event_players(latest_silver(spark, sf_dir))
    board = snapshots.event_leaderboard(players, "kills", 10)
    return board.select("event_id", "player_id", "kills", "deaths", "rounds_played", "place")

