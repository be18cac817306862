"""Silver to Gold."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from snapstrata.operators.gold import GOLD_TABLES, event_players
from snapstrata.operators.latest import advance_state, latest_state
from snapstrata.operators.snapshots import event_leaderboard, monotonic_violations, snapshot_trend
from snapstrata.schemas import LINEAGE_COLUMNS
from snapstrata.sources import versions
from snapstrata.sources.lake import read_silver, write_gold
from snapstrata.sources.versions import Version

LATEST = "latest_state"
#: The mark of a state that was built from all of Silver.
ALL_DATES = "all"
#: What the leaderboard is ordered by, and its places.
BOARD_MEASURE, BOARD_PLACES = "kills", 10


def build_gold(latest: DataFrame) -> dict[str, DataFrame]:
    tables = {name: build(latest) for name, build in GOLD_TABLES.items()}
    tables["event_leaderboard"] = event_leaderboard(event_players(latest), BOARD_MEASURE, BOARD_PLACES)
    return tables


def build_series(silver: DataFrame) -> dict[str, DataFrame]:
    """Tables over all snapshots of an entity."""
    return {"snapshot_trend": snapshot_trend(silver), "monotonic_violations": monotonic_violations(silver)}


def refresh_latest_state(
    spark: SparkSession, silver_path: str, gold_path: str, snapshot_date: datetime.date | str | None = None
) -> Version:
    """The next version of the stored state; its mark names the date that it was advanced by.

    With a date and a state that is stored already, only that state and that date's rows are read.
    Every date that is written to Silver, late and repeated ones too, has to be brought once.
    """
    root = f"{gold_path.rstrip('/')}/{LATEST}"
    silver = read_silver(spark, silver_path).drop(*LINEAGE_COLUMNS)
    held = versions.current_version(spark, root)
    if held is None or snapshot_date is None:
        version = versions.publish(spark, root, latest_state(silver), ALL_DATES)
    else:
        state = spark.read.parquet(held.path)
        version = versions.publish(spark, root, advance_state(state, silver, snapshot_date), str(snapshot_date))
    versions.drop_versions(spark, root)
    return version


def refresh_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    snapshot_date: datetime.date | str | None = None,
    series: bool = True,
) -> dict[str, str]:
    """Bring the latest state up to date, then write every aggregate from it.

    The stored state cuts the lineage: each aggregate reads its own columns from Parquet, and a
    lost executor does not repeat the window over Silver. ``snapshot_date`` is the one date
    that Silver has gained since the last refresh; without it the state is built anew.
    ``series`` also writes trend and monotonic report, which read all of Silver.
    """
    paths = {LATEST: refresh_latest_state(spark, silver_path, gold_path, snapshot_date).path}
    tables = build_gold(spark.read.parquet(paths[LATEST]))
    if series:
        tables |= build_series(read_silver(spark, silver_path).drop(*LINEAGE_COLUMNS))
    for name, table in tables.items():
        paths[name] = write_gold(table, gold_path, name)
    return paths
