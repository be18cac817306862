"""Gold aggregates over the latest state of every entity.

Totals are cumulative, so only the newest snapshot of an entity counts.
Counts are summed; K/D is the quotient of the sums; rates are means weighted
by rounds over rows that have both; a clutch rate is won over played.
All groupings aggregate in the map tasks first, so a dominant key reaches the
shuffle as one row per task, and distinct counts are spread over their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.functions.numbers import quotient, weighted_mean, weighted_sums
from snapstrata.operators.quantiles import exact_quantiles
from snapstrata.session import kept

# Output name of each rate and the Silver column it averages.
RATES = {
    "rating": "rating",
    "acs": "average_combat_score",
    "adr": "average_damage_per_round",
    "kast": "kill_assists_survived_traded",
    "headshot_rate": "headshot_percentage",
}
DISTRIBUTION_COLUMNS = ["rating", "average_combat_score", "average_damage_per_round"]
QUARTILES = [0.25, 0.5, 0.75]


def _total(column: str) -> Column:
    return F.sum(F.col(column).cast("bigint")).alias(column)


def _counts() -> list[Column]:
    return [
        _total(c)
        for c in ("rounds_played", "kills", "deaths", "assists", "first_kills", "first_deaths")
    ]


def _kill_deaths() -> Column:
    kills, deaths = F.sum(F.col("kills").cast("bigint")), F.sum(F.col("deaths").cast("bigint"))
    return (
        F.when(deaths == 0, kills.cast("double")).otherwise(quotient(kills, deaths))
    ).alias("kill_deaths")


def _rates() -> list[Column]:
    return [
        weighted_mean(F.col(column), F.col("rounds_played")).alias(name)
        for name, column in RATES.items()
    ]


def _clutches() -> list[Column]:
    won = F.sum(F.col("clutches_won").cast("bigint"))
    played = F.sum(F.col("clutches_played").cast("bigint"))
    return [
        won.alias("clutches_won"),
        played.alias("clutches_played"),
        quotient(won, played).alias("clutch_rate"),
    ]


def _distinct(**columns: str) -> list[Column]:
    return [F.count_distinct(F.col(c)).alias(name) for name, c in columns.items()]


def gold_player_career(latest: DataFrame) -> DataFrame:
    return latest.groupBy("player_id").agg(
        *_distinct(events="event_id", maps="map", agents="agent"),
        *_counts(), _kill_deaths(), *_rates(), *_clutches(),
        F.max("max_kills_in_single_map").alias("max_kills_in_single_map"),
        F.max("snapshot_date").alias("last_snapshot"),
    )


def gold_agent_distribution(latest: DataFrame) -> DataFrame:
    """Per agent: totals, share of all rounds, quartiles of the main measures.

    Looks at ``latest`` twice: for the totals, and to count the values of the measures.
    """
    totals = latest.groupBy("agent").agg(
        F.count(F.lit(1)).alias("entities"),
        *_distinct(players="player_id"),
        _total("rounds_played"),
        *_rates(),
    )
    # One row per agent, kept: the share of all rounds is taken from these totals.
    totals = kept(totals, "agent-totals")
    rounds = totals.agg(F.sum("rounds_played")).scalar()
    totals = totals.withColumn("rounds_share", quotient(F.col("rounds_played"), rounds))
    spread = exact_quantiles(latest, "agent", DISTRIBUTION_COLUMNS, QUARTILES)
    spread = spread.withColumnRenamed("agent", "_agent")
    return totals.join(
        spread, totals["agent"].eqNullSafe(spread["_agent"]), "left"
    ).drop("_agent")


def gold_map_metrics(latest: DataFrame) -> DataFrame:
    return latest.groupBy("map").agg(
        F.count(F.lit(1)).alias("entities"),
        *_distinct(players="player_id", agents="agent", events="event_id"),
        *_counts(), _kill_deaths(), *_rates(), *_clutches(),
    )


def gold_team_rollup(latest: DataFrame) -> DataFrame:
    """Totals and clutch rate per organisation.

    No column tells who won a match, so there is no win rate.
    """
    return latest.groupBy("org").agg(
        *_distinct(players="player_id", events="event_id"),
        *_counts(), _kill_deaths(), *_rates(), *_clutches(),
    )


def gold_event_summary(latest: DataFrame) -> DataFrame:
    return latest.groupBy("event_id").agg(
        *_distinct(players="player_id", orgs="org", maps="map", agents="agent", regions="region"),
        *_counts(), _kill_deaths(), *_rates(), *_clutches(),
        F.min("snapshot_date").alias("first_snapshot"),
        F.max("snapshot_date").alias("last_snapshot"),
    )


def gold_region_comparison(latest: DataFrame) -> DataFrame:
    """Rates per region and their difference to the mean over all regions' rows.

    The overall mean is one row computed from the regional sums.
    """
    sums: list[Column] = []
    for name, column in RATES.items():
        top, bottom = weighted_sums(F.col(column), F.col("rounds_played"))
        sums += [top.alias(f"_{name}_top"), bottom.alias(f"_{name}_bottom")]
    regions = latest.groupBy("region").agg(
        F.count(F.lit(1)).alias("entities"), *_counts(), _kill_deaths(), *sums
    )
    overall = regions.agg(
        F.struct(
            *[
                quotient(F.sum(f"_{name}_top"), F.sum(f"_{name}_bottom")).alias(name)
                for name in RATES
            ]
        ).alias("means")
    ).scalar()
    shown = regions.select(
        "region", "entities", "rounds_played", "kills", "deaths", "assists",
        "first_kills", "first_deaths", "kill_deaths",
        *[quotient(F.col(f"_{n}_top"), F.col(f"_{n}_bottom")).alias(n) for n in RATES],
        overall.alias("_overall"),
    )
    return shown.withColumns(
        {f"{n}_vs_overall": F.col(n) - F.col("_overall").getField(n) for n in RATES}
    ).drop("_overall")


def gold_agent_map(latest: DataFrame) -> DataFrame:
    """Performance per agent and map; no outcome column, so no win rate."""
    return latest.groupBy("agent", "map").agg(
        F.count(F.lit(1)).alias("entities"),
        *_distinct(players="player_id"),
        *_counts(), _kill_deaths(), *_rates(), *_clutches(),
    )


def event_players(latest: DataFrame) -> DataFrame:
    """One row per event and player, the input of the leaderboard."""
    return latest.groupBy("event_id", "player_id").agg(
        *_counts(), _kill_deaths(), *_rates(), *_clutches()
    )


GOLD_TABLES = {
    "player_career": gold_player_career,
    "agent_distribution": gold_agent_distribution,
    "map_metrics": gold_map_metrics,
    "team_rollup": gold_team_rollup,
    "event_summary": gold_event_summary,
    "region_comparison": gold_region_comparison,
    "agent_map": gold_agent_map,
}
