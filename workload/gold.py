"""Gold aggregates over the latest state."""

from __future__ import annotations

from snapstrata.operators import gold
from snapstrata.session import scratch_dir
from snapstrata.sources.lake import write_gold
from workload.registry import query
from workload.silver import WITH_LATEST, latest_silver

COUNTS = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}"
    for c in ("rounds_played", "kills", "deaths", "assists", "first_kills", "first_deaths")
)
KILL_DEATHS = """CASE WHEN sum(deaths) = 0 THEN CAST(sum(kills) AS DOUBLE)
  ELSE CAST(sum(kills) AS DOUBLE) / CAST(sum(deaths) AS DOUBLE) END AS kill_deaths"""
CLUTCHES = """CAST(sum(clutches_won) AS BIGINT) AS clutches_won,
  CAST(sum(clutches_played) AS BIGINT) AS clutches_played,
  CASE WHEN sum(clutches_played) <> 0
    THEN CAST(sum(clutches_won) AS DOUBLE) / CAST(sum(clutches_played) AS DOUBLE) END
  AS clutch_rate"""


def mean(column: str) -> str:
    weight = f"sum(CASE WHEN {column} IS NOT NULL THEN rounds_played END)"
    return f"""CASE WHEN {weight} <> 0 THEN
      CAST(sum(CAST({column} AS DECIMAL(18,4)) * rounds_played) AS DOUBLE)
      / CAST({weight} AS DOUBLE) END"""


RATE_COLUMNS = {
    "rating": "rating",
    "acs": "average_combat_score",
    "adr": "average_damage_per_round",
    "kast": "kill_assists_survived_traded",
    "headshot_rate": "headshot_percentage",
}
RATES = ", ".join(f"{mean(c)} AS {name}" for name, c in RATE_COLUMNS.items())


def distinct(**columns: str) -> str:
    return ", ".join(f"count(DISTINCT {c}) AS {name}" for name, c in columns.items())


@query(
    "gold_player_career",
    f"""{WITH_LATEST} SELECT player_id,
    {distinct(events='event_id', maps='map', agents='agent')},
    {COUNTS}, {KILL_DEATHS}, {RATES}, {CLUTCHES},
    max(max_kills_in_single_map) AS max_kills_in_single_map,
    max(snapshot_date) AS last_snapshot FROM latest GROUP BY player_id""",
)
def _(spark, sf_dir):
    return gold.gold_player_career(latest_silver(spark, sf_dir))


MEASURES = ["rating", "average_combat_score", "average_damage_per_round"]


def quartile(column: str, p: float) -> str:
    """Interpolated order statistic from ranks, as an aggregate over ``ranked``."""
    position = f"{p} * (n_{column} - 1)"

    def at(edge: str) -> str:
        return f"max(CASE WHEN r_{column} - 1 = {edge}({position}) THEN {column} END)"

    share = f"max({position} - floor({position}))"
    return f"{at('floor')} + ({at('ceil')} - {at('floor')}) * {share}"


QUARTILES = ", ".join(
    f"{quartile(c, p)} AS {c}_p{round(100 * p)}" for c in MEASURES for p in (0.25, 0.5, 0.75)
)
RANKED = ", ".join(
    f"""row_number() OVER (PARTITION BY agent ORDER BY {c} NULLS LAST) AS r_{c},
    count({c}) OVER (PARTITION BY agent) AS n_{c}"""
    for c in MEASURES
)


@query(
    "gold_agent_distribution",
    f"""{WITH_LATEST}, ranked AS (SELECT *, {RANKED} FROM latest),
    totals AS (SELECT agent, count(*) AS entities, {distinct(players='player_id')},
      CAST(sum(rounds_played) AS BIGINT) AS rounds_played, {RATES},
      CAST(sum(rounds_played) AS DOUBLE)
        / CAST((SELECT sum(rounds_played) FROM latest) AS DOUBLE) AS rounds_share
      FROM latest GROUP BY agent),
    spread AS (SELECT agent, {QUARTILES} FROM ranked GROUP BY agent)
    SELECT * FROM totals JOIN spread USING (agent)""",
)
def _(spark, sf_dir):
    """From the written latest state, as in the Gold job."""
    state = write_gold(latest_silver(spark, sf_dir), scratch_dir(spark, "gold"), "latest_state")
    return gold.gold_agent_distribution(spark.read.parquet(state))


@query(
    "gold_map_metrics",
    f"""{WITH_LATEST} SELECT map, count(*) AS entities,
    {distinct(players='player_id', agents='agent', events='event_id')},
    {COUNTS}, {KILL_DEATHS}, {RATES}, {CLUTCHES} FROM latest GROUP BY map""",
)
def _(spark, sf_dir):
    return gold.gold_map_metrics(latest_silver(spark, sf_dir))


@query(
    "gold_team_rollup",
    f"""{WITH_LATEST} SELECT org, {distinct(players='player_id', events='event_id')},
    {COUNTS}, {KILL_DEATHS}, {RATES}, {CLUTCHES} FROM latest GROUP BY org""",
)
def _(spark, sf_dir):
    return gold.gold_team_rollup(latest_silver(spark, sf_dir))


@query(
    "gold_event_summary",
    f"""{WITH_LATEST} SELECT event_id,
    {distinct(players='player_id', orgs='org', maps='map', agents='agent', regions='region')},
    {COUNTS}, {KILL_DEATHS}, {RATES}, {CLUTCHES},
    min(snapshot_date) AS first_snapshot, max(snapshot_date) AS last_snapshot
    FROM latest GROUP BY event_id""",
)
def _(spark, sf_dir):
    return gold.gold_event_summary(latest_silver(spark, sf_dir))


OVERALL = ", ".join(f"{mean(c)} AS overall_{name}" for name, c in RATE_COLUMNS.items())


@query(
    "gold_region_comparison",
    f"""{WITH_LATEST}, overall AS (SELECT {OVERALL} FROM latest),
    regions AS (SELECT region, count(*) AS entities, {COUNTS}, {KILL_DEATHS}, {RATES}
      FROM latest GROUP BY region)
    SELECT regions.*, {', '.join(f'{n} - overall_{n} AS {n}_vs_overall' for n in RATE_COLUMNS)}
    FROM regions, overall""",
)
def _(spark, sf_dir):
    return gold.gold_region_comparison(latest_silver(spark, sf_dir))


@query(
    "gold_agent_map",
    f"""{WITH_LATEST} SELECT agent, map, count(*) AS entities, {distinct(players='player_id')},
    {COUNTS}, {KILL_DEATHS}, {RATES}, {CLUTCHES} FROM latest GROUP BY agent, map""",
)
def _(spark, sf_dir):
    return gold.gold_agent_map(latest_silver(spark, sf_dir))
