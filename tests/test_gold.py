import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstrata.operators import gold, quantiles
from snapstrata.operators.cleaning import silver_transform
from snapstrata.operators.quantiles import exact_quantiles
from tests.samples import bronze, row

DAY = datetime.date


@pytest.fixture(scope="module")
def latest(spark):
    rows = bronze(
        spark,
        row(),
        row(map="bind", kills=10, deaths=0, rating=None, rounds_played=10,
            clutches_won_played_ratio=None),
        row(agent="omen", event_id=2, rating=2.25, rounds_played=60, kills=0, deaths=20),
        row(player_id=8, region="kr", org="X", kills=4, deaths=0, clutches_won_played_ratio="0/0"),
    )
    return silver_transform(rows)


def by(df, *key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def test_career(latest):
    found = by(gold.gold_player_career(latest), "player_id")
    ace = found[(7,)]
    assert (ace["events"], ace["maps"], ace["agents"]) == (2, 2, 2)
    assert (ace["kills"], ace["deaths"], ace["kill_deaths"]) == (40, 40, 1.0)
    assert ace["rating"] == (1.25 * 20 + 2.25 * 60) / 80
    assert (ace["clutches_won"], ace["clutches_played"]) == (4, 6)
    assert ace["clutch_rate"] == 4 / 6
    other = found[(8,)]
    assert other["kill_deaths"] == 4.0 and other["clutch_rate"] is None


def test_team_map_event_and_agent_map(latest):
    teams = by(gold.gold_team_rollup(latest), "org")
    assert teams[("TEAM",)]["players"] == 1 and teams[("X",)]["kills"] == 4
    maps = by(gold.gold_map_metrics(latest), "map")
    assert maps[("bind",)]["entities"] == 1 and maps[("bind",)]["rating"] is None
    events = by(gold.gold_event_summary(latest), "event_id")
    assert (events[(1,)]["players"], events[(1,)]["regions"]) == (2, 2)
    assert set(by(gold.gold_agent_map(latest), "agent", "map")) == {
        ("jett", "haven"), ("jett", "bind"), ("omen", "haven"),
    }


def test_regions_against_the_overall_mean(latest):
    found = by(gold.gold_region_comparison(latest), "region")
    overall = (1.25 * 20 + 2.25 * 60 + 1.25 * 20) / 100
    assert found[("kr",)]["rating_vs_overall"] == 1.25 - overall
    assert found[("eu",)]["rating_vs_overall"] == 2.0 - overall


def test_agents_share_and_quartiles(latest):
    found = by(gold.gold_agent_distribution(latest), "agent")
    assert found[("jett",)]["rounds_share"] == 50 / 110
    assert found[("omen",)]["rating_p50"] == 2.25
    assert found[("jett",)]["rating_p25"] == 1.25


def test_gold_of_nothing_is_empty(latest):
    for name, table in gold.GOLD_TABLES.items():
        assert table(latest.where("false")).collect() == [], name


@pytest.mark.parametrize("seed, sorted_values, cuts", [(1, 50_000, 256), (2, 200, 256), (3, 7, 4)])
def test_exact_quantiles_match_numpy_under_skew(spark, monkeypatch, seed, sorted_values, cuts):
    """In one range, after a round of cutting the hot group, and after several."""
    monkeypatch.setattr(quantiles, "CUTS", cuts)
    rng = random.Random(seed)
    data = [("hot", rng.gauss(0, 1)) for _ in range(4000)]
    data += [("hot", 5.0)] * 3000
    data += [("ties", float(rng.randint(0, 3))) for _ in range(500)]
    data += [("one", 7.5), ("two", -1.0), ("two", 2.0), ("none", None)]
    data += [(None, 1.0), (None, 3.0)]
    rows = spark.createDataFrame(data, "k string, v double").withColumn("w", -F.col("v"))
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = by(exact_quantiles(rows, "k", ["v", "w"], probabilities, sorted_values), "k")
    assert set(found) == {("hot",), ("ties",), ("one",), ("two",), (None,)}
    for (key,), result in found.items():
        values = np.array([v for k, v in data if k == key])
        for p in probabilities:
            name = f"p{round(p * 100):02d}"
            assert result[f"v_{name}"] == pytest.approx(np.quantile(values, p), abs=1e-12)
            assert result[f"w_{name}"] == pytest.approx(np.quantile(-values, p), abs=1e-12)


def test_no_range_holds_more_values_than_a_task_sorts(spark):
    """Very uneven values: half of them within a thousandth, others over many magnitudes."""
    rng = random.Random(5)
    data = [("hot", rng.random() / 1000) for _ in range(6000)]
    data += [("hot", 10 ** rng.uniform(-300, 300)) for _ in range(6000)]
    rows = spark.createDataFrame(data, "k string, v double")
    counts = quantiles._value_counts(rows, "k", ["v"])
    ranges = quantiles.wanted_ranges(counts, [0.25, 0.5, 0.75], 100).collect()
    assert 0 < len(ranges) <= 6 and all(r._values <= 100 for r in ranges)
    assert sum(len(r._wants) for r in ranges) == 6
