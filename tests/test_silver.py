import datetime

import pytest
from pyspark.sql import functions as F

from snapstrata.operators import cleaning, filters, latest, metrics, snapshots
from snapstrata.schemas import ENTITY_KEY, LINEAGE_COLUMNS, NATURAL_KEY, SILVER_COLUMNS
from tests.samples import bronze, row

DAY = datetime.date


def rows_of(df):
    return sorted(map(str, df.collect()))


def first(df):
    return df.collect()[0].asDict()


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({"kill_deaths": None, "deaths": 0, "kills": 9}, 9.0),
        ({"kill_deaths": None, "deaths": 4, "kills": 9}, 2.25),
        ({"kill_deaths": None, "deaths": 3, "kills": 2}, 0.67),
        ({"kill_deaths": None, "deaths": None}, None),
        ({"kill_deaths": None, "kills": None}, None),
        ({"kill_deaths": 0.0, "deaths": 0}, 0.0),
    ],
)
def test_kill_deaths(spark, changes, expected):
    assert first(cleaning.silver_transform(bronze(spark, row(**changes))))["kill_deaths"] == expected


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({"first_kills_per_round": None, "first_kills": 0}, 0.0),
        ({"first_kills_per_round": None, "first_kills": 1, "rounds_played": 3}, 0.33),
        ({"first_kills_per_round": None, "rounds_played": 0}, None),
        ({"first_kills_per_round": None, "rounds_played": None}, None),
        ({"first_kills_per_round": 0.5, "rounds_played": 0}, 0.5),
    ],
)
def test_first_kills_per_round(spark, changes, expected):
    found = first(cleaning.silver_transform(bronze(spark, row(**changes))))
    assert found["first_kills_per_round"] == expected


@pytest.mark.parametrize(
    "ratio, won, played, rate",
    [
        ("2/3", 2, 3, 0.67), ("0/4", 0, 4, 0.0), ("0/0", 0, 0, None), (None, None, None, None),
        ("2", 2, None, None), ("x/y", None, None, None), ("x/2", None, 2, None),
    ],
)
def test_clutches(spark, ratio, won, played, rate):
    found = first(cleaning.silver_transform(bronze(spark, row(clutches_won_played_ratio=ratio))))
    assert [found[c] for c in ("clutches_won", "clutches_played", "clutch_success_rate")] == [
        won, played, rate,
    ]


def test_shape_of_silver(spark):
    silver = cleaning.silver_transform(bronze(spark, row()), "9.9.9")
    assert silver.columns == [
        c for c in SILVER_COLUMNS if c not in LINEAGE_COLUMNS or c == "_pipeline_version"
    ]
    found = first(silver)
    assert (found["player"], found["org"]) == ("Ace", "TEAM")
    assert found["kill_assists_survived_traded"] == 0.89
    assert found["headshot_percentage"] == 0.39
    assert found["_pipeline_version"] == "9.9.9"
    types = dict(silver.dtypes)
    assert types["clutches_won"] == "int" and types["snapshot_date"] == "date"


def test_with_lineage_all_31_columns(spark):
    rows = bronze(spark, row()).withColumns(
        {"_source_file": F.lit("f"), "_ingested_at": F.current_timestamp()}
    )
    assert cleaning.silver_transform(rows).columns == SILVER_COLUMNS


def test_dedup_does_not_depend_on_partitioning(spark):
    variants = [row(kills=k, rating=r, player_id=p)
                for p in range(5) for k in (3, 1, 2) for r in (None, 1.0, 0.5)]
    rows = bronze(spark, *variants, *variants)
    results = {tuple(rows_of(latest.dedup_latest(rows.repartition(n)))) for n in (1, 2, 7)}
    assert len(results) == 1
    found = latest.dedup_latest(rows)
    assert found.count() == 5 == found.select(*NATURAL_KEY).distinct().count()


def test_rows_equal_but_for_one_key_column_all_stay(spark):
    changes = [{}, {"player_id": 8}, {"snapshot_date": DAY(2024, 1, 2)}, {"agent": "omen"},
               {"map": "bind"}, {"event_id": 2}, {"region": "kr"}]
    rows = bronze(spark, *[row(**c) for c in changes], row())
    assert latest.dedup_latest(rows).count() == len(changes)


def test_higher_version_wins(spark):
    rows = bronze(spark, row(kills=1), row(kills=99)).withColumn(
        "v", F.when(F.col("kills") == 99, 2).otherwise(1)
    )
    assert first(latest.dedup_latest(rows, row_version="v"))["kills"] == 99
    # Totals only grow, so without a version the larger one is the newer row.
    assert first(latest.dedup_latest(rows.drop("v")))["kills"] == 99
    later = rows.drop("v").withColumn(
        "_ingested_at", F.to_timestamp(F.when(F.col("kills") == 1, "2024-01-02").otherwise("2024-01-01"))
    )
    assert first(latest.dedup_latest(later))["kills"] == 1
    assert first(latest.latest_bronze(later))["kills"] == 1


def test_hot_key_is_limited_before_the_shuffle(spark, capsys):
    rows = bronze(spark, *[row(kills=i % 7) for i in range(500)])
    latest.dedup_latest(rows).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def series(spark):
    days = [DAY(2024, 1, 1), DAY(2024, 1, 5), DAY(2024, 1, 10)]
    totals = [(22, 18), (45, 35), (45, 30)]
    rows = [row(snapshot_date=d, kills=k, rounds_played=r) for d, (k, r) in zip(days, totals)]
    return bronze(spark, *rows, row(player_id=8, kills=1), row(player_id=8, kills=2))


def test_fused_latest_equals_both_steps(spark):
    rows = cleaning.drop_redundant_column(series(spark))
    two = latest.latest_state(latest.dedup_latest(rows))
    assert rows_of(latest.latest_bronze(rows)) == rows_of(two)
    assert two.select(*ENTITY_KEY).distinct().count() == two.count() == 2


def test_trend_and_violations(spark):
    silver = cleaning.silver_transform(series(spark))
    trend = snapshots.snapshot_trend(silver).where("player_id = 7").orderBy("snapshot_date")
    assert [r.kills_change for r in trend.collect()] == [None, 23, 0]
    assert [r.previous_snapshot for r in trend.collect()][1] == DAY(2024, 1, 1)
    broken = snapshots.monotonic_violations(silver).collect()
    assert [(r.rounds_played, r.previous_rounds_played) for r in broken] == [(30, 35)]


def test_leaderboard_limits_each_event(spark):
    rows = spark.createDataFrame([(e, p, p % 5) for e in (1, 2) for p in range(20)],
                                 "event_id int, player_id int, kills long")
    board = snapshots.event_leaderboard(rows, "kills", 3).orderBy("event_id", "place").collect()
    assert [(r.event_id, r.player_id, r.place) for r in board] == [
        (e, p, i) for e in (1, 2) for i, p in enumerate((4, 9, 14), 1)
    ]


def test_null_profile(spark):
    rows = bronze(spark, row(rating=None), row(rating=None, org=None, player_id=1))
    found = {r.column_name: r.null_count for r in metrics.null_count_profile(rows).collect()}
    assert found == {"rating": 2, "org": 1}


def test_row_counts(spark):
    rows = bronze(spark, row(), row(), row(player_id=1))
    assert metrics.row_count_metrics(rows, NATURAL_KEY).first() == (3, 2)
    nothing = metrics.row_count_metrics(rows.where("false"), NATURAL_KEY)
    assert nothing.first() == (0, 0)


def test_stats_filter(spark):
    rows = bronze(
        spark, row(), row(rating=None, player_id=1), row(region="kr", player_id=2),
        row(rounds_played=3, player_id=3), row(snapshot_date=DAY(2023, 1, 1), player_id=4),
    )

    def kept(**limits):
        return {r.player_id for r in filters.stats_filter(rows, **limits).collect()}

    assert kept() == {7, 1, 2, 3, 4}
    assert kept(region="ALL", min_rating=0) == {7, 1, 2, 3, 4}
    assert kept(region="eu") == {7, 1, 3, 4}
    assert kept(min_rating=1.0) == {7, 2, 3, 4}
    assert kept(min_rounds=20) == {7, 1, 2, 4}
    assert kept(timespan="30d", as_of=DAY(2024, 1, 15)) == {7, 1, 2, 3}
    assert kept(event_id=2) == set()
    with pytest.raises(ValueError, match="as_of"):
        kept(timespan="30")
