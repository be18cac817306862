"""Bronze to Silver, step by step. Every step but the dedup is a narrow projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.functions.numbers import percent_to_fraction, ratio, ratio_part
from snapstrata.operators.latest import dedup_latest
from snapstrata.schemas import LINEAGE_COLUMNS, PIPELINE_VERSION, SILVER_COLUMNS

PERCENT_COLUMNS = [
    "kill_assists_survived_traded",
    "headshot_percentage",
    "clutch_success_percentage",
]


def drop_redundant_column(df: DataFrame) -> DataFrame:
    """The ``agent`` partition column is the truth, ``agents`` repeats it."""
    return df.drop("agents")


def derive_kill_deaths(df: DataFrame) -> DataFrame:
    """Fill a missing K/D: kills when nobody died, else the rounded quotient."""
    derived = F.when(F.col("deaths") == 0, F.col("kills").cast("double")).otherwise(
        ratio(F.col("kills"), F.col("deaths"))
    )
    return df.withColumn("kill_deaths", F.coalesce("kill_deaths", derived))


def derive_first_kills_per_round(df: DataFrame) -> DataFrame:
    derived = ratio(F.col("first_kills"), F.col("rounds_played"))
    return df.withColumn("first_kills_per_round", F.coalesce("first_kills_per_round", derived))


def normalize_percentages(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or [c for c in PERCENT_COLUMNS if c in df.columns]
    return df.withColumns({c: percent_to_fraction(F.col(c)) for c in columns})


def parse_clutch_ratio(df: DataFrame) -> DataFrame:
    text = F.col("clutches_won_played_ratio")
    return df.withColumns(
        {"clutches_won": ratio_part(text, 0), "clutches_played": ratio_part(text, 1)}
    )


def clutch_success_rate(df: DataFrame) -> DataFrame:
    """0.0 when all were lost, null when none were played."""
    won, played = F.col("clutches_won"), F.col("clutches_played")
    return df.withColumn("clutch_success_rate", F.when(played > 0, ratio(won, played)))


def drop_raw_clutch_columns(df: DataFrame) -> DataFrame:
    """The site leaves its percentage empty when none were won; ours replaces it."""
    return df.drop("clutches_won_played_ratio", "clutch_success_percentage")


def trim_identity_strings(df: DataFrame) -> DataFrame:
    """Outer blanks only: case is part of a player's and an organisation's identity."""
    return df.withColumns({c: F.trim(c) for c in ("player", "org")})


def add_metadata(df: DataFrame, version: str = PIPELINE_VERSION) -> DataFrame:
    return df.withColumn("_pipeline_version", F.lit(version))


def clean_columns(df: DataFrame, version: str = PIPELINE_VERSION) -> DataFrame:
    """All narrow steps after the dedup, in order."""
    return (
        df.transform(derive_kill_deaths)
        .transform(derive_first_kills_per_round)
        .transform(normalize_percentages, ["kill_assists_survived_traded", "headshot_percentage"])
        .transform(parse_clutch_ratio)
        .transform(clutch_success_rate)
        .transform(drop_raw_clutch_columns)
        .transform(trim_identity_strings)
        .transform(add_metadata, version)
    )


def silver_transform(
    bronze: DataFrame, version: str = PIPELINE_VERSION, row_version: str | None = None
) -> DataFrame:
    """Typed Silver rows, one per natural key.

    ``row_version`` names a column (a file time, say) whose highest value wins
    among duplicates. Lineage columns appear when the input carries them.
    """
    rows = dedup_latest(drop_redundant_column(bronze), row_version=row_version)
    silver = clean_columns(rows, version)
    keep = [c for c in SILVER_COLUMNS if c in silver.columns or c not in LINEAGE_COLUMNS]
    return silver.select(*keep)
