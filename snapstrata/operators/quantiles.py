"""Exact quantiles of large groups without holding a group in one task.

A built-in exact percentile keeps every distinct value of a group in one
task's memory, and a plain window sorts the whole group in one task. Here equal
values are counted first, which also is the only look at the input. What holds a wanted
rank is then narrowed in rounds: a range with too many values is cut by a sketch into
smaller ones, exact counts tell which of them holds the rank, and the rest is left.
The sketch only decides how even the ranges are, so the result does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.session import kept

#: Most distinct values that one task sorts.
SORTED_VALUES = 50_000
#: Ranges into which a round cuts a range that holds more.
CUTS = 256

_GROUP = ["_k", "_m"]
_RANGE = ["_k", "_m", "_low"]


def _value_counts(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``_k, _m, _v, _n``: how often each value of each column occurs per key."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.select(
        F.col(key).alias("_k"), F.expr(f"stack({len(columns)}, {pairs}) AS (_m, _v)")
    ).where(F.col("_v").isNotNull())
    return long.groupBy("_k", "_m", "_v").agg(F.count(F.lit(1)).alias("_n"))


def _whole_groups(counts: DataFrame, probabilities: list[float]) -> DataFrame:
    """One range per group, without bounds, that holds all its wanted ranks.

    ``_before`` values lie below a range, which holds ``_values`` different ones.
    """
    position = {n: F.lit(float(p)) * (F.col("_total") - 1) for n, p in enumerate(probabilities)}
    wants = [
        F.struct(
            F.lit(number).alias("p"), F.lit(edge).alias("edge"), rank(at).alias("rank"),
            (at - F.floor(at)).alias("share"),
        )
        for number, at in position.items()
        for edge, rank in (("low", F.floor), ("high", F.ceil))
    ]
    groups = counts.groupBy(*_GROUP).agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_values"))
    unbounded = F.lit(None).cast("double")
    return groups.select(
        *_GROUP, unbounded.alias("_low"), unbounded.alias("_high"), F.lit(0).cast("bigint").alias("_before"),
        "_values", F.array(*wants).alias("_wants"),
    )


def _inside(counts: DataFrame, ranges: DataFrame) -> DataFrame:
    """The counted values that lie in a range, with that range's columns."""
    of = ranges.withColumnsRenamed({"_k": "_rk", "_m": "_rm"})
    value = F.col("_v")
    return counts.join(
        of,
        F.col("_k").eqNullSafe(F.col("_rk")) & (F.col("_m") == F.col("_rm"))
        & (F.col("_low").isNull() | (value > F.col("_low")))
        & (F.col("_high").isNull() | (value <= F.col("_high"))),
    ).drop("_rk", "_rm")


def _narrowed(counts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every range cut by a sketch of its values into those of its parts that hold a wanted rank."""
    bounds = ranges.select(*_RANGE, "_high")
    steps = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    values = _inside(counts, bounds)
    cuts = values.groupBy(*_RANGE).agg(F.percentile_approx("_v", steps, F.lit(CUTS * 10)).alias("_cuts"))
    cut_ranges = ranges.join(
        cuts.withColumnsRenamed({"_k": "_ck", "_m": "_cm", "_low": "_cl"}),
        F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_m") == F.col("_cm")) & F.col("_low").eqNullSafe(F.col("_cl")),
    ).drop("_ck", "_cm", "_cl")
    part = F.size(F.filter("_cuts", lambda cut: cut < F.col("_v")))
    parts = (
        _inside(counts, cut_ranges.select(*_RANGE, "_high", "_cuts"))
        .select(*_RANGE, part.alias("_part"), "_n")
        .groupBy(*_RANGE, "_part").agg(F.sum("_n").alias("_weight"), F.count(F.lit(1)).alias("_values"))
    )
    # From here on there are at most CUTS rows per range.
    running = Window.partitionBy(*_RANGE).orderBy("_part")
    parts = parts.withColumn("_below", F.sum("_weight").over(running) - F.col("_weight"))
    parts = parts.withColumnsRenamed({"_k": "_pk", "_m": "_pm", "_low": "_pl"})
    of = cut_ranges.drop("_values").join(
        parts,
        F.col("_k").eqNullSafe(F.col("_pk")) & (F.col("_m") == F.col("_pm")) & F.col("_low").eqNullSafe(F.col("_pl")),
    )
    # Named before they are used: a name given in the same select would be taken within the lambda.
    of = of.withColumn("_start", F.col("_before") + F.col("_below"))
    of = of.withColumn("_end", F.col("_start") + F.col("_weight"))
    # A part ends at its own cut; the first and the last keep the range's bounds.
    low = F.when(F.col("_part") == 0, F.col("_low")).otherwise(F.get("_cuts", F.col("_part") - 1))
    high = F.when(F.col("_part") == F.size("_cuts"), F.col("_high")).otherwise(F.get("_cuts", F.col("_part")))
    held = F.filter("_wants", lambda w: (w["rank"] >= F.col("_start")) & (w["rank"] < F.col("_end")))
    return of.select(
        *_GROUP, low.alias("_low"), high.alias("_high"), F.col("_start").alias("_before"), "_values",
        held.alias("_wants"),
    ).where(F.size("_wants") > 0)


def wanted_ranges(counts: DataFrame, probabilities: list[float], sorted_values: int = SORTED_VALUES) -> DataFrame:
    """Ranges of at most ``sorted_values`` different values that hold the wanted ranks.

    A round looks at the ranges that are too large only. A group has at most two ranges per
    probability, so what is stored between rounds is small.
    """
    ranges = kept(_whole_groups(counts, probabilities), "quantile-ranges")
    too_large = F.col("_values") > sorted_values
    while not ranges.where(too_large).isEmpty():
        narrowed = _narrowed(counts, ranges.where(too_large))
        ranges = kept(ranges.where(~too_large).unionByName(narrowed), "quantile-ranges")
    return ranges


def exact_quantiles(
    df: DataFrame, key: str, columns: list[str], probabilities: list[float],
    sorted_values: int = SORTED_VALUES,
) -> DataFrame:
    """``key, <column>_p<percent>...``: linear interpolation between order statistics."""
    counts = kept(_value_counts(df, key, columns), "quantile-counts")
    ranges = wanted_ranges(counts, probabilities, sorted_values)
    within = Window.partitionBy(*_RANGE).orderBy("_v")
    upto = F.col("_before") + F.col("_upto")
    hits = (
        _inside(counts, ranges)
        .withColumn("_upto", F.sum("_n").over(within))
        .select(
            "_k", "_m", "_v",
            F.explode(
                F.filter(
                    "_wants", lambda e: (e["rank"] < upto) & (e["rank"] >= upto - F.col("_n"))
                )
            ).alias("_e"),
        )
    )

    def value(column: str, number: int, edge: str) -> Column:
        here = (F.col("_m") == column) & (F.col("_e.p") == number) & (F.col("_e.edge") == edge)
        return F.max(F.when(here, F.col("_v")))

    outputs = []
    for column in columns:
        for number, p in enumerate(probabilities):
            low, high = value(column, number, "low"), value(column, number, "high")
            share = F.max(
                F.when((F.col("_m") == column) & (F.col("_e.p") == number), F.col("_e.share"))
            )
            outputs.append((low + (high - low) * share).alias(f"{column}_p{round(p * 100):02d}"))
    return hits.groupBy(F.col("_k").alias(key)).agg(*outputs)
