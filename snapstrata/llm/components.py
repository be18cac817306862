"""Connected components of a table of links, without any of it on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import stored


def connected_components(links: DataFrame, label: str = "component") -> DataFrame:
    """``(id, component)`` for every id in ``links(a, b)``; the component is its smallest id.

    Each round, a node takes the smallest label among its own, its neighbours' and
    that of the node its label names. Minima are taken in the map tasks first, so a
    node with very many links is no hot group. Rounds end when no label changes.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    both = stored(both.where(F.col("a") != F.col("b")).distinct(), "component-links")
    current = stored(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
        .select("id", F.least("id", "m").alias(label)),
        "component-labels",
    )
    while True:
        of = current.select(F.col("id").alias("a"), F.col(label).alias("l"))
        near = both.join(of, "a").groupBy(F.col("b").alias("id")).agg(F.min("l").alias("near"))
        jump = current.select(F.col("id").alias(label), F.col(label).alias("far"))
        moved = (
            current.join(near, "id").join(jump, label, "left")
            .select("id", F.least(label, "near", "far").alias(label), F.col(label).alias("old"))
        )
        moved = stored(moved, "component-labels")
        current = moved.select("id", label)
        if moved.where(F.col(label) != F.col("old")).isEmpty():
            return current
