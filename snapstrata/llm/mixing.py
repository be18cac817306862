"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 1024
#: Hash ranges per source and pass, by leading hexadecimal digits, and slots per range: they
#: keep running sums free of hot groups.
RANGE_DIGITS = 3
RANGES = 16**RANGE_DIGITS
SLOT_RANGE = 1 << 12
#: Equal bins of the unit interval in which schedule points meet the sources' intervals.
BINS = 4096
#: Fractional part of the golden ratio, and of 2^20 times it.
GOLDEN = (5**0.5 - 1) / 2
GOLDEN_HIGH = (GOLDEN * (1 << 20)) % 1.0


def with_sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: words of each whole text, 0 for a null or empty one."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("doc_id", "source", size.alias("size"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """``(source, source_size, target, goal)``; ``goal`` is the target in whole words.

    Sources by code point, null last, carry the weights in turn. A target stops at
    ``repeats`` times its source's size and what is over goes to the others by
    weight: that is ``least(cap, level * weight)`` for the level at which the
    targets add up. The level follows from running sums over the sources in the
    order of cap by weight. One row per source; only these rows meet in one task.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    capped = by_source.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size").cast("double") * repeats
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = capped.select(
        "*",
        (
            (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("candidate"),
    )
    fits = F.when(F.col("candidate") * F.col("weight") <= F.col("cap"), F.col("candidate"))
    level = F.max(fits).over(whole)
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return levels.select(
        "source", "source_size", target.alias("target"), F.floor(target + 1e-6).cast("bigint").alias("goal")
    )


def _running(df: DataFrame, keys: list[str], part: str, order: list[Column], amount: str) -> DataFrame:
    """Adds ``begin``: the sum of ``amount`` over a key's rows before this one.

    Rows are ordered by ``part``, then ``order``. Sums within a part and sums of
    whole parts are taken apart, so a hot key is spread over its parts.
    """
    totals = df.groupBy(*keys, part).agg(F.sum(amount).alias("__n"))
    over = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, part, F.coalesce(F.sum("__n").over(over), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("__inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return summed.join(offsets, [*keys, part]).withColumn(
        "begin", F.col("__before") + F.col("__inside")
    ).drop("__before", "__inside")


def shuffled_blocks(sizes: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """``(sid, block, row, doc_id, first, last)``: the pieces of documents in each block.

    A source's documents stand in hash order, once for each pass that its target
    needs, the order of a pass differing from the last; the stream is cut every
    ``BLOCK_WORDS`` words and ends at the target. ``first`` and ``last`` are word
    positions in the document, the end exclusive.
    """
    passes = F.sequence(F.lit(0), F.when(F.col("goal") > F.col("source_size"), 1).otherwise(0))
    dealt = (
        sizes.where(F.col("size") > 0)
        .join(targets.select("source", "sid", "goal", "source_size"), F.equal_null(sizes["source"], targets["source"]))
        .select(targets["sid"], "row", "doc_id", "size", "goal", F.explode(passes).alias("pass"))
    )
    hashed = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("pass").cast("string"), F.lit(str(seed))))
    ranged = dealt.withColumn("hash", hashed).withColumn(
        "part", F.col("pass") * RANGES + F.conv(F.substring("hash", 1, RANGE_DIGITS), 16, 10).cast("int")
    )
    placed = _running(ranged, ["sid"], "part", [F.col("hash"), F.col("row")], "size")
    end = F.least(F.col("begin") + F.col("size"), F.col("goal"))
    blocks = F.sequence(
        (F.col("begin") / BLOCK_WORDS).cast("bigint"), ((F.col("end") - 1) / BLOCK_WORDS).cast("bigint")
    )
    return (
        placed.where(F.col("begin") < F.col("goal")).withColumn("end", end)
        .select("*", F.explode(blocks).alias("block"))
        .select(
            "sid", "block", "row", "doc_id",
            (F.greatest(F.col("begin"), F.col("block") * BLOCK_WORDS) - F.col("begin")).alias("first"),
            (F.least(F.col("end"), (F.col("block") + 1) * BLOCK_WORDS) - F.col("begin")).alias("last"),
        )
    )


def schedule(targets: DataFrame) -> DataFrame:
    """``(slot, sid, block)``: which source gives its next block at each slot.

    Slot i stands at the fractional part of i times the golden ratio and falls in
    one source's interval of the cumulative targets. Slots are ranked per source,
    and the rank is the block. Ranks beyond a source's last block are left out, and
    blocks whose rank the points did not reach follow at the end.
    """
    spark = targets.sparkSession
    over = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = F.ceil(F.col("goal") / BLOCK_WORDS)
    shares = targets.where(F.col("goal") > 0).select(
        "sid", blocks.alias("blocks"),
        F.coalesce(F.sum(blocks).over(over), F.lit(0)).alias("low_n"),
        F.sum(blocks).over(whole).alias("all_n"),
    ).withColumn("low", F.col("low_n") / F.col("all_n")).withColumn(
        "high", (F.col("low_n") + F.col("blocks")) / F.col("all_n")
    )
    total = targets.agg(F.coalesce(F.sum(blocks), F.lit(0)).alias("n")).first()["n"]
    slot = F.col("slot")
    point = (
        F.floor(slot / (1 << 20)) * GOLDEN_HIGH + (slot % (1 << 20)) * GOLDEN
    ) % 1.0
    points = (
        spark.range(total).withColumnRenamed("id", "slot")
        .withColumn("point", point)
        .withColumn("bin", F.floor(F.col("point") * BINS).cast("int"))
    )
    bins = F.sequence(
        F.floor(F.col("low") * BINS).cast("int"), F.least(F.floor(F.col("high") * BINS), F.lit(BINS - 1)).cast("int")
    )
    intervals = shares.select("sid", "blocks", "low", "high", F.explode(bins).alias("bin"))
    drawn = (
        points.join(intervals, "bin")
        .where((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
        .select("sid", "slot", "blocks", F.lit(1).alias("one"),
                F.floor(slot / SLOT_RANGE).alias("part"))
    )
    ranked = _running(drawn, ["sid"], "part", [slot], "one")
    kept = ranked.where(F.col("begin") < F.col("blocks")).select("slot", "sid", F.col("begin").alias("block"))
    reached = drawn.groupBy("sid").agg(F.count(F.lit(1)).alias("reached"))
    missing = (
        shares.join(reached, "sid", "left")
        .withColumn("reached", F.coalesce("reached", F.lit(0)))
        .where(F.col("reached") < F.col("blocks"))
        .select(
            F.lit(total).cast("bigint").alias("slot"), "sid",
            F.explode(F.sequence(F.col("reached").cast("bigint"), F.col("blocks").cast("bigint") - 1)).alias("block"),
        )
    )
    return kept.unionByName(missing)


def mix_sources(docs: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes, targets and the mixture ``(slot, sid, block, row, doc_id, first, last)``.

    The mixture lists, slot by slot, the word ranges of documents that the mix
    takes. A document gives no word more than ``MOST_REPEATS`` times, each source
    gives its target in whole words, and the result depends on the rows only, not
    on their partitions. ``row`` numbers the rows by id, source and size, so repeated
    rows are rows of their own; documents without words are never taken; null
    sources are one source, sorted last; an empty table gives an empty mixture.
    """
    counted = with_sizes(docs)
    again = Window.partitionBy("doc_id", "source", "size").orderBy(F.lit(1))
    numbered = counted.withColumn("row", F.xxhash64("doc_id", "source", "size", F.row_number().over(again)))
    sizes = stored(numbered, "mix-sizes")
    targets = source_targets(sizes).withColumn("sid", F.xxhash64(F.col("source").isNull(), "source"))
    targets = stored(targets, "mix-targets")
    blocks = shuffled_blocks(sizes, targets, seed)
    return sizes, targets, schedule(targets).join(blocks, ["sid", "block"])


def taken_words(sizes: DataFrame, targets: DataFrame, mixture: DataFrame) -> DataFrame:
    """``(row, doc_id, size, source_size, target, taken)``, one row per document."""
    taken = mixture.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    of_source = targets.select(F.col("source").alias("__source"), "source_size", "target")
    return (
        sizes.join(of_source, F.equal_null("source", "__source"))
        .join(taken, "row", "left")
        .select("row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"))
    )


def whole_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``docs`` as the mix takes them: a document stands as often as its words were taken.

    The count is the words taken divided by the size, rounded half up, so a document
    that gave less than half of its words is left out. Documents without words
    stay. Columns are those of ``docs``.
    """
    sizes, targets, mixture = mix_sources(docs, seed)
    times = F.when(F.col("size") == 0, 1).otherwise(
        F.floor(F.col("taken") / F.col("size") + 0.5)
    ).cast("int")
    counts = taken_words(sizes, targets, mixture).withColumn("times", times)
    per_id = counts.groupBy("doc_id").agg(F.max("times").alias("__times")).where(F.col("__times") > 0)
    per_id = per_id.withColumnRenamed("doc_id", "__id")
    joined = docs.join(per_id, F.equal_null("doc_id", "__id"))
    repeats = F.explode(F.sequence(F.lit(1), F.col("__times")))
    return joined.select(*docs.columns, repeats.alias("__copy")).drop("__copy")
