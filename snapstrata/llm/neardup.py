"""Near-duplicates by Order MinHash, verified by a banded alignment of word shingles."""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import stored
from snapstrata.llm.components import connected_components
from snapstrata.llm.words import ALPHANUMERIC, BLANK_SEPARATED, hash_words, mix, shingles, text_chunks
from snapstrata.session import scratch_dir
from snapstrata.sources.folders import remove

SHINGLE = 5
SIMILARITY = 0.8
#: Sketches of a text, and minimum shingles that each keeps in text order. A pair with m
#: of u shingles aligned shares one with probability 1 - (1 - C(m, 5) / C(u, 5))^32: over
#: 0.99999 at similarity 0.8 where u is over ``SHORT``, and less below.
SKETCHES = 32
MINIMA = 5
#: Texts of so many shingles have sketches of fewer minima. A pair with u up to ``SHORT``
#: shares one with probability 1 - (1 - C(m, 3) / C(u, 3))^24, over 0.99999 as well: least
#: where 4 of 5 are aligned. Texts of 3 shingles and fewer reach 0.8 as copies only.
SHORT = 35
SHORT_SKETCHES = 24
SHORT_MINIMA = 3
#: Sketches whose groups are looked at first.
FIRST_SKETCHES = 4
#: Leaders of a group in the first full turn, on average, and how many times as many
#: members have led after each further turn.
LEADERS = 2
GROWTH = 16
SEED = 11
#: Longs of a text's parity bits.
PARITY_LONGS = 24

_rng = np.random.Generator(np.random.PCG64(SEED))
_FACTORS = _rng.integers(1 << 40, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)


def order_minhash(keys: np.ndarray, sketches: int = SKETCHES, minima: int = MINIMA) -> np.ndarray:
    """``sketches`` hashes, each over the ``minima`` smallest labelled shingles in text order."""
    n = min(minima, len(keys))
    block = max(1, (1 << 20) // max(1, len(keys)))
    out = np.empty(sketches, np.uint64)
    for i in range(0, sketches, block):
        ranks = keys[None, :] * _FACTORS[i : min(i + block, sketches), None]
        ranks += _SHIFTS[i : min(i + block, sketches), None]
        ranks ^= ranks >> np.uint64(29)
        least = np.argpartition(ranks, n - 1, axis=1)[:, :n] if n < len(keys) else np.tile(
            np.arange(n), (len(ranks), 1)
        )
        least.sort(axis=1)
        sketch = np.arange(i, i + len(ranks), dtype=np.uint64) + np.uint64(minima * SKETCHES)
        for j in range(n):
            sketch = sketch * np.uint64(0x9FB21C651E98DF25) + keys[least[:, j]]
        out[i : i + block] = mix(sketch)
    return out


def text_sketches(keys: np.ndarray) -> np.ndarray:
    """The sketches that a text shares with those it may be similar to.

    Shingles of both of a similar pair are at least ``SIMILARITY`` of the union, so
    texts of up to that share of ``SHORT`` have no partner beyond it.
    """
    kinds = []
    if len(keys) <= SHORT:
        kinds.append(order_minhash(keys, SHORT_SKETCHES, SHORT_MINIMA))
    if len(keys) > SIMILARITY * SHORT:
        kinds.append(order_minhash(keys))
    return np.concatenate(kinds)


def parity_bits(keys: np.ndarray) -> np.ndarray:
    """One bit for each of ``64 * PARITY_LONGS`` hash values: whether an odd number of shingles has it.

    A shingle that only one of two texts holds turns one bit, so the bits that differ
    are never more than the shingles that differ.
    """
    spots = mix(keys * np.uint64(0xA0761D6478BD642F)) % np.uint64(64 * PARITY_LONGS)
    odd = np.bincount(spots.astype(np.int64), minlength=64 * PARITY_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def may_reach(x: str, y: str, threshold: float) -> Column:
    """Whether texts of ``size`` shingles and parity ``bits`` can be as similar as ``threshold``; never false if they are."""
    both = F.col(f"{x}size") + F.col(f"{y}size")
    differing = sum(
        (F.bit_count(F.col(f"{x}bits")[i].bitwiseXOR(F.col(f"{y}bits")[i])) for i in range(PARITY_LONGS)), F.lit(0)
    )
    return (
        (F.least(f"{x}size", f"{y}size") >= both * F.lit(threshold / (1 + threshold)) - 1e-6)
        & (differing <= both * F.lit((1 - threshold) / (1 + threshold)) + 1e-6)
    )


@lru_cache(4096)
def _labelled(words: bytes) -> np.ndarray:
    """Shingles of a stored word sequence; a leader's are asked for again and again."""
    return shingles(np.frombuffer(words, "<u4").astype(np.uint64), SHINGLE)


def aligned_similarity(x: np.ndarray, y: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Similarity of two texts by the labelled shingles that an alignment keeps in order.

    With m aligned of the shingles of both it is m / (x + y - m). Only cells in
    a band around the diagonal are aligned: a cell off it by more cannot be part of
    an alignment that reaches ``threshold``. Labels make shingles unique, so the
    longest alignment is the longest rising run of places.
    """
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    least = threshold / (1 + threshold) * (len(x) + len(y))
    if min(len(x), len(y)) < least - 1e-9:
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    inside = (i - j <= len(x) - least + 1e-9) & (j - i <= len(y) - least + 1e-9)
    i, j = i[inside], j[inside]
    if len(i) < least - 1e-9:
        return 0.0
    j = j[np.argsort(i)]
    if np.all(j[1:] > j[:-1]):
        m = len(j)
    else:
        ends: list[int] = []
        for v in j.tolist():
            at = bisect_left(ends, v)
            if at == len(ends):
                ends.append(v)
            else:
                ends[at] = v
        m = len(ends)
    return m / (len(x) + len(y) - m)


def _profile(batches):
    for batch in batches:
        prints, sketches, words, sizes, bits = [], [], [], [], []
        for _, data, offsets in text_chunks(batch.column("text")):
            hashes, rows = hash_words(data, offsets, ALPHANUMERIC, lower=True)
            plain, plain_rows = hash_words(data, offsets, BLANK_SEPARATED, lower=False)
            for k in range(len(offsets) - 1):
                own = hashes[rows[k] : rows[k + 1]]
                if not len(own):
                    # Without letters or digits the blank-separated pieces stand for the words.
                    own = plain[plain_rows[k] : plain_rows[k + 1]]
                # The shingles are those of the stored words, so that the bits bound what the alignment finds.
                short = own >> np.uint64(32)
                keys = shingles(short, SHINGLE)
                place = np.arange(1, len(own) + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                whole = mix(own + place)
                prints.append(
                    np.array([whole.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(whole.copy())), len(own)], "<u8").tobytes()
                )
                sketches.append(text_sketches(keys).view(np.int64) if len(keys) else np.zeros(0, np.int64))
                words.append(short.astype("<u4").tobytes())
                sizes.append(len(keys))
                bits.append(parity_bits(keys))
        ends = np.cumsum([0] + [len(s) for s in sketches])
        flat = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints, pa.binary()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(words, pa.binary()),
             pa.array(sizes, pa.int64()), pa.array([b.tolist() for b in bits], pa.list_(pa.int64()))],
            ["doc_id", "print", "sketches", "words", "size", "bits"],
        )


def _verified(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: the classes, in ``of_a`` and ``of_b``, of pairs whose similarity reaches the threshold."""

    def run(batches):
        for batch in batches:
            good = [
                aligned_similarity(_labelled(x), _labelled(y), threshold) >= threshold - 1e-9
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            ]
            ends = pa.RecordBatch.from_arrays([batch.column("of_a"), batch.column("of_b")], ["a", "b"])
            yield ends.filter(pa.array(good, pa.bool_()))

    left = words.select(F.col("rep").alias("a"), F.col("words").alias("x"))
    right = words.select(F.col("rep").alias("b"), F.col("words").alias("y"))
    # Pairs meet the text of their second end first: that end is hardly ever shared by many pairs.
    both = pairs.join(right, "b").join(left, "a").select("of_a", "of_b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``(doc_id, class_id, copy_of)``, one row per row of ``docs``.

    Words are runs of letters and digits, ASCII case ignored. Texts with the same
    words are copies and are represented by the smallest id, ``copy_of``; only
    representatives are sketched against each other. Texts that share a sketch are
    candidates: in each sketch's group a few leaders, chosen by hash, are aligned with
    the members, and while a group spans several classes, further leaders with members
    of other classes, more of them each turn, until every member has led. So each
    candidate pair is either aligned or in one class already: copies and near copies
    cost about one alignment a text, and no link between candidates is lost. Pairs
    that their sizes or parity bits prove too different are not aligned: the bits that
    differ never outnumber the shingles that differ, so this dismisses no link.
    ``class_id`` is the smallest id of the connected texts.

    Null and empty texts are copies of each other. Ids are expected to be unique up
    to repeated rows; texts that share an id share its class. Rows without an id have
    a null class unless they copy a text that has one. An empty table gives no rows.
    """
    spark = docs.sparkSession
    profile_path = scratch_dir(spark, "near-profile")
    profile = stored(
        docs.select("doc_id", "text").mapInArrow(
            _profile,
            "doc_id long, print binary, sketches array<bigint>, words binary, size bigint, bits array<bigint>",
        ),
        "near-profile", profile_path,
    )
    rows = stored(profile.select("doc_id", "print"), "near-rows")
    prints = profile.groupBy("print").agg(F.min("doc_id").alias("rep"))
    prints = stored(prints, "near-prints")
    reps = prints.where(F.col("rep").isNotNull())
    chosen = profile.join(reps.withColumnRenamed("rep", "doc_id"), ["print", "doc_id"], "left_semi")
    sketched = chosen.select(F.col("doc_id").alias("rep"), F.posexplode("sketches").alias("band", "sketch"))
    shared = sketched.groupBy("sketch").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    groups = stored(sketched.join(shared, "sketch"), "near-groups")
    # A text's place lies evenly between 0 and the size of its largest group. It leads in all
    # its groups in the turn in which the bound passes its place, so no pair is aligned in two turns.
    share = F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(1 << 32)) / F.lit(float(1 << 32))
    largest = stored(groups.groupBy("rep").agg(F.max("n").alias("n")), "near-largest")
    words = stored(
        chosen.select(F.col("doc_id").alias("rep"), "words", "size", "bits").join(largest, "rep", "left_semi")
        .dropDuplicates(["rep"]),
        "near-words",
    )
    # What is read from here on are the rows' prints and the groups and words of candidates.
    remove(spark, profile_path)
    classes = stored(
        largest.join(words, "rep")
        .select("rep", F.col("rep").alias("component"), (share * F.col("n")).alias("place"), "size", "bits"),
        "near-classes",
    )
    last = classes.agg(F.max("place")).first()[0]
    # The first turn takes a few sketches and a member each; most groups are in one class after it.
    asked, led, bound = groups.where(F.col("band") < FIRST_SKETCHES), None, 0
    while last is not None and (led is None or led <= last):
        placed = asked.select("sketch", "rep").join(classes, "rep")
        if led is None:
            leaders = placed.groupBy("sketch").agg(F.min(F.struct("place", "rep", "component", "size", "bits")).alias("l"))
            leaders = leaders.select("sketch", "l.*")
        else:
            open_groups = placed.groupBy("sketch").agg(
                F.min("component").alias("low"), F.max("component").alias("high")
            ).where(F.col("low") != F.col("high")).select("sketch")
            leaders = placed.where((F.col("place") >= led) & (F.col("place") < bound)).join(open_groups, "sketch")
        leaders = leaders.select(
            "sketch", F.col("rep").alias("a"), F.col("place").alias("from"), F.col("component").alias("of_a"),
            F.col("size").alias("a_size"), F.col("bits").alias("a_bits"),
        )
        # Of two members the one with the lower place leads.
        later = (F.col("place") > F.col("from")) | ((F.col("place") == F.col("from")) & (F.col("rep") > F.col("a")))
        pairs = (
            placed.join(leaders, "sketch")
            .where((F.col("component") != F.col("of_a")) & later & may_reach("", "a_", threshold))
            .select("a", F.col("rep").alias("b"), "of_a", F.col("component").alias("of_b")).distinct()
        )
        links = stored(_verified(stored(pairs, "near-pairs"), words, threshold), "near-links")
        if not links.isEmpty():
            joined = connected_components(links, "joined")
            classes = stored(
                classes.join(joined.withColumnRenamed("id", "component"), "component", "left")
                .select("rep", F.coalesce("joined", "component").alias("component"), "place", "size", "bits"),
                "near-classes",
            )
        asked, led = groups, bound
        bound = LEADERS if bound == 0 else bound * GROWTH
    whole = prints.join(classes, "rep", "left").select("print", "rep", F.coalesce("component", "rep").alias("class_id"))
    return rows.join(whole, "print").select(
        "doc_id", "class_id", F.col("rep").alias("copy_of")
    )


def one_of_each(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id names its class; repeated rows of an id stay once.

    Rows without an id stay when no text with an id is their copy or, among
    themselves, all of them.
    """
    found = near_duplicates(docs, threshold)
    kept = found.where(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    with_id = docs.join(kept, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return with_id.unionByName(docs.where(F.col("doc_id").isNull()))
