"""Benchmark decontamination by spaced-seed hashing and substitution-tolerant overlaps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import stored
from snapstrata.llm.words import ALPHANUMERIC, hash_words, mix, text_chunks
from snapstrata.session import scratch_dir
from snapstrata.sources.folders import remove

#: Fixed masks: a seed hashes the words under 1 and ignores those under 0. Every overlap
#: that counts has a place where one of them meets equal words only: overlaps shrink to
#: 13 words with 2 unequal, 15 with 3, 20 with 4, 25 with 5 or 30 with 6, and the tests
#: go through all placements in these.
MASKS = ("1111111", "11101111", "111110011", "11010010111", "1100100010111", "1110101001001")
LONGEST = max(map(len, MASKS))
#: The same for items of 10 to 12 words, of which two may be unequal, and of 5 to 9 with one.
MIDDLE_MASKS = ("111111", "1110111", "11011011", "111000111", "1101001011")
MIDDLE_ITEM = 10
SHORT_MASKS = ("1111", "10111", "11011", "11101")
#: An overlap counts from so many equal words, or from most words of a shorter item.
LEAST_WORDS = 13
#: What an unequal word costs against an equal one: at most one word in five may differ.
MISMATCH = 4
#: Items shorter than this must be the whole document.
SHORT_ITEM = 5
#: Bits of the filter that every task receives; its size does not depend on the data.
FILTER_BITS = 22


def words_needed(n: int) -> int:
    """Equal words that an overlap with an item of ``n`` words needs: four fifths, or ``LEAST_WORDS``."""
    return min(LEAST_WORDS, -(-4 * n // 5))


def item_masks(n: int) -> tuple[str, ...]:
    """The masks that seed an item of ``n`` words."""
    if n >= LONGEST:
        return MASKS
    if n >= MIDDLE_ITEM:
        return MIDDLE_MASKS
    return SHORT_MASKS if n >= SHORT_ITEM else ("1" * n,) if n else ()


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words under the mask at every place where it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, int(mask, 2) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out *= np.uint64(0xD1342543DE82EF95)
            out += words[i : i + n]
    return mix(out)


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << FILTER_BITS) - 1)
    return (hashes & low).astype(np.int64), (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _item_seeds(batches):
    """Words of each item, and its seeds: those of the masks for its number of words."""
    for batch in batches:
        words, seeds = [], []
        for _, data, offsets in text_chunks(batch.column("text")):
            hashes, rows = hash_words(data, offsets, ALPHANUMERIC, lower=True)
            for k in range(len(offsets) - 1):
                own = hashes[rows[k] : rows[k + 1]]
                words.append(own.view(np.int64).tolist())
                seeds.append([
                    {"seed": int(h), "at": i}
                    for m in item_masks(len(own)) for i, h in enumerate(seed_hashes(own, m).view(np.int64))
                ])
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(words, pa.list_(pa.int64())),
             pa.array(seeds, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))],
            ["item_id", "item_words", "seeds"],
        )


def contaminated(docs: DataFrame, benchmark: DataFrame, hits_path: str | None = None) -> DataFrame:
    """Overlaps ``(doc_id, item_id, first_word, n_words, n_equal, item_words)``.

    One row per document and item whose words (letters and digits, ASCII case
    ignored) overlap: a run aligned word by word with at least ``LEAST_WORDS`` equal
    words, or four fifths of the item where that is less, in which at most one word in
    five differs; the run with the most equal words is reported, the earliest among
    equals. Items under
    ``SHORT_ITEM`` words must equal the whole document; items without words match
    nothing. Null texts count as empty; repeated documents give one row each;
    repeated items one row per id.

    Documents are read once. A bit filter of fixed size over the benchmark's seeds
    keeps almost all places from leaving the tasks; what passes is joined with the
    seeds by hash, whatever the size of the benchmark. The words of documents that hold
    a seed are stored, in ``hits_path`` if it is given, and read when the result is.
    """
    items = stored(
        benchmark.select("item_id", "text").dropDuplicates().mapInArrow(
            _item_seeds,
            "item_id long, item_words array<bigint>, seeds array<struct<seed:bigint,at:int>>",
        ),
        "leak-items",
    )
    seeds = items.select("item_id", F.size("item_words").alias("n"), F.explode("seeds").alias("s")).select(
        "item_id", F.col("s.seed").alias("seed"), F.col("s.at").alias("at"), "n"
    )
    bits = np.zeros(1 << FILTER_BITS, bool)
    low = F.col("seed").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    high = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    set_bits = seeds.select(F.explode(F.array(low.cast("int"), high.cast("int"))).alias("bit")).distinct().toArrow()
    bits[set_bits.column("bit").to_numpy()] = True
    kinds = seeds.select(F.least("n", F.lit(LONGEST)).alias("n")).distinct().collect()
    masks = sorted({m for r in kinds for m in item_masks(r["n"])} | set(MASKS))
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def find(batches):
        bits = shared.value
        for batch in batches:
            ids, words, hits = [], [], []
            for first, data, offsets in text_chunks(batch.column("text")):
                hashes, rows = hash_words(data, offsets, ALPHANUMERIC, lower=True)
                places, found = [], []
                for m in masks:
                    h = seed_hashes(hashes, m)
                    a, b = _probes(h)
                    at = np.flatnonzero(bits[a] & bits[b])
                    doc = np.searchsorted(rows, at, "right") - 1
                    fits = at + len(m) <= rows[doc + 1]
                    places.append(at[fits])
                    found.append(h[at[fits]])
                place, seed = np.concatenate(places), np.concatenate(found).view(np.int64)
                doc = np.searchsorted(rows, place, "right") - 1
                for k in np.unique(doc).tolist():
                    mine = doc == k
                    ids.append(batch.column("doc_id")[first + k].as_py())
                    words.append(hashes[rows[k] : rows[k + 1]].view(np.int64))
                    hits.append([
                        {"seed": s, "at": p - int(rows[k])}
                        for s, p in zip(seed[mine].tolist(), place[mine].tolist(), strict=True)
                    ])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words, pa.list_(pa.int64())),
                 pa.array(hits, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))],
                ["doc_id", "words", "hits"],
            )

    given = docs.select("doc_id", "text")
    hit_docs = given.mapInArrow(
        find, "doc_id long, words array<bigint>, hits array<struct<seed:bigint,at:int>>"
    )
    # Equal texts under one id are one document here.
    hit_docs = hit_docs.withColumn("doc_key", F.xxhash64("doc_id", "words"))
    hit_docs = stored(hit_docs, "leak-hits", hits_path)
    hits = hit_docs.select("doc_key", F.explode("hits").alias("h")).select(
        "doc_key", F.col("h.seed").alias("seed"), F.col("h.at").alias("doc_at")
    )
    offsets = hits.join(seeds, "seed").select(
        "doc_key", "item_id", (F.col("doc_at") - F.col("at")).alias("shift")
    ).distinct()
    texts = hit_docs.select("doc_key", "doc_id", "words").dropDuplicates(["doc_key"])
    lengths = items.select("item_id", "item_words")
    candidates = (
        offsets.join(texts, "doc_key").join(lengths, "item_id")
        .select(
            "doc_key", "doc_id", "item_id", "shift", "item_words", F.size("words").alias("doc_words"),
            F.slice(
                "words", F.greatest(F.col("shift"), F.lit(0)) + 1,
                F.greatest(F.size("item_words") + F.least(F.col("shift"), F.lit(0)), F.lit(0)),
            ).alias("near"),
        )
    )
    checked = candidates.mapInArrow(
        _overlaps, "doc_key long, doc_id long, item_id long, first_word int, n_words int, n_equal int, item_words int"
    )
    best = checked.groupBy("doc_key", "doc_id", "item_id").agg(
        F.max(F.struct("n_equal", (-F.col("first_word")).alias("at"), "n_words", "item_words")).alias("b")
    )
    return best.select(
        "doc_id", "item_id", (-F.col("b.at")).alias("first_word"), F.col("b.n_words").alias("n_words"),
        F.col("b.n_equal").alias("n_equal"), F.col("b.item_words").alias("item_words"),
    )


def best_run(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, length and equal words of the run with the most equal words, the earliest among equals.

    Of all runs with at least ``MISMATCH`` equal words for each unequal one; unequal words
    at its ends do not count to it.
    """
    total = np.concatenate(([0], np.cumsum(np.where(equal, 1, -MISMATCH))))
    # For each end the earliest start whose total is no higher: no other run to that end has more equal words.
    starts = np.searchsorted(-np.minimum.accumulate(total), -total)
    count = np.concatenate(([0], np.cumsum(equal)))
    end = int(np.argmax(count - count[starts]))
    inside = starts[end] + np.flatnonzero(equal[starts[end] : end])
    return (int(inside[0]), int(inside[-1] - inside[0]) + 1, len(inside)) if len(inside) else (0, 0, 0)


def _overlaps(batches):
    for batch in batches:
        rows = []
        get = {c: batch.column(c) for c in batch.schema.names}
        for k in range(batch.num_rows):
            shift = get["shift"][k].as_py()
            item, near = np.array(get["item_words"][k].values), np.array(get["near"][k].values)
            skip = max(0, -shift)
            n = min(len(item) - skip, len(near))
            equal = item[skip : skip + n] == near[:n]
            start, size, same = best_run(equal)
            need = words_needed(len(item))
            if len(item) < SHORT_ITEM:
                need = len(item) if get["doc_words"][k].as_py() == len(item) else len(item) + 1
            if same >= need:
                ids = [get[c][k].as_py() for c in ("doc_key", "doc_id", "item_id")]
                rows.append([*ids, max(0, shift) + start, size, same, len(item)])
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.int64()] * 3 + [pa.int32()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["doc_key", "doc_id", "item_id", "first_word", "n_words", "n_equal", "item_words"],
        )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item; rows without an id stay."""
    hits_path = scratch_dir(docs.sparkSession, "leak-hits")
    leaked = stored(contaminated(docs, benchmark, hits_path).select("doc_id").distinct(), "leaks")
    # Only the ids are read from here on.
    remove(docs.sparkSession, hits_path)
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)
