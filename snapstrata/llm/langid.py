"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.llm.words import text_chunks

LONGEST = 3
#: N-grams in a profile. A document is compared by as many of its own at most.
PROFILE = 300
UNKNOWN = "und"
_BLANK = np.uint64(0x20)
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Whether each code point is a letter; made once in each Python worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str) -> np.ndarray:
    """All 1- to 3-grams of the lower-cased words, a blank on either side, packed in 63 bits."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    keep = _letter_table()[codes]
    if not keep.any():
        return np.zeros(0, np.uint64)
    codes = np.where(keep, codes, 0x20).astype(np.uint64)
    codes = np.concatenate(([_BLANK], codes, [_BLANK]))
    blank = codes == _BLANK
    once = np.ones(len(codes), bool)
    once[1:] = ~(blank[1:] & blank[:-1])
    codes, blank = codes[once], blank[once]
    one = codes[~blank]
    two = (codes[:-1] << np.uint64(21)) | codes[1:]
    three = (two[:-1] << np.uint64(21)) | codes[2:]
    return np.concatenate((one, two, three[~blank[1:-1]]))


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The ``most`` keys with the highest counts, smaller keys first among equals."""
    if len(keys) > most:
        edge = np.partition(counts, len(counts) - most)[len(counts) - most]
        keys, counts = keys[counts >= edge], counts[counts >= edge]
    return keys[np.lexsort((keys, -counts))][:most]


def _texts(column: pa.Array):
    for _, data, offsets in text_chunks(column):
        raw = data.tobytes()
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            yield raw[a:b].decode("utf-8", "replace")


def _count(batches):
    """N-gram counts of each language in the partition."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        pending: dict[str, list[np.ndarray]] = {}
        size = 0
        for k, text in enumerate(_texts(batch.column("text"))):
            found = grams(text)
            pending.setdefault(langs[k], []).append(found)
            size += len(found)
            if size > 1 << 21 or k + 1 == len(langs):
                for lang, parts in pending.items():
                    own = held.setdefault(lang, [])
                    own.append(np.unique(np.concatenate(parts), return_counts=True))
                    if len(own) > 8:
                        held[lang] = [merged(own)]
                pending, size = {}, 0
    for lang, parts in held.items():
        keys, counts = merged(parts)
        for i in range(0, len(keys), 10000):
            part = keys[i : i + 10000].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(counts[i : i + 10000])],
                ["lang", "gram", "n"],
            )


def language_profiles(docs: DataFrame, train: Column | None = None) -> dict[str, np.ndarray]:
    """For each language its ``PROFILE`` most frequent n-grams, from all rows with a language.

    Counts are summed in the tasks, then by n-gram. The driver receives
    ``PROFILE`` rows for each language, nothing that grows with the texts.
    """
    chosen = docs.where(F.col("lang").isNotNull() & (F.lit(True) if train is None else train))
    counts = (
        chosen.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    rows = top.select("lang", "gram", "rank").toArrow().to_pydict()
    profiles: dict[str, list] = {}
    for lang, gram, rank in sorted(zip(rows["lang"], rows["gram"], rows["rank"], strict=True)):
        profiles.setdefault(lang, []).append((rank, gram))
    return {lang: np.array([g for _, g in sorted(v)], np.int64).view(np.uint64) for lang, v in profiles.items()}


def classify(text: str, langs: list[str], keys: np.ndarray, places: np.ndarray) -> tuple[str, float]:
    """The language with the least out-of-place distance, and how clearly it leads.

    ``keys`` are all n-grams of the profiles, sorted, ``places`` their ranks in each
    language, ``PROFILE`` where they are missing. The score is the share of the
    largest possible distance that the document does not have.
    """
    found = grams(text)
    if not len(found) or not langs:
        return UNKNOWN, 0.0
    own = ranked(*np.unique(found, return_counts=True))
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    known = keys[at] == own
    rank = np.arange(len(own))
    apart = np.where(known[:, None], np.abs(places[at] - rank[:, None]), PROFILE)
    distance = np.minimum(apart, PROFILE).sum(0)
    best = int(np.argmin(distance))
    return langs[best], float(1 - distance[best] / (PROFILE * len(own)))


def with_language(docs: DataFrame, profiles: dict[str, np.ndarray], keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score`` for each whole ``text``.

    ``und`` and 0 stand for null texts, texts without a letter, and for all texts
    when there is no profile. Languages at the same distance go by name.
    """
    langs = sorted(profiles)
    keys = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.zeros(0, np.uint64)
    places = np.full((len(keys), len(langs)), PROFILE, np.int64)
    for i, lang in enumerate(langs):
        places[np.searchsorted(keys, profiles[lang]), i] = np.arange(len(profiles[lang]))
    shared = docs.sparkSession.sparkContext.broadcast((langs, keys, places))
    given = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches):
        langs, keys, places = shared.value
        for batch in batches:
            found = [classify(t, langs, keys, places) for t in _texts(batch.column("__text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                [*keep, "lang_pred", "score"],
            )

    fields = ", ".join(f"`{c}` {dict(given.dtypes)[c]}" for c in keep)
    return given.mapInArrow(run, f"{fields}, lang_pred string, score double")
