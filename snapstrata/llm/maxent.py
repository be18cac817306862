"""Language-model scores from a hashed maximum-entropy model with class-factored softmax."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import stored
from snapstrata.llm.words import BLANK_SEPARATED, hash_words, mix, text_chunks

#: The most frequent words, which tasks hold with their counts. All others are looked
#: up by a join, so the bound is one of memory and not of what is counted.
HEAD_WORDS = 1 << 18
#: Classes of the softmax; the last one has all words outside the head.
CLASSES = 32
#: Rows of hashed features, and tokens of one gradient step.
FEATURE_ROWS = 1 << 14
STEP_TOKENS = 8192
RATE = 0.15
#: Passes over all training tokens; weights of all partitions are averaged after each.
ROUNDS = 1
#: Distinct words that a task holds before it hands its counts on.
HELD_WORDS = 1 << 20

END = np.uint64(0x5851F42D4C957F2D)
_BEFORE_TEXT = np.uint64(0x14057B7EF767814F)
_SALTS = tuple(np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def token_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, ASCII case ignored, with an end after each text."""
    words, rows = hash_words(data, offsets, BLANK_SEPARATED, lower=True)
    ends = rows[1:] + np.arange(len(rows) - 1)
    out = np.empty(len(words) + len(ends), np.uint64)
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside], out[ends] = words, END
    return out, np.concatenate(([0], ends + 1))


def features(tokens: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Rows of the four features of each token: last word, last two, and two skips."""
    back = []
    for k in (1, 2, 3):
        moved = np.full(len(tokens), _BEFORE_TEXT, np.uint64)
        moved[k:] = tokens[:-k]
        for j in range(k):
            at = begins[:-1] + j
            moved[at[at < begins[1:]]] = _BEFORE_TEXT
        back.append(moved)
    one, two, three = back
    keys = (one * _SALTS[0], (one * _SALTS[1]) ^ (two * _SALTS[2]), two * _SALTS[3], three * _SALTS[1] + _SALTS[0])
    shift = np.uint64(64 - FEATURE_ROWS.bit_length() + 1)
    return np.stack([(mix(k + np.uint64(i)) >> shift).astype(np.uint16) for i, k in enumerate(keys)])


@dataclass(frozen=True)
class Lexicon:
    """Head words by hash with their counts and classes, and the totals of all words."""

    keys: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    total: int
    distinct: int

    @property
    def tail_mass(self) -> float:
        """Smoothed counts of all words outside the head, an unseen one included."""
        return (self.total - int(self.counts.sum())) + 0.5 * (self.distinct - len(self.keys)) + 0.5

    def class_mass(self) -> np.ndarray:
        mass = np.bincount(self.classes, self.counts + 0.5, CLASSES)
        mass[CLASSES - 1] = self.tail_mass
        return mass

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each token is a head word, its count (0 otherwise) and its class."""
        if not len(self.keys):
            n = len(tokens)
            return np.zeros(n, bool), np.zeros(n, np.int64), np.full(n, CLASSES - 1, np.uint8)
        at = np.minimum(np.searchsorted(self.keys, tokens), len(self.keys) - 1)
        head = self.keys[at] == tokens
        return head, np.where(head, self.counts[at], 0), np.where(head, self.classes[at], CLASSES - 1).astype(np.uint8)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` over all tokens of ``docs``, ends included; words by their hash."""

    def merged(parts):
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

    def out(parts):
        keys, counts = merged(parts)
        for i in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[i : i + 100_000].view(np.int64)), pa.array(counts[i : i + 100_000])], ["word", "n"]
            )

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column("text")):
                held.append(np.unique(token_stream(data, offsets)[0], return_counts=True))
                if sum(len(k) for k, _ in held) > HELD_WORDS:
                    held = [merged(held)]
                    if len(held[0][0]) > HELD_WORDS // 2:
                        yield from out(held)
                        held = []
        if held:
            yield from out(held)

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(counts: DataFrame) -> Lexicon:
    """Totals of ``counts`` and its most frequent words, at most ``HEAD_WORDS``.

    The head is cut at a count, found from a histogram of a fixed number of bins.
    Classes have about the same share of the tokens each, frequent words first.
    """
    level = F.floor(F.log2("n") * 16).cast("int")
    bins = counts.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")
    ).collect()
    total, distinct = sum(b["tokens"] for b in bins), sum(b["words"] for b in bins)
    cut, held = None, 0
    for b in sorted(bins, key=lambda b: -b["level"]):
        held += b["words"]
        if held > HEAD_WORDS:
            break
        cut = b["level"]
    head = counts.where(level >= cut).toArrow() if cut is not None else None
    keys = head.column("word").to_numpy().view(np.uint64) if head else np.zeros(0, np.uint64)
    n = head.column("n").to_numpy() if head else np.zeros(0, np.int64)
    by_count = np.lexsort((keys, -n))
    share = (np.cumsum(n[by_count]) - n[by_count]) / max(1, int(n.sum()))
    classes = np.zeros(len(n), np.uint8)
    classes[by_count] = np.minimum((share * (CLASSES - 1)).astype(np.uint8), CLASSES - 2)
    order = np.argsort(keys)
    return Lexicon(keys[order], n[order], classes[order], int(total), int(distinct))


def class_bias(lexicon: Lexicon) -> np.ndarray:
    mass = lexicon.class_mass()
    return np.log((mass + 1e-9) / (mass + 1e-9).sum()).astype(np.float32)


def _log_softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    logits = weights[rows[0]]
    for r in rows[1:]:
        logits += weights[r]
    logits += bias
    logits -= logits.max(axis=1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logits


def gradient_step(weights, squares, bias, rows, classes) -> None:
    """One adaptive step on some tokens, in place."""
    error = np.exp(_log_softmax(weights, bias, rows))
    error[np.arange(len(classes)), classes] -= 1
    flat = rows.reshape(-1)
    order = np.argsort(flat, kind="stable")
    own = flat[order]
    begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    gradient = np.add.reduceat(error[order % len(classes)], begin, axis=0)
    touched = own[begin]
    squares[touched] += gradient * gradient
    weights[touched] -= RATE * gradient / np.sqrt(squares[touched] + 1.0)


def train_round(docs: DataFrame, lexicon, start: np.ndarray) -> np.ndarray:
    """One pass of gradient steps in every partition, then the mean of their weights.

    ``lexicon`` is a broadcast. The mean of a row goes by how many tokens used it
    in each partition; only rows that were used are handed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(start)
    bias = class_bias(lexicon.value)

    def run(batches):
        weights, words = shared.value.copy(), lexicon.value
        squares, used = np.zeros_like(weights), np.zeros(len(weights), np.int64)
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column("text")):
                tokens, begins = token_stream(data, offsets)
                rows, classes = features(tokens, begins), words.find(tokens)[2]
                for i in range(0, len(tokens), STEP_TOKENS):
                    own = rows[:, i : i + STEP_TOKENS]
                    gradient_step(weights, squares, bias, own, classes[i : i + STEP_TOKENS])
                    used += np.bincount(own.reshape(-1), minlength=len(used))
        there = np.flatnonzero(used)
        columns = [pa.array(weights[there, c].astype(np.float64) * used[there]) for c in range(CLASSES)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(there.astype(np.int32)), pa.array(used[there]), *columns], ["row", "used", *names]
        )

    names = [f"w{c}" for c in range(CLASSES)]
    schema = "row int, used long, " + ", ".join(f"{n} double" for n in names)
    summed = docs.select("text").mapInArrow(run, schema).groupBy("row").agg(
        F.sum("used").alias("used"), *(F.sum(n).alias(n) for n in names)
    ).toArrow()
    out = start.copy()
    rows, used = summed.column("row").to_numpy(), summed.column("used").to_numpy()
    for c, n in enumerate(names):
        out[rows, c] = (summed.column(n).to_numpy() / used).astype(np.float32)
    return out


SCORED = (
    "key long, doc_id long, held_out boolean, n_tokens long, n_head long, head_log double, "
    "class_log double, word_log double, tail array<bigint>"
)


def _score(given: DataFrame, lexicon, weights: np.ndarray) -> DataFrame:
    shared = given.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        words, weights = lexicon.value, shared.value
        bias = class_bias(words)
        class_log10 = np.log10(np.maximum(words.class_mass(), 1e-300))
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column("text")):
                tokens, begins = token_stream(data, offsets)
                rows = features(tokens, begins)
                head, counts, classes = words.find(tokens)
                chosen = np.empty(len(tokens))
                for i in range(0, len(tokens), STEP_TOKENS):
                    own = classes[i : i + STEP_TOKENS]
                    chosen[i : i + STEP_TOKENS] = _log_softmax(weights, bias, rows[:, i : i + STEP_TOKENS])[
                        np.arange(len(own)), own
                    ]
                in_head = np.where(head, np.log10(counts + 0.5), 0.0)
                n = len(offsets) - 1
                sums = [np.add.reduceat(x, begins[:-1]) for x in (
                    head.astype(np.int64), in_head, chosen / math.log(10), in_head - class_log10[classes]
                )]
                tail = tokens[~head].view(np.int64)
                tail_at = np.searchsorted(np.flatnonzero(~head), begins)
                given = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [given.column("key"), given.column("doc_id"), given.column("held_out"), pa.array(np.diff(begins)),
                     *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(tail_at, pa.int32()), pa.array(tail))],
                    [c.split(" ")[0] for c in SCORED.split(", ")],
                )

    return given.mapInArrow(run, SCORED)


def lm_scores(docs: DataFrame, train: Column, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    Tokens are blank-separated words, ASCII case ignored, and one end; a null text is
    empty. ``train`` tells the rows to learn from, the others are held out. Counts
    cover all training tokens. ``base_score`` is the smoothed unigram log10
    probability; ``score`` that of the model: the class of a token given hashed
    features of the words before it, times the token's smoothed share of its class.
    The last class has all words outside the head, unseen ones too; their counts come
    by a join. Repeated rows are rows of their own; without training rows both scores
    are those of the smoothing alone; an empty table gives no rows.
    """
    counts = stored(word_counts(docs.where(train)), "lm-counts")
    lexicon = build_lexicon(counts)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    weights = np.zeros((FEATURE_ROWS, CLASSES), np.float32)
    for _ in range(rounds):
        weights = train_round(docs.where(train), shared, weights)
    given = docs.select(
        F.monotonically_increasing_id().alias("key"), "doc_id", (~train).alias("held_out"), "text"
    )
    scored = stored(_score(given, shared, weights), "lm-scored")
    tail = scored.select("key", F.explode("tail").alias("word"))
    found = tail.join(counts, "word").groupBy("key").agg(
        F.count(F.lit(1)).alias("tail_known"), F.sum(F.log10(F.col("n") + 0.5)).alias("tail_log")
    )
    unseen = F.col("n_tokens") - F.col("n_head") - F.coalesce("tail_known", F.lit(0))
    rest = F.coalesce("tail_log", F.lit(0.0)) + unseen * math.log10(0.5)
    norm = math.log10(lexicon.total + 0.5 * (lexicon.distinct + 1))
    return scored.drop("tail").join(found, "key", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_head") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.total).cast("bigint").alias("train_tokens"),
        (F.col("head_log") + rest - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("class_log") + F.col("word_log") + rest).alias("score"),
    )
