"""Toxicity: a learned lexicon, matched with misspellings, and hits weighed by their context.

The lexicon holds words and stems that stand in far more of the toxic labelled documents
than of the others. Its trie is intersected with a Levenshtein automaton: a state is a
set of (trie node, edits so far), and the sets that can be reached are made into one
table, so all words of a batch are run through it at once, one letter at a time, and
nearly all are dead after two or three. A hit counts by the log ratio that its term and
number of edits have in the labelled documents, less where its context quotes it and more
where it is said to someone. A logistic model of four sums gives the score.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.llm.common import small_batches, stored
from snapstrata.llm.words import text_chunks

#: At most so many labelled documents of each class are used to learn lexicon and weights.
ROWS_PER_CLASS = 4000
#: Most terms of a lexicon, and the least evidence for one.
MOST_TERMS = 256
LEAST_DOCUMENTS, LEAST_LIFT, LEAST_DEVIATIONS = 3, 4.0, 6.0
#: Letters of a stem, and of a word in the lexicon.
STEM = range(4, 11)
WORD = range(3, 25)
#: Most states of the table; terms of the least evidence lose their misspellings beyond it.
MOST_STATES = 20_000
#: What a misspelling counts of its term without evidence of its own, and how firmly that is held.
MISSPELT, PRIOR_DOCUMENTS = 0.5, 2.0
#: Words on either side that make up a hit's context, and what a quotation or an address does to a hit.
CONTEXT_WORDS = 8
QUOTED, ADDRESSED = 0.25, 1.25

# Signs that open, close or do both, words that report speech, and words of address.
OPENING, CLOSING, BOTH = "«“„", "»”", '"'
REPORTING = frozenset(
    "said says called calls quoted quote wrote writes word words term insult insults slur "
    "dit écrit mot insulte sagte schrieb wort beleidigung dijo escribió palabra insulto".split()
)
ADDRESS = frozenset("you your you're youre ur u tu toi te vous du dich dein sie usted tú eres".split())
# Signs that stand for letters inside a word.
INNER = "*@$"

OUTSIDE, OTHER = 0, 1


def edits_allowed(term: str, stem: bool) -> int:
    """Edits at which a term is still caught: short terms and stems have to be exact."""
    return 0 if stem or len(term) < 5 else 1 if len(term) < 9 else 2


@dataclass(frozen=True)
class Automaton:
    """``table[state, letter class]`` is the next state, 0 the dead one and 1 the first.

    ``ends`` gives the hit of a word that ends in a state, ``passes`` that of a word that goes on,
    as a place in ``hits``, pairs of term and edits, or -1.
    """

    letters: str
    table: np.ndarray
    ends: np.ndarray
    passes: np.ndarray
    hits: list[tuple[int, int]]


def compile_automaton(terms: list[tuple[str, bool]], allowed: list[int] | None = None) -> Automaton:
    """Determinises lexicon trie x Levenshtein automaton. ``terms`` are ``(text, is stem)``, best first.

    Of the hits of a state the one with the fewest edits counts, then the earlier term. ``allowed``
    are the edits of each term. Where the table gets more than ``MOST_STATES`` rows, the later half
    of the terms that may be misspelt have to be exact.
    """
    nodes, words, limits = [{}], [{}], [0]
    allowed = [edits_allowed(t, s) for t, s in terms] if allowed is None else allowed
    for number, (text, stem) in enumerate(terms):
        node = 0
        limits[0] = max(limits[0], allowed[number])
        for letter in text:
            if letter not in nodes[node]:
                nodes[node][letter] = len(nodes)
                nodes.append({})
                words.append({})
                limits.append(0)
            node = nodes[node][letter]
            limits[node] = max(limits[node], allowed[number])
        words[node].setdefault(stem, number)

    def closed(states: dict[int, int]) -> frozenset:
        """Skipping a letter of a term costs an edit; of equal nodes the fewest edits count."""
        waiting = list(states.items())
        while waiting:
            node, edits = waiting.pop()
            if edits > states.get(node, 9):
                continue
            for child in nodes[node].values():
                if edits + 1 <= limits[child] and edits + 1 < states.get(child, 9):
                    states[child] = edits + 1
                    waiting.append((child, edits + 1))
        return frozenset(states.items())

    def step(states: frozenset, letter: str | None) -> frozenset:
        after: dict[int, int] = {}

        def reach(node, edits):
            if edits <= limits[node] and edits < after.get(node, 9):
                after[node] = edits

        for node, edits in states:
            reach(node, edits + 1)
            for own, child in nodes[node].items():
                reach(child, edits + (own != letter))
        return closed(after)

    letters = "".join(sorted({c for text, _ in terms for c in text}))
    dead = frozenset()
    known = {dead: 0, closed({0: 0}): 1}
    order = list(known)
    rows = []
    at = 0
    while at < len(order):
        states = order[at]
        own = {c for node, _ in states for c in nodes[node]}
        own |= {c for node, _ in states for child in nodes[node].values() for c in nodes[child]}
        row = [0] * (len(letters) + 2)
        other = step(states, None)
        for i, letter in enumerate(letters):
            target = step(states, letter) if letter in own else other
            row[i + 2] = known.setdefault(target, len(known))
            if row[i + 2] == len(order):
                order.append(target)
        row[OTHER] = known.setdefault(other, len(known))
        if row[OTHER] == len(order):
            order.append(other)
        rows.append(row)
        at += 1
        if len(order) > MOST_STATES and any(allowed):
            loose = [i for i, a in enumerate(allowed) if a]
            exact = set(loose[len(loose) // 2 :])
            return compile_automaton(terms, [0 if i in exact else a for i, a in enumerate(allowed)])
    return _finished(letters, rows, order, words, allowed)


def _finished(letters, rows, order, words, allowed) -> Automaton:
    """Which hit each state stands for: a word that ends in it, or a stem that goes on."""
    hits: dict[tuple[int, int], int] = {}
    ends, passes = np.full(len(order), -1, np.int32), np.full(len(order), -1, np.int32)
    for i, states in enumerate(order):
        for array, kinds in ((ends, (False,)), (passes, (True,))):
            found = [
                (edits, words[node][stem]) for node, edits in states for stem in kinds
                if stem in words[node] and edits <= allowed[words[node][stem]]
            ]
            if found:
                edits, number = min(found)
                array[i] = hits.setdefault((number, edits), len(hits))
    return Automaton(letters, np.array(rows, np.int32), ends, passes, list(hits))


_KINDS: dict[str, np.ndarray] = {}


def _letter_classes(letters: str) -> np.ndarray:
    """Class of each code point: outside of words, another letter, or a place in ``letters``."""
    if letters not in _KINDS:
        _KINDS.clear()
        kinds = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000).astype(np.uint16)
        for c in INNER:
            kinds[ord(c)] = OTHER
        for i, c in enumerate(letters):
            kinds[ord(c)] = i + 2
        _KINDS[letters] = kinds
    return _KINDS[letters]


def _beside(letter: np.ndarray, sign: np.ndarray, way: int) -> np.ndarray:
    """Whether a letter stands one place away, or two with a sign between."""

    def moved(a, n):
        out = np.zeros(len(a), bool)
        if way > 0:
            out[n:] = a[: max(len(a) - n, 0)]
        else:
            out[: max(len(a) - n, 0)] = a[n:]
        return out

    return moved(letter, 1) | (moved(sign, 1) & moved(letter, 2))


class Words:
    """Lower-case words of some texts as slices of one array of code points."""

    def __init__(self, texts: list[str], kinds: np.ndarray):
        self.codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.kinds = kinds[self.codes]
        sign = np.isin(self.codes, [ord(c) for c in INNER])
        if sign.any():
            # One or two signs stand for letters between letters only.
            letter = (self.kinds > 0) & ~sign
            self.kinds[sign & ~(_beside(letter, sign, 1) & _beside(letter, sign, -1))] = OUTSIDE
        edge = np.diff(np.concatenate(([False], self.kinds > 0, [False])).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if sign.any():
            # Of three signs in a row the middle one is left, alone.
            lettered = ~sign[self.starts]
            self.starts, self.ends = self.starts[lettered], self.ends[lettered]
        lengths = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(lengths + 1) - lengths - 1
        self.first = np.searchsorted(self.starts, np.append(self.begins, len(self.codes) + 1))

    def text(self, start: int, end: int) -> str:
        return self.codes[start:end].tobytes().decode("utf-32-le", "surrogatepass")

    def matches(self, automaton: Automaton) -> tuple[np.ndarray, np.ndarray]:
        """Words with a hit, and its row in ``automaton.hits``. All words advance by a letter at a time."""
        state = np.ones(len(self.starts), np.int32)
        found = np.full(len(self.starts), -1, np.int32)
        alive = np.arange(len(self.starts))
        place = 0
        while len(alive):
            ending = self.starts[alive] + place == self.ends[alive]
            over = alive[ending]
            hit = automaton.ends[state[over]]
            found[over] = np.where(hit >= 0, hit, found[over])
            alive = alive[~ending]
            # A stem is hit only by a word that goes on after it.
            hit = automaton.passes[state[alive]]
            found[alive] = np.where((hit >= 0) & (found[alive] < 0), hit, found[alive])
            state[alive] = automaton.table[state[alive], self.kinds[self.starts[alive] + place]]
            alive = alive[state[alive] > 0]
            place += 1
        which = np.flatnonzero(found >= 0)
        return which, found[which]

    def context(self, word: int, row: int) -> float:
        """How much a hit counts by the words around it: quoted, reported or said to someone."""
        low = max(word - CONTEXT_WORDS, self.first[row])
        high = min(word + CONTEXT_WORDS, self.first[row + 1] - 1)
        before = self.text(self.starts[low], self.starts[word]).rsplit("\n", 1)[-1]
        after = self.text(self.ends[word], self.ends[high]).split("\n", 1)[0]
        # A sign directly at the end of the context still belongs to it.
        edge = self.begins[row + 1] - 1 if row + 1 < len(self.begins) else len(self.codes)
        after += self.text(self.ends[high], min(self.ends[high] + 2, edge)).split("\n", 1)[0]
        lead = self.text(max(self.starts[low] - 2, self.begins[row]), self.starts[low]).rsplit("\n", 1)[-1]
        return context_weight(lead + before, after)


def context_weight(before: str, after: str) -> float:
    """Factor of a hit between two pieces of lower-case text of its line."""
    opened = max((before.rfind(c) for c in OPENING), default=-1)
    enclosed = opened > max(before.rfind(c) for c in CLOSING) and any(c in after for c in CLOSING + OPENING)
    straight = before.count(BOTH) % 2 == 1 and BOTH in after
    left = [w.strip(".,;:!?()\"«»“”„'") for w in before.split()]
    reported = any(w in REPORTING for w in left[-3:])
    if enclosed or straight or reported:
        return QUOTED
    right = [w.strip(".,;:!?()\"«»“”„'") for w in after.split()]
    return ADDRESSED if any(w in ADDRESS for w in left[-3:] + right[:3]) else 1.0


def _lower(column: pa.Array, rows: slice) -> list[str]:
    return [(t or "").lower() for t in column.slice(rows.start, rows.stop - rows.start).to_pylist()]


def _texts(batch: pa.RecordBatch, name: str):
    """First row and lower-case texts of slices of a batch of a bounded size (or of one text)."""
    column = batch.column(name)
    for row, _, offsets in text_chunks(column):
        yield row, _lower(column, slice(row, row + len(offsets) - 1))


# Learning: from labelled documents, which are a bounded sample.


def labelled_sample(labels: DataFrame, train: Column, rows_per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, label)`` of at most so many documents of either class, chosen by a hash of the id, and
    how many documents each class has. Labels other than 0 and 1 and null ids are left out; of
    several labels of a document the highest counts."""
    clean = (
        labels.where(train & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    )
    real = {r["label"]: r["n"] for r in clean.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [
        clean.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class) for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1]), real


def _term_counts(batches):
    """How many toxic and other documents hold each word and each proper stem, by partition."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    kinds = _letter_classes("")

    def drained():
        terms = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([t for t, _ in terms], pa.string()), pa.array([s for _, s in terms], pa.bool_()),
                pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64()),
            ],
            ["term", "stem", "toxic", "other"],
        )
        counts[0].clear(), counts[1].clear()
        return out

    for batch in batches:
        labels = batch.column("label").to_pylist()
        for row, texts in _texts(batch, "text"):
            for i, text in enumerate(texts):
                own = Words([text], kinds)
                words = {own.text(a, b) for a, b in zip(own.starts, own.ends, strict=True) if b - a <= WORD.stop}
                found = {(w, False) for w in words if len(w) in WORD}
                found |= {(w[:n], True) for w in words for n in STEM if n < len(w)}
                counts[labels[row + i]].update(found)
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield drained()
    yield drained()


def choose_terms(counted: DataFrame, toxic: int, other: int) -> list[tuple[str, bool]]:
    """The terms with the surest excess among toxic documents, best first.

    A term needs a lift of at least ``LEAST_LIFT`` and so many standard deviations over the share
    that all documents have. A term is left out where a shorter stem that is already in covers it.
    """
    n = toxic + other
    total = F.col("toxic") + F.col("other")
    share = F.lit(toxic / n)
    excess = (F.col("toxic") - share * total) / F.sqrt(total * share * (1 - share))
    lift = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("other") + 0.5) / (other + 1))
    rows = (
        counted.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where((F.col("toxic") >= LEAST_DOCUMENTS) & (lift >= LEAST_LIFT) & (excess >= LEAST_DEVIATIONS))
        .withColumn("excess", F.round(excess, 6))
        .orderBy(F.desc("excess"), "stem", F.desc(F.length("term")), "term").limit(20 * MOST_TERMS).collect()
    )
    chosen: list[tuple[str, bool]] = []
    for row in rows:
        term = row["term"]
        covered = any(is_stem and term.startswith(s) and len(term) > len(s) for s, is_stem in chosen)
        # A stem of a term that is in stands in more of the other documents.
        nested = row["stem"] and any(t.startswith(term) for t, _ in chosen)
        if not covered and not nested:
            chosen.append((term, row["stem"]))
        if len(chosen) == MOST_TERMS:
            break
    return chosen


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon, automaton, the weight of each of its hits, and the logistic model over ``evidence``."""

    terms: list[tuple[str, bool]]
    automaton: Automaton | None
    weights: np.ndarray
    coefficients: np.ndarray
    intercept: float

    def score(self, evidence: np.ndarray) -> np.ndarray:
        margin = np.clip(evidence @ self.coefficients + self.intercept, -500, 500)
        return 1.0 / (1.0 + np.exp(-margin))


FEATURES = 4


def evidence_of(words: Words, automaton: Automaton, weights: np.ndarray, rows: int, spans: list | None = None) -> np.ndarray:
    """Four sums per text: weighed hits, their square root, different hits, and hits by length.

    A hit counts ``weight x context``; of repeats of a hit the sum grows, the different ones do not.
    """
    out = np.zeros((rows, FEATURES))
    which, hits = words.matches(automaton)
    counts = np.diff(words.first)
    if spans is None:
        which, hits = which[weights[hits] > 0], hits[weights[hits] > 0]
    if not len(which):
        return out
    row_of = np.searchsorted(words.first, which, "right") - 1
    found, begins = np.unique(row_of, return_index=True)
    for row, a, b in zip(found.tolist(), begins, np.append(begins[1:], len(row_of)), strict=True):
        total, different = 0.0, {}
        for word, hit in zip(which[a:b].tolist(), hits[a:b].tolist(), strict=True):
            factor = words.context(word, row)
            value = float(weights[hit]) * factor
            total += value
            different[hit] = max(different.get(hit, 0.0), value)
            if spans is not None:
                begin = int(words.begins[row])
                spans[row].append((int(words.starts[word]) - begin, int(words.ends[word]) - begin, hit, factor))
        out[row] = total, math.sqrt(max(total, 0.0)), sum(different.values()), total / math.log(counts[row] + 10)
    return out


def _hit_rows(automaton: Automaton):
    """Per labelled text, the hits it holds, for their weights."""

    def run(batches):
        kinds = _letter_classes(automaton.letters)
        for batch in batches:
            found = []
            for _, texts in _texts(batch, "text"):
                words = Words(texts, kinds)
                which, hits = words.matches(automaton)
                row_of = np.searchsorted(words.first, which, "right") - 1
                cuts = np.searchsorted(row_of, np.arange(len(texts) + 1))
                found += [sorted(set(hits[a:b].tolist())) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            arrays = [batch.column("label"), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["label", "hits"])

    return run


def hit_weights(automaton: Automaton, seen: np.ndarray, toxic: int, other: int) -> np.ndarray:
    """Log ratio of each hit. A misspelling leans on its term where it has little evidence of its own."""
    ratio = np.log((seen[:, 1] + 0.5) / (toxic + 1)) - np.log((seen[:, 0] + 0.5) / (other + 1))
    exact = {term: ratio[i] for i, (term, edits) in enumerate(automaton.hits) if edits == 0}
    n = seen.sum(axis=1)
    prior = np.array([ratio[i] if e == 0 else MISSPELT**e * exact.get(t, 0.0) for i, (t, e) in enumerate(automaton.hits)])
    return np.maximum((n * ratio + PRIOR_DOCUMENTS * prior) / (n + PRIOR_DOCUMENTS), 0.0)


def _logistic(x: np.ndarray, positive: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton steps. No coefficient is negative: a hit never speaks for a text."""
    used = list(range(x.shape[1]))
    while True:
        design = np.column_stack([x[:, used], np.ones(len(x))])
        beta = np.zeros(design.shape[1])
        ridge = np.append(np.full(len(used), 1e-2), 1e-6)
        for _ in range(60):
            p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
            gradient = design.T @ (weights * (p - positive)) + ridge * beta
            curve = (design * (weights * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
            move = np.linalg.solve(curve, gradient)
            beta -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-9))
        worst = int(np.argmin(beta[:-1])) if used else 0
        if not used or beta[worst] >= 0:
            break
        used.pop(worst)
    out = np.zeros(x.shape[1])
    out[used] = beta[:-1]
    return out, float(beta[-1])


def _constant(toxic: int, other: int) -> ToxicityModel:
    """Without a lexicon every text scores the share of toxic labels, 0.5 when there are none."""
    share = min(max(toxic / max(toxic + other, 1), 1e-9), 1 - 1e-9) if toxic + other else 0.5
    return ToxicityModel([], None, np.zeros(0), np.zeros(FEATURES), math.log(share / (1 - share)))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, train: Column | None = None, rows_per_class: int = ROWS_PER_CLASS
) -> ToxicityModel:
    """Learn lexicon, weights and score from a bounded sample of the labelled rows for which ``train`` holds.

    ``rows_per_class`` also bounds what is broadcast (ids and labels) and what the driver receives
    (four numbers per sampled document, and terms). Texts are not shortened. With labels of
    one class or none, or without any term of enough evidence, the score is the share of toxic labels.
    """
    small_batches(docs.sparkSession)
    train = F.lit(True) if train is None else train
    sample, real = labelled_sample(labels, train, rows_per_class)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "text")
    # Copies are no further evidence: their words would all look like terms.
    chosen = stored(chosen.distinct(), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return _constant(real.get(1, 0), real.get(0, 0))
    counted = chosen.mapInArrow(_term_counts, "term string, stem boolean, toxic long, other long")
    terms = choose_terms(counted, toxic, other)
    if not terms:
        return _constant(real.get(1, 0), real.get(0, 0))
    automaton = compile_automaton(terms)
    found = chosen.mapInArrow(_hit_rows(automaton), "label int, hits array<int>")
    seen = np.zeros((len(automaton.hits), 2))
    for row in found.select("label", F.explode("hits").alias("hit")).groupBy("label", "hit").count().collect():
        seen[row["hit"], row["label"]] = row["count"]
    weights = hit_weights(automaton, seen, toxic, other)

    def evidence(batches):
        kinds = _letter_classes(automaton.letters)
        for batch in batches:
            rows = [evidence_of(Words(t, kinds), automaton, weights, len(t)) for _, t in _texts(batch, "text")]
            flat = np.concatenate(rows) if rows else np.zeros((0, FEATURES))
            columns = [batch.column("label"), *[pa.array(flat[:, i]) for i in range(FEATURES)]]
            yield pa.RecordBatch.from_arrays(columns, ["label", *[f"x{i}" for i in range(FEATURES)]])

    fields = "label int, " + ", ".join(f"x{i} double" for i in range(FEATURES))
    table = chosen.mapInArrow(evidence, fields).toArrow()
    label = table.column("label").to_numpy().astype(np.int64)
    x = np.column_stack([table.column(f"x{i}").to_numpy() for i in range(FEATURES)])
    order = np.lexsort((*x.T, label))
    label, x = label[order], x[order]
    # The sample may hold more of the rare class than there is; frequencies are restored here.
    share = np.array([real.get(0, other) / other, real.get(1, toxic) / toxic])
    coefficients, intercept = _logistic(x, label.astype(float), share[label] / share[label].mean())
    return ToxicityModel(terms, automaton, weights, coefficients, intercept)


SPAN_DDL = "array<struct<begin: int, end: int, term: string, edits: int, context: double>>"


def with_toxicity(
    docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None, score: str = "toxicity",
    spans: str | None = None,
) -> DataFrame:
    """Columns ``keep`` (all by default), the score of each whole ``text`` and, if named, its hits.

    ``spans`` gives place (in the lower-case text), term, edits and context factor of each hit.
    One pass without a shuffle. A null text scores as an empty one; a column that is already
    called like an output is replaced.
    """
    small_batches(docs.sparkSession)
    named = [score] + ([spans] if spans else [])
    kept = [c for c in (docs.columns if keep is None else keep) if c not in named]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(*kept, F.col("text").alias("__text"))

    def run(batches):
        model = shared.value
        automaton = model.automaton
        kinds = _letter_classes(automaton.letters) if automaton else None
        for batch in batches:
            scores, found = [], []
            for _, texts in _texts(batch, "__text"):
                hits = [[] for _ in texts]
                evidence = np.zeros((len(texts), FEATURES))
                if automaton:
                    evidence = evidence_of(Words(texts, kinds), automaton, model.weights, len(texts), hits if spans else None)
                scores += model.score(evidence).tolist()
                if spans:
                    for row in hits:
                        row[:] = [
                            {"begin": a, "end": b, "term": model.terms[automaton.hits[h][0]][0], "edits": automaton.hits[h][1], "context": c}
                            for a, b, h, c in row
                        ]
                    found += hits
            columns = [batch.column(c) for c in kept] + [pa.array(scores, pa.float64())]
            if spans:
                kind = pa.struct(
                    [("begin", pa.int32()), ("end", pa.int32()), ("term", pa.string()), ("edits", pa.int32()), ("context", pa.float64())]
                )
                columns.append(pa.array(found, pa.list_(kind)))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *named])

    fields = [given.schema[c] for c in kept] + [T.StructField(score, T.DoubleType())]
    if spans:
        fields.append(T.StructField(spans, T.DataType.fromDDL(SPAN_DDL)))
    return given.mapInArrow(run, T.StructType(fields))
