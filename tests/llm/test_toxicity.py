"""Toxicity: the automaton against edit distances, contexts, and held-out accuracy."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from snapstrata.llm import queries, toxicity
from snapstrata.llm.toxicity import QUOTED, Words, _letter_classes, compile_automaton, context_weight, edits_allowed

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, toxicity string, spans string"
TERMS = [("grumble", False), ("nitwit", False), ("insufferable", False), ("réeux", True), ("oaf", False), ("grum", True)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def plain_hit(word):
    """Fewest edits, then the first term; a stem only where no whole term is hit."""
    whole = [(distance(word, t), i) for i, (t, stem) in enumerate(TERMS) if not stem]
    whole = [(d, i) for d, i in whole if d <= edits_allowed(TERMS[i][0], False)]
    stems = [(0, i) for i, (t, stem) in enumerate(TERMS) if stem and word.startswith(t) and len(word) > len(t)]
    found = min(whole, default=None)
    # Of two stems the shorter is met first.
    return found or min(stems, key=lambda s: len(TERMS[s[1]][0]), default=None)


def damaged(rng, word):
    letters = list(word)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(letters) + 1)
        if rng.random() < 0.4:
            letters.insert(at, rng.choice("abé*m1"))
        elif letters and at < len(letters):
            letters[at : at + 1] = rng.choice([[], ["x"], ["e"], ["*"]])
    return "".join(letters).strip("*") or "a"


def found_hits(texts, automaton):
    words = Words(texts, _letter_classes(automaton.letters))
    which, hits = words.matches(automaton)
    by_word = dict(zip(which.tolist(), hits.tolist(), strict=True))
    spelt = [words.text(a, b) for a, b in zip(words.starts, words.ends, strict=True)]
    return [(w, automaton.hits[by_word[i]][::-1] if i in by_word else None) for i, w in enumerate(spelt)]


def test_automaton_equals_edit_distances():
    rng = random.Random(1)
    automaton = compile_automaton(TERMS)
    vocabulary = [t for t, _ in TERMS] + ["réeuxment", "plain", "grumbled", "insuferrable", "nit"]
    texts = [" ".join(damaged(rng, rng.choice(vocabulary)) for _ in range(40)) for _ in range(50)]
    for word, hit in found_hits(texts, automaton):
        assert hit == plain_hit(word), word


def test_exhaustive_short_words():
    automaton = compile_automaton([("abcab", False), ("bcaba", False), ("cc", False)])
    for word in map("".join, itertools.chain(*(itertools.product("abcx", repeat=n) for n in range(1, 7)))):
        ((_, hit),) = found_hits([word], automaton)
        options = [(distance(word, t), i) for i, t in enumerate(("abcab", "bcaba", "cc"))]
        options = [(d, i) for d, i in options if d <= (1 if i < 2 else 0)]
        assert hit == min(options, default=None), word


def test_a_table_that_grows_too_large_gives_up_misspellings(monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_STATES", 30)
    automaton = compile_automaton([("grumble", False), ("nitwits", False)])
    assert len(automaton.table) <= 30
    assert {w for w, hit in found_hits(["grumble nitwits other"], automaton) if hit} == {"grumble", "nitwits"}


def test_words_and_signs():
    kinds = _letter_classes("")
    words = Words(["m*ron **bold** a@b l'été f**l x***y", "", "é"], kinds)
    spelt = [words.text(a, b) for a, b in zip(words.starts, words.ends, strict=True)]
    assert spelt == ["m*ron", "bold", "a@b", "l", "été", "f**l", "x", "y", "é"]
    assert words.first.tolist() == [0, 8, 8, 9]


@pytest.mark.parametrize(
    "before, after, weight",
    [
        ('she said "', '" and left', QUOTED), ("he called him a ", " yesterday", QUOTED), ("« ", " »", QUOTED),
        ("“x” ", " y", 1.0), ('"a" ', ' "b"', 1.0), ("you are a ", ".", toxicity.ADDRESSED), ("a plain ", " text", 1.0),
    ],
)
def test_contexts(before, after, weight):
    assert context_weight(before, after) == weight


def corpus(spark, parts=4):
    """Toxic documents hold several terms; others none, or a quoted one."""
    rng = random.Random(3)
    insults = ["nitwit", "insufferable", "grumbler", "dullard"]
    plain = [f"{a}{b}" for a in "ba ke li mo nu ra se to".split() for b in "lan mer pos tik vun".split()]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(plain, k=rng.randint(5, 80))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(insults))
        rows.append((i, " ".join(words), "en", "s", 0, "clash", "clash"))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_terms_and_catches_misspelt_ones(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit_toxicity(docs, labels, F.col("doc_id") % 3 != 1)
    assert {t for t, _ in model.terms} >= {"nitwit", "insufferable", "grumbler", "dullard"}
    scored = toxicity.with_toxicity(docs, model, ["doc_id", "toxicity", "spans"], "toxicity", "spans").collect()
    assert len(scored) == 900 and all((r.toxicity >= 0.5) == (r.doc_id % 5 == 0) for r in scored)
    texts = [
        ("you nitwlt, you insuferable dulard", True), ('he said "nitwit" about them', False), ("balan kemer", False),
        (None, False), ("", False), (" \t", False), ("NITWIT! Dullard! insufferable", True), ("balan " * 200_000, False),
        ("balan " * 50_000 + "nitwit dullard insufferable nitwit grumbler dullard", True),
    ]
    odd = spark.createDataFrame([(i, t, None, None, None, "", "") for i, (t, _) in enumerate(texts)] * 2, SCHEMA)
    got = toxicity.with_toxicity(odd, model, score="toxicity", spans="spans").collect()
    assert len(got) == 2 * len(texts)
    for r in got:
        assert (r.toxicity >= 0.5) == texts[r.doc_id][1], texts[r.doc_id][0][:60]
    hit = next(r for r in got if r.doc_id == 0).spans
    assert [(s.begin, s.end, s.term, s.edits) for s in hit] == [(4, 10, "nitwit", 1), (16, 27, "insufferable", 1), (28, 34, "dullard", 1)]


def test_splits_do_not_change_the_fit(spark):
    docs, labels = corpus(spark, 2)
    more, _ = corpus(spark, 9)
    a, b = (toxicity.fit_toxicity(d, labels, rows_per_class=150) for d in (docs, more))
    assert a.terms == b.terms and a.coefficients.tolist() == b.coefficients.tolist() and a.intercept == b.intercept


def test_without_labels_or_terms(spark):
    docs, labels = corpus(spark)
    nothing = labels.where("false")
    for known, share in ((nothing, 0.5), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0)):
        model = toxicity.fit_toxicity(docs, known)
        got = toxicity.with_toxicity(docs.limit(3), model).collect()
        assert all(abs(r.toxicity - share) < 1e-6 for r in got)
    mixed = labels.withColumn("toxic", (F.xxhash64("doc_id") % 2 == 0).cast("int"))
    score = toxicity.with_toxicity(docs.limit(1), toxicity.fit_toxicity(docs, mixed)).first().toxicity
    assert 0 < score < 1
    empty = docs.where("false")
    assert toxicity.with_toxicity(empty, toxicity.fit_toxicity(empty, labels)).count() == 0
    odd = labels.unionByName(labels.select(F.lit(None).cast("long").alias("doc_id"), "quality", F.lit(7).alias("toxic")))
    assert toxicity.fit_toxicity(docs, odd).terms == toxicity.fit_toxicity(docs, labels).terms


def test_query_on_held_out_labels(spark):
    path = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES["op11_toxicity"](spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet").where("lang = 'en'").join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    known = [(r.toxic, got[r.doc_id]) for r in docs.collect() if got[r.doc_id].held_out]
    assert len(got) == spark.read.parquet(f"{path}/documents.parquet").count()
    assert sum(y == g.predicted for y, g in known) >= 0.9 * len(known)
    assert all(0 <= r.score <= 1 for r in got.values())
