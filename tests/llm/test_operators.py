"""The training-data operators against plain versions on small tables."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstrata.llm import chat, decontam, langid, maxent, mixing, neardup, pivots, quality, rans, secrets, tokenfile
from snapstrata.llm.queries import tokenizer_path
from snapstrata.llm.words import ALPHANUMERIC, hash_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def words(rng, n, size=400):
    return " ".join(f"w{v}" for v in rng.integers(0, size, n))


@pytest.fixture(scope="module")
def texts():
    """Nulls, empty and very long texts, copies, near copies and a benchmark passage."""
    rng = np.random.default_rng(5)
    base = words(rng, 200)
    near = base.split()
    near[100] = "other"
    passage = words(rng, 30, 10_000)
    rows = [
        None, "", " \t\n", base, base, " ".join(near), words(rng, 300), words(rng, 40_000),
        words(rng, 50) + " " + passage + " " + words(rng, 20), "### *** été it's I'll  x",
        'password = "abcdef123" AKIA' + "Z9" * 10 + " token:abc " + "0f" * 15, "a b c",
    ]
    return rows, passage


@pytest.fixture
def docs(spark, texts):
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", None][i % 3], 0, "clash") for i, t in enumerate(texts[0])]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def test_quality_separates_and_takes_any_text(spark, docs, no_docs):
    good = [(i, "the quiet words of a plain text " * 3, "en", "s", 0, "") for i in range(100, 160)]
    bad = [(i, "zx### qq%%% zz&&& " * 4, "en", "s", 0, "") for i in range(160, 200)]
    known = spark.createDataFrame(good + bad, DOCS)
    labels = known.select("doc_id", (F.col("doc_id") < 160).cast("int").alias("quality"))
    model = quality.fit_quality(known, labels)
    got = {r.doc_id: r.quality_score for r in quality.with_quality(known, model).collect()}
    assert all((got[i] >= 0.5) == (i < 160) for i in got)
    scored = quality.with_quality(docs, model, ["doc_id", "score"], "score").collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert quality.with_quality(no_docs, model).isEmpty()
    assert quality.fit_quality(known, labels.where("false")).shift == 0.0


def test_dual_coordinate_descent_finds_the_separating_plane():
    rows = [np.array([0]), np.array([0, 1]), np.array([1]), np.array([1, 2])]
    values = [np.ones(len(r)) for r in rows]
    weight, bias = quality.dual_coordinate_descent(rows, values, np.array([1, 1, -1, -1]), 3, 10.0, 200)
    margins = [weight[r].sum() + bias for r in rows]
    assert margins[0] > 0.9 and margins[1] > 0.9 and margins[2] < -0.9 and margins[3] < -0.9


ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def test_secret_spans(spark, docs, no_docs):
    for r in secrets.scan_secrets(docs).collect():
        text = r.text or ""
        want = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert [(s.start, s.rank, s.end) for s in r.secret_spans if s.rank < 3] == sorted(want)
    assert secrets.scan_secrets(no_docs).isEmpty()


def test_window_entropy_equals_a_plain_count(spark):
    text = "a8Kd93jfQpZx71mNb2Vc aaaaaaaaaaaaaaaaaaaa"
    window = 8

    def spread(s):
        return sum(round(secrets.SCALE * c * math.log2(c)) for c in Counter(s).values())

    got = spark.createDataFrame([(text,)], "t string").select(secrets.least_spread(F.col("t"), window)).first()[0]
    assert got == min(spread(text[i : i + window]) for i in range(len(text) - window + 1))


def test_allow_list_suppresses(spark):
    rows = [("x9K2mQ7vRt4LpZ8wB3nYc",), ("EXAMPLEx9K2mQ7vRt4LpZ8wB3nYc",)]
    found = secrets.scan_secrets(spark.createDataFrame(rows, "text string")).collect()
    assert [len(r.secret_spans) for r in found] == [1, 0]


def test_near_duplicates(docs, no_docs):
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(got))] == [0, 0, 0, 3, 3, 3, 6, 7, 8, 9, 10, 11]
    kept = neardup.one_of_each(docs.union(docs))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 6, 7, 8, 9, 10, 11] and kept.columns == docs.columns
    assert neardup.near_duplicates(no_docs).isEmpty() and neardup.one_of_each(no_docs).isEmpty()


def test_near_duplicates_lose_no_link(spark):
    """Texts around one shared passage, from near copies to merely similar, against all pairs."""
    rng = np.random.default_rng(9)
    passage = words(rng, 120, 10_000)
    texts = [passage + " " + words(rng, int(n), 10_000) for n in rng.integers(1, 90, 60)]
    for i in range(0, 60, 2):
        edited = texts[i].split()
        edited[int(rng.integers(0, len(edited)))] = f"edit{i}"
        texts.append(" ".join(edited))
    docs = spark.createDataFrame([(i, t, None, None, 0, "") for i, t in enumerate(texts)], DOCS)
    keys = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        hashes, _ = hash_words(data, np.array([0, len(data)]), ALPHANUMERIC, lower=True)
        keys.append(neardup.shingles(hashes, 5))
    want = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if neardup.aligned_similarity(keys[i], keys[j]) >= 0.8 and want[i] != want[j]:
                low, high = sorted((want[i], want[j]))
                want = [low if c == high else c for c in want]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want and 1 < len(set(want)) < 60


def test_near_duplicates_of_short_texts_lose_no_link(spark):
    """Texts of 5 to 60 words with words added or changed at an end, against all pairs."""
    rng = np.random.default_rng(12)
    texts = []
    for n in [*range(5, 20), *range(20, 61, 4)]:
        for more in (1, 2, n // 6):
            text = words(rng, n, 100_000)
            texts += [text, f"{text} {words(rng, more, 100_000)}", " ".join(text.split()[:-1] + ["other"])]
    keys = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        hashes, _ = hash_words(data, np.array([0, len(data)]), ALPHANUMERIC, lower=True)
        keys.append(neardup.shingles(hashes >> np.uint64(32), 5))
    want = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if neardup.aligned_similarity(keys[i], keys[j]) >= 0.8 and want[i] != want[j]:
                low, high = sorted((want[i], want[j]))
                want = [low if c == high else c for c in want]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) < len(texts) - 30


def test_pairs_at_the_threshold_share_a_sketch():
    """By count over the unions: the least probability, and pairs of 4 and 5 shingles in fact."""
    for u in range(4, 400):
        m = math.ceil(0.8 * u - 1e-9)
        if u > neardup.SHORT:
            miss = (1 - math.comb(m, neardup.MINIMA) / math.comb(u, neardup.MINIMA)) ** neardup.SKETCHES
        else:
            miss = (1 - math.comb(m, neardup.SHORT_MINIMA) / math.comb(u, neardup.SHORT_MINIMA)) ** neardup.SHORT_SKETCHES
        assert miss < 1e-5, u
    rng = np.random.default_rng(13)
    for n, more in ((4, 1), (5, 1), (8, 2), (28, 7), (29, 7), (33, 8)):
        for _ in range(200):
            keys = rng.integers(0, 1 << 63, n + more, dtype=np.uint64)
            assert len(np.intersect1d(neardup.text_sketches(keys), neardup.text_sketches(keys[:n])))


def test_alignment_keeps_order():
    a = np.arange(1, 101, dtype=np.uint64) * np.uint64(77)
    swapped = np.concatenate((a[50:], a[:50]))
    x, y = neardup.shingles(a, 5), neardup.shingles(swapped, 5)
    assert neardup.aligned_similarity(x, x) == 1.0
    assert neardup.aligned_similarity(x, y) < 0.8


def test_decontamination(spark, docs, no_docs, texts):
    changed = texts[1].split()
    changed[7] = changed[21] = "instead"
    items = [(1, texts[1]), (2, " ".join(changed)), (3, "nothing of it anywhere " * 5), (4, None), (5, "a b c"), (6, "b c")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_equal for r in decontam.contaminated(docs.union(docs), benchmark).collect()}
    assert got == {(8, 1): 30, (8, 2): 28, (11, 5): 3}
    kept = decontam.without_leaks(docs, benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9, 10]
    assert decontam.without_leaks(docs, benchmark.where("false")).count() == docs.count()
    assert decontam.contaminated(no_docs, benchmark).isEmpty()


def masks_meet(n, unequal, masks):
    """Whether, for each placement of so many unequal words among ``n``, a mask meets equal words only."""
    marks = [sum(1 << i for i in p) for p in itertools.combinations(range(n), unequal)]
    marks, met = np.array(marks, np.int64), np.zeros(len(marks), bool)
    for m in masks:
        for at in range(n - len(m) + 1):
            met |= marks & (int(m[::-1], 2) << at) == 0
    return met.all()


def test_masks_meet_every_overlap():
    for n, unequal in ((13, 2), (14, 2), (15, 3), (16, 3), (20, 4), (25, 5), (30, 6)):
        assert masks_meet(n, unequal, decontam.MASKS)
    for n in (11, 12):
        assert masks_meet(n, n - decontam.words_needed(n), decontam.item_masks(n))


def test_best_run_equals_brute_force():
    rng = np.random.default_rng(4)
    cases = [rng.random(rng.integers(0, 36)) < p for p in (0.5, 0.7, 0.8, 0.9) for _ in range(150)]
    for equal in [*cases, np.array([True] * 10 + [False] + [True] * 3)]:
        best = (0, 0, 0)
        for i, j in itertools.combinations(range(len(equal) + 1), 2):
            same = int(equal[i:j].sum())
            if equal[i] and equal[j - 1] and same >= 4 * (j - i - same) and same > best[2]:
                best = (i, j - i, same)
        assert decontam.best_run(equal) == best


def test_decontamination_finds_every_placement(spark):
    """Items of 13 to 17 words with each placement of the unequal words that still counts."""
    rng = np.random.default_rng(8)
    items, rows, want = [], [], set()
    for n, unequal in ((13, 2), (14, 1), (14, 2), (15, 3), (16, 3), (17, 2)):
        item = words(rng, n, 100_000).split()
        items.append((n * 10 + unequal, " ".join(item)))
        for place in itertools.combinations(range(n), unequal):
            text = [f"x{len(rows)}" if i in place else w for i, w in enumerate(item)]
            if decontam.best_run(np.isin(np.arange(n), place, invert=True))[2] >= decontam.words_needed(n):
                want.add((len(rows), n * 10 + unequal))
            rows.append((len(rows), f"before {' '.join(text)} after"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = decontam.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) > 800


def test_decontamination_finds_short_items_with_substitutions(spark):
    """Items of 5 to 12 words with every placement of as many unequal words as may be, and of one more."""
    rng = np.random.default_rng(6)
    items, rows, want = [], [], set()
    for n in range(5, 13):
        item = words(rng, n, 100_000).split()
        items.append((n, " ".join(item)))
        for unequal in (1, 2, 3):
            assert unequal > n - decontam.words_needed(n) or masks_meet(n, unequal, decontam.item_masks(n))
            for place in itertools.combinations(range(n), unequal):
                text = [f"x{len(rows)}" if i in place else w for i, w in enumerate(item)]
                if decontam.best_run(np.isin(np.arange(n), place, invert=True))[2] >= decontam.words_needed(n):
                    want.add((len(rows), n))
                rows.append((len(rows), f"before {' '.join(text)} after"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = decontam.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and 100 < len(want) < len(rows)


def test_ids_equal_the_tokenizer_and_survive_the_files(spark, docs, no_docs, texts, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    path = f"file://{tmp_path}/tokens"
    tokenfile.write_token_files(docs, path, tokenizer_path())
    got = {r.doc_id: r for r in tokenfile.id_checksums(tokenfile.read_token_files(spark, path)).collect()}
    start = 0
    for i, text in enumerate(texts[0]):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    damaged = spark.read.schema(tokenfile.BLOCKS).parquet(f"{path}/blocks").withColumn("checksum", F.lit(1).cast("long"))
    damaged.write.parquet(f"file://{tmp_path}/bad/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"file://{tmp_path}/bad/table")
    with pytest.raises(Exception, match="DamagedBlock"):
        tokenfile.read_token_files(spark, f"file://{tmp_path}/bad").collect()
    tokenfile.write_token_files(no_docs, f"file://{tmp_path}/none", tokenizer_path())
    assert tokenfile.read_token_files(spark, f"file://{tmp_path}/none").isEmpty()


def test_added_tokens_and_new_letters_equal_the_library():
    from tokenizers import Tokenizer

    from snapstrata.llm.pieces import PieceEncoder

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = [
        "plain it's", "a <|endoftext|> b", "", "<|endoftext|>", "<|endo", "ftext|> x", "a \u1c89b 1", "x\ua7cby",
        "\U000105c0\U000105c1 z", "", "  \n", "<|endoftext|><|endoftext|> \u1c89", "end été", "",
    ]
    for own in (texts, texts[::-1], ["<|endoftext|>"], ["", "", "\u1c89", ""]):
        data = np.frombuffer("".join(own).encode(), np.uint8)
        offsets = np.cumsum([0] + [len(t.encode()) for t in own])
        ids, counts = PieceEncoder.shared(tokenizer_path()).encode(data, offsets, 2)
        want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in own]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 70_000])
def test_range_coder_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.4, n), 999).astype(np.uint32)
    counts = np.bincount(ids, minlength=1000)
    freq = rans.scaled_frequencies(counts)
    assert n == 0 or freq.sum() == 1 << rans.SCALE_BITS and np.all((freq > 0) == (counts > 0))
    table = rans.FrequencyTable.of(freq)
    assert np.array_equal(rans.decode_block(rans.encode_block(ids, table), table), ids)


def test_mixture_meets_its_targets(docs, no_docs):
    sizes, targets, mixture = mixing.mix_sources(docs)
    rows = mixing.taken_words(sizes, targets, mixture).collect()
    assert len(rows) == docs.count() and all(r.taken <= 2 * r.size for r in rows)
    for t in targets.collect():
        ids = [r for r in rows if r.target == t.target and r.source_size == t.source_size]
        assert sum(r.taken for r in ids) == t.goal
    total = sum(r.size for r in rows)
    assert sum(t.target for t in targets.collect()) == pytest.approx(1.5 * total)
    again = mixing.taken_words(*mixing.mix_sources(docs.repartition(7))).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    assert mixing.whole_documents(docs).columns == docs.columns
    assert mixing.whole_documents(no_docs).isEmpty()


def test_conversations_round_trip(spark):
    turns = [
        (1, 0, "user", "a <|end|> \\ </s>[INST] <\\|x"), (1, 1, "user", None), (1, 2, "assistant", "[\\/INST]<"),
        (1, 3, "assistant", ""), (2, 0, None, "x"), (None, 0, "assistant", "é"), (3, 0, "user", "same"), (3, 0, "user", "same"),
    ]
    output = chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    back = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.parse_formatted(output).collect()}
    assert back == {
        1: [(r or "", t or "") for c, _, r, t in turns if c == 1], 2: [("", "x")], None: [("assistant", "é")],
        3: [("user", "same")] * 2,
    }
    loss = output.select("conv_id", chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("t")).collect()
    assert {r.conv_id: r.t for r in loss} == {1: "[\\/INST]<", 2: "", 3: "", None: "é"}
    formatted = output.where("conv_id = 1").first().formatted
    assert formatted.count("<|role|>") == 2 and "</s>" not in formatted


def test_language(spark, docs, no_docs):
    rows = [(i, t, lang, "s", 0, "") for i, (lang, t) in enumerate(
        [("en", "the of and to in is that with for"), ("fr", "le la les des et une dans que pour")] * 5
    )]
    profiles = langid.language_profiles(spark.createDataFrame(rows, DOCS))
    probe = [(1, "that is for the", None, "", 0, ""), (2, "dans la que les", None, "", 0, ""), (3, None, "", "", 0, ""), (4, "12 !", "", "", 0, "")]
    got = langid.with_language(spark.createDataFrame(probe, DOCS), profiles, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["en", "fr", "und", "und"] and all(0 <= r.score <= 1 for r in got)
    assert langid.with_language(docs, langid.language_profiles(no_docs), ["doc_id"]).where("lang_pred <> 'und'").isEmpty()


def test_lm_scores(docs, no_docs, texts):
    train = F.col("doc_id") % 4 != 1
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").replace("I", "i")) + ["\n"] for t in texts[0]]
    tokens = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in t] for t in tokens]
    counts = Counter(w for i, t in enumerate(tokens) if i % 4 != 1 for w in t)
    total, norm = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    for r in maxent.lm_scores(docs, train).collect():
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(own), total, r.doc_id % 4 == 1)
        assert r.n_known == sum(counts[w] > 0 for w in own) and r.score < 0
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / norm) for w in own))
    assert maxent.lm_scores(no_docs, train).isEmpty()
    assert maxent.lm_scores(docs, F.lit(False)).count() == docs.count()


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8))
    x[100:140] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(600, None), (601, [1.0, None]), (602, [float("nan")] * 8), (650, [1.0, 2.0]), (651, [2.0, 0.0]), (5, x[5].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = table.select("vec_id", pivots.quantized(F.col("embedding")).alias("v"))
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in pivots.top_k(vectors, F.col("vec_id") % 50 == 0).collect()}
    whole = np.floor(256 * x).astype(np.int64)
    for q in range(0, 600, 50):
        best = sorted((-int(s), i) for i, s in enumerate(whole @ whole[q]) if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in best]
    assert got[650, 1] == (651, 512 * 256) and (650, 2) not in got
    assert pivots.top_k(vectors.where("false"), F.lit(True)).isEmpty()


def test_word_hashes_do_not_cross_rows():
    data = np.frombuffer(b"ab cdAB", np.uint8)
    hashes, rows = hash_words(data, np.array([0, 5, 5, 7]), ALPHANUMERIC, True)
    assert rows.tolist() == [0, 2, 2, 3] and hashes[0] == hashes[2]


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = set(docs.select("doc_id").toPandas().doc_id)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns, name
        kept = found.toPandas().doc_id
        assert set(kept) <= before
        docs, before = spark.createDataFrame(found.toPandas(), found.schema), set(kept)
    digest = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert digest.count() == docs.count()


def test_differing_parity_bits_never_outnumber_differing_shingles():
    rng = np.random.default_rng(3)
    for n in (1, 40, 600, 9_000):
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in (0, 1, n // 10, n // 2, n):
            y = np.concatenate([x[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)])
            turned = neardup.parity_bits(x.copy()) ^ neardup.parity_bits(y.copy())
            bits = sum(int(b).bit_count() for b in turned.view(np.uint64))
            assert bits <= len(np.setxor1d(x, y))
    assert neardup.parity_bits(np.zeros(0, np.uint64)).tolist() == [0] * neardup.PARITY_LONGS
