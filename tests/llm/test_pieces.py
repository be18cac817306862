"""Pieces of texts against the tokenizers library: very long ones, equal hashes, several scripts."""

import random

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from tokenizers import Tokenizer

from snapstrata.llm import pieces, tokenfile
from snapstrata.llm.pieces import PieceEncoder
from snapstrata.llm.queries import tokenizer_path
from snapstrata.llm.rans import FrequencyTable
from snapstrata.llm.words import BLANK_SEPARATED, hash_words, text_chunks


def encoded(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    ids, counts = PieceEncoder(tokenizer_path()).encode(data, offsets, 2)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def expected(texts):
    library = Tokenizer.from_file(tokenizer_path())
    return [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def with_letter(n, place, letter="b"):
    return "a" * place + letter + "a" * (n - place - 1)


def test_long_pieces_that_differ_far_apart():
    texts = [with_letter(5000, 10), with_letter(5000, 4106), f"{with_letter(9000, 1)} {with_letter(9000, 8193)}"]
    rng = random.Random(2)
    for n in (4000, 4095, 4096, 4097, 8192, 20_000):
        texts += ["".join(rng.choices("ab", k=n)), " ".join(with_letter(n, p) for p in (0, n // 2, n - 1))]
    assert encoded(texts) == expected(texts)


def test_equal_hashes_are_told_apart(monkeypatch):
    """Hashes of two bits: nearly every piece meets another one's entry."""
    monkeypatch.setattr(pieces, "mix", lambda x: x & np.uint64(3))
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["one", "two", "six", "was", "über", "ça", "123", "!?"], k=60)) for _ in range(20)]
    texts += ["", "word", with_letter(3000, 5), with_letter(3000, 6)]
    assert encoded(texts) == expected(texts)


@pytest.mark.parametrize("seed", range(4))
def test_scripts_signs_and_blanks(seed):
    rng = random.Random(seed)
    parts = ["word", "WORD's", "l'été", "naïve", "汉字文本", "日本語。", "שלום", "नमस्ते", "🙂🙃", "á", "½", "٣٤", " ", "　",
             " ", "  ", "\n\n", "\t", "--", "...", "it's", "'ve", "'", "'ll'll", "x²", "€5.00", "<|", "​"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(80)]
    assert encoded(texts) == expected(texts)
    plain = ["".join(rng.choices(["word", " ", "  ", "it's", "9", "!", "\n"], k=30)) for _ in range(40)]
    assert encoded(plain) == expected(plain)


def test_pieces_that_hold_the_sign_between_pieces():
    texts = ["a\x00b word \x00\x00 c", "\x00", "plain words", "x \x00"] * 3
    assert encoded(texts) == expected(texts)


def test_the_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 100)
    encoder = PieceEncoder(tokenizer_path())
    library = Tokenizer.from_file(tokenizer_path())
    for i in range(10):
        text = f"some other words {i} " * 20
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder.encode(data, np.array([0, len(data)]), 2)
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
    assert len(encoder.spelt) < 400


def test_long_words_differ_in_their_hash():
    texts = [with_letter(9000, p) for p in (3, 4099, 8195)]
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    hashes, rows = hash_words(data, np.array([0, len(data)]), BLANK_SEPARATED, lower=True)
    assert rows.tolist() == [0, 3] and len(set(hashes.tolist())) == 3


def test_rows_that_share_an_id_go_by_their_ids(spark, tmp_path):
    rows = [(i % 3 if i % 5 else None, f"text {i % 7} " * (i % 4)) for i in range(120)] + [(1, "same")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for name, parts in (("a", 2), ("b", 9)):
        path = f"file://{tmp_path}/{name}"
        tokenfile.write_token_files(docs.repartition(parts), path, tokenizer_path())
        got = tokenfile.id_checksums(tokenfile.read_token_files(spark, path)).collect()
        found.append(sorted((r.start, r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in got))
    assert found[0] == found[1] and len(found[0]) == len(rows)
    ids = [r[1] for r in found[0]]
    assert ids == sorted(ids)
    assert [r[0] for r in found[0]] == [0, *np.cumsum([r[2] for r in found[0]])[:-1].tolist()]


def test_one_worker_a_task_makes_the_blocks(spark, capsys):
    """Two Python steps in one stage would leave twice as many workers on each executor."""
    tokens = spark.createDataFrame([(1, 2, bytes(4)), (None, 1, bytes(2))], "doc_id long, n_tokens long, ids binary")
    tokenfile._blocks(tokenfile.in_order(tokens), FrequencyTable.of(np.array([1 << 20]))).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_a_worker_reads_the_vocabulary_once(monkeypatch):
    class Counting:
        files = 0

        def __call__(self, model):
            return Tokenizer(model)

        def from_file(self, path):
            self.files += 1
            return Tokenizer.from_file(path)

    counting = Counting()
    monkeypatch.setattr(tokenizers, "Tokenizer", counting)
    PieceEncoder(tokenizer_path())
    assert counting.files == 1


def test_texts_are_encoded_in_bounded_slices():
    texts = ["word " * n for n in range(0, 3000, 7)] + [None, "x" * (2 * tokenfile.TEXT_BYTES), ""]
    slices = list(text_chunks(pa.array(texts), tokenfile.TEXT_BYTES))
    assert b"".join(data.tobytes() for _, data, _ in slices) == "".join(t or "" for t in texts).encode()
    assert [first for first, _, _ in slices] == [0, *np.cumsum([len(o) - 1 for _, _, o in slices])[:-1].tolist()]
    assert all(len(data) <= tokenfile.TEXT_BYTES or len(offsets) == 2 for _, data, offsets in slices)


def test_documents_of_many_blocks_keep_their_places(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_TOKENS", 50)
    texts = {i: f"word {i} " * (i % 40) for i in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    path = f"file://{tmp_path}/tokens"
    tokenfile.write_token_files(docs, path, tokenizer_path())
    assert spark.read.parquet(f"{path}/blocks").count() > 20
    got = sorted(tokenfile.read_token_files(spark, path).collect(), key=lambda r: r.doc_id)
    ids = expected(texts.values())
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == ids
    assert [r.start for r in got] == [0, *np.cumsum(list(map(len, ids)))[:-1].tolist()]
