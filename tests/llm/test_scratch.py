"""Large scratch tables go as soon as nothing reads them any more, and the results stay whole."""

import uuid

import pytest

from snapstrata.llm import common, decontam, neardup, tokenfile
from snapstrata.llm.queries import tokenizer_path

PASSAGE = "the quick brown fox jumps over one lazy dog while seven wizards box with their very old hats"


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    def place(spark, label):
        return f"file://{tmp_path}/scratch/{label}-{uuid.uuid4().hex}"

    for module in (common, decontam, neardup, tokenfile):
        monkeypatch.setattr(module, "scratch_dir", place, raising=False)
    return lambda: {p.name[:-33] for p in (tmp_path / "scratch").iterdir()}


@pytest.fixture
def few(spark):
    texts = [f"document {i} tells of matter number {i} and of {i * i} other things in {i + 7} words" for i in range(12)]
    rows = [*enumerate(texts), (20, f"before {PASSAGE} behind"), (21, f"before {PASSAGE} behind"), (22, None), (None, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_profiles_go_with_the_last_turn(few, scratch):
    kept = neardup.one_of_each(few)
    assert "near-rows" in scratch() and "near-profile" not in scratch()
    assert ids(kept) == sorted([*range(12), 20, 22, None], key=str)


def test_hits_go_with_the_leaked_ids(spark, few, scratch):
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    kept = decontam.without_leaks(few, benchmark)
    assert "leaks" in scratch() and "leak-hits" not in scratch()
    assert ids(kept) == sorted([*range(12), 22, None], key=str)
    assert ids(decontam.contaminated(few, benchmark)) == [20, 21]


def test_ids_go_with_the_blocks(spark, few, scratch, tmp_path):
    path = f"file://{tmp_path}/tokens"
    tokenfile.write_token_files(few, path, tokenizer_path())
    assert "token-ids" not in scratch()
    assert tokenfile.read_token_files(spark, path).count() == few.count()
