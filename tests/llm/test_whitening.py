"""Whitening against a dense eigendecomposition, and what it does with odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstrata.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n string, whitened int"


def frame(spark, vectors, parts=3):
    rows = [(i, v, "clash", 1) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def whole(vectors):
    return np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000


def dense(x):
    """Mean-free rows, eigenvalues and eigenvectors (columns) by falling eigenvalue."""
    centred = (len(x) * x - x.sum(axis=0)) / len(x)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    return centred, values[::-1], vectors[:, ::-1]


def collected(spark, rows, **named):
    model = whitening.fit_whitening(rows, **named)
    return model, whitening.whitened_components(rows, model, "embedding", "vec_id").collect()


def test_equals_the_dense_form(spark):
    rng = np.random.default_rng(3)
    spread = np.linspace(0.05, 1.0, 12)
    good = (rng.standard_normal((150, 12)) * spread).astype(np.float32).tolist()
    good += good[:20]
    bad = [None, [1.0, None] + [0.0] * 10, [float("nan")] * 12, [float("inf")] + [0.0] * 11]
    model, got = collected(spark, frame(spark, good + bad))
    x = whole(good)
    centred, values, vectors = dense(x)
    assert model.n == 170 and model.sums == tuple(x.sum(axis=0).tolist())
    assert len(got) == 170 * 8 and len({(r.vec_id, r.component) for r in got}) == len(got)
    deviation = ((170 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    found = np.zeros((170, 8))
    for r in got:
        found[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id] and r.n == 170
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12
        assert r.identity_error < 1e-9
    expected = centred @ vectors[:, :8] / np.sqrt(values[:8])
    signs = np.sign((found * expected).sum(axis=0))
    assert np.abs(found * signs - expected).max() < 1e-9


def test_equal_and_missing_deviations(spark):
    """Dimensions of equal deviation, a constant one and a copied one: nothing breaks off early."""
    corners = [[float(a), float(b), 5.0, float(a)] for a in (-1, 1) for b in (-1, 1)] * 3
    model, got = collected(spark, frame(spark, corners))
    centred, values, _ = dense(whole(corners))
    assert np.allclose(model.eigenvalues, values, rtol=1e-12, atol=1e-6)
    by_component = {c: [r.whitened for r in got if r.component == c] for c in range(1, 5)}
    assert all(v is not None for c in (1, 2) for v in by_component[c])
    assert all(v is None for c in (3, 4) for v in by_component[c])
    assert model.identity_error < 1e-9


def test_one_row_and_equal_rows_have_no_deviation(spark):
    model, got = collected(spark, frame(spark, [[1.0, 2.0]] * 5))
    assert model.trace == 0 and {r.whitened for r in got} == {None} and {r.deviation for r in got} == {0}


@pytest.mark.parametrize("vectors", [[], [None, None], [[]], [[float("nan")]]])
def test_without_entries_there_are_no_rows(spark, vectors):
    _, got = collected(spark, frame(spark, vectors))
    assert got == []


def test_shorter_vectors_are_filled_up(spark):
    rows = [[0.5, 1.0, -1.0], [0.25], [1.0, 2.0], [], [0.0, 0.5, 3.0]]
    model, got = collected(spark, frame(spark, rows))
    same, _ = collected(spark, frame(spark, [r + [0.0] * (3 - len(r)) for r in rows]))
    assert model.sums == same.sums and np.allclose(model.eigenvalues, same.eigenvalues, rtol=1e-12)
    assert len(got) == 15


def test_large_deviations_stay_exact_or_are_null():
    rows = np.array([[1 << 40, 0], [1, 3]], np.int64)
    sums = tuple(rows.sum(axis=0).tolist())
    off = 2 * rows.astype(object) - np.array(sums, object)
    exact = [int((r**2).sum()) for r in off]
    assert whitening.squared_deviation(rows, 2, sums) == [t if t < 1 << 63 else None for t in exact]
    assert whitening.squared_deviation(np.array([[3, 5]]), 1 << 40, (2, 2)) == [None]
    assert whitening.squared_deviation(np.array([[3, 5]]), 10, (2, 2)) == [28**2 + 48**2]


def test_columns_are_kept_and_named_ones_replaced(spark):
    rows = frame(spark, [[1.0, 0.0], [0.0, 1.0], [0.5, 0.25]])
    model = whitening.fit_whitening(rows)
    got = whitening.with_whitened(rows, model)
    assert got.columns == ["vec_id", "embedding", "n", "deviation", "whitened"]
    assert got.where(F.size("whitened") == 2).count() == 3


def test_query_over_its_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = queries.QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001").collect()
    centred, values, vectors = dense(whole([r.embedding for r in rows.collect()]))
    ids = {r.vec_id: i for i, r in enumerate(rows.collect())}
    expected = centred @ vectors[:, :8] / np.sqrt(values[:8])
    found = np.zeros_like(expected)
    for r in got:
        found[ids[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(np.abs(found) - np.abs(expected)).max() < 1e-8
