"""Quality classifier: a linear hinge-loss model on naive-Bayes-scaled n-gram indicators."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.llm.words import text_chunks

BITS = 18
ORDERS = (1, 2, 3, 4)
#: At most so many labelled rows of each class are used to fit the model.
ROWS_PER_CLASS = 2500
SEED = 7


@dataclass(frozen=True)
class QualityModel:
    """``ratio`` scales the indicators, ``weight`` is the linear model over them."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, features: np.ndarray) -> float:
        """Probability of class 1 for the distinct n-grams of a text; 0 n-grams are allowed."""
        scaled = self.ratio[features]
        norm = float(np.sqrt(scaled @ scaled)) or 1.0
        margin = float(scaled @ self.weight[features]) / norm + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def ngram_features(text: np.ndarray) -> np.ndarray:
    """Sorted distinct buckets of the byte n-grams of a text."""
    grams, code = [], np.zeros(len(text), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        n = len(text) - order + 1
        if n <= 0:
            break
        code = (code[:n] << np.uint32(8)) | text[order - 1 :]
        if order in ORDERS:
            salted = (code ^ np.uint32(order * 0x3C6EF372)) * np.uint32(0x9E3779B1)
            grams.append((salted ^ (salted >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - BITS))
    if not grams:
        return np.zeros(0, np.uint32)
    found = np.concatenate(grams)
    found.sort()
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def _extract(batches):
    for batch in batches:
        found = []
        for _, data, offsets in text_chunks(batch.column("text")):
            found += [
                ngram_features(data[a:b]).astype("<u4").tobytes()
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(found, pa.binary())], ["label", "features"]
        )


def labelled_sample(labels: DataFrame, train: Column, rows_per_class: int) -> DataFrame:
    """``(doc_id, label)`` of at most ``rows_per_class`` documents of either class.

    Rows with a null id or a label other than 0 and 1 are left out; of several
    labels of a document the lowest counts. The choice goes by a hash of the id.
    """
    clean = (
        labels.where(train & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    )
    parts = [
        clean.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


class ScaledRows:
    """Scaled indicators of each row, of unit length, made when they are asked for: kept, they would
    take as much memory again as the rows."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __getitem__(self, i: int) -> np.ndarray:
        scaled = self.ratio[self.rows[i]]
        return (scaled / (np.sqrt(scaled @ scaled) or 1.0)).astype(np.float32)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray] | ScaledRows, signs: np.ndarray, size: int,
    cost: float = 1.0, epochs: int = 15,
) -> tuple[np.ndarray, float]:
    """Linear support vectors with hinge loss; rows are sparse, a constant 1 is the bias."""
    weight, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    squares = np.array([v @ v + 1.0 for v in values])
    rng = np.random.Generator(np.random.PCG64(SEED))
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            own = values[i]
            gradient = signs[i] * (weight[rows[i]] @ own + bias) - 1.0
            new = min(max(alpha[i] - gradient / squares[i], 0.0), cost)
            step = (new - alpha[i]) * signs[i]
            if step:
                largest = max(largest, abs(step))
                alpha[i] = new
                weight[rows[i]] += step * own
                bias += step
        if largest < 1e-3:
            break
    return weight, bias


def _logistic(margins: np.ndarray, positive: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities, by weighted Newton steps."""
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        error, curve = weights * (p - positive), weights * p * (1 - p)
        g = np.array([error @ margins + 1e-3 * (slope - 1), error.sum()])
        h = np.array([[curve @ margins**2 + 1e-3, curve @ margins], [curve @ margins, curve.sum() + 1e-9]])
        slope, shift = np.array([slope, shift]) - np.linalg.solve(h, g)
    return float(max(slope, 1e-6)), float(shift)


def fit_quality(
    docs: DataFrame, labels: DataFrame, train: Column | None = None,
    rows_per_class: int = ROWS_PER_CLASS,
) -> QualityModel:
    """Fit on a bounded sample of the labelled rows for which ``train`` holds.

    The bound, ``rows_per_class`` for either class, also bounds what is broadcast
    (ids and labels) and what the driver receives (n-gram buckets). Texts are not
    shortened. Without rows of both classes the model answers with the only class
    seen, 0.5 when there is none.
    """
    train = F.lit(True) if train is None else train
    sample = labelled_sample(labels, train, rows_per_class)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "text")
    found = chosen.mapInArrow(_extract, "label int, features binary").toArrow()
    label = found.column("label").to_numpy().astype(np.int64)
    # Views into the one buffer that came from the tasks.
    column = found.column("features").combine_chunks().cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, "<i8")[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    rows = [data[a:b].view("<u4") for a, b in zip(ends[:-1], ends[1:], strict=True)]
    order = sorted(range(len(rows)), key=lambda i: (label[i], rows[i].tobytes()))
    label, rows = label[order], [rows[i] for i in order]
    size, n = 1 << BITS, np.bincount(label, minlength=2)
    nothing = np.zeros(size, np.float32)
    if min(n) == 0:
        certain = 0.0 if n.sum() == 0 else (20.0 if n[1] else -20.0)
        return QualityModel(nothing, nothing, 0.0, 1.0, certain)
    counts = np.ones((2, size))
    for c, r in zip(label, rows, strict=True):
        counts[c, r] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = ScaledRows(rows, ratio)
    signs = np.where(label == 1, 1.0, -1.0)
    weight, bias = dual_coordinate_descent(rows, values, signs, size)
    margins = np.array([weight[r] @ v for r, v in zip(rows, values, strict=True)]) + bias
    # The sample holds as many rows of the rare class as there are; frequencies are restored here.
    real = {r["label"]: r["n"] for r in _class_counts(labels, train)}
    share = np.array([real.get(0, n[0]) / n[0], real.get(1, n[1]) / n[1]])
    weights = share[label] / share[label].mean()
    slope, shift = _logistic(margins, label.astype(float), weights)
    return QualityModel(ratio.astype(np.float32), weight.astype(np.float32), float(bias), slope, shift)


def _class_counts(labels: DataFrame, train: Column):
    known = labels.where(train & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    return known.groupBy(F.col("quality").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()


def with_quality(
    docs: DataFrame, model: QualityModel, keep: list[str] | None = None, score: str = "quality_score"
) -> DataFrame:
    """Columns ``keep`` (all by default) and the score of each whole ``text``.

    One pass without a shuffle. A null text scores as an empty one. A column that
    is already called ``score`` is replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != score]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(*kept, F.col("text").alias("__text"))

    def run(batches):
        model = shared.value
        for batch in batches:
            scores = []
            for _, data, offsets in text_chunks(batch.column("__text")):
                scores += [
                    model.score(ngram_features(data[a:b]))
                    for a, b in zip(offsets[:-1], offsets[1:], strict=True)
                ]
            columns = [batch.column(c) for c in kept] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, score])

    fields = [given.schema[c] for c in kept] + [T.StructField(score, T.DoubleType())]
    return given.mapInArrow(run, T.StructType(fields))
