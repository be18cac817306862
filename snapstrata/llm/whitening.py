"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Every entry c becomes the whole number ``floor(1024 c) + 100000``, so that counts, sums
and deviations are exact. The centred rows X are never held together: each step of the
bidiagonalisation is one pass in which tasks form ``X v`` and ``Xᵀ (X v)`` block by
block. A left vector is a combination of the rows' products with earlier right
vectors, so it is not stored: a pass forms it anew, and its products with the new one
come back with the sums. The driver holds vectors of one entry per dimension or step.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.llm.common import small_batches, stored

# Fixed values of the whole-number form of an entry.
SCALE, OFFSET = 1024, 100_000
#: Entries beyond this have no exact whole-number form and make a vector invalid.
LARGEST = float(1 << 40)
COMPONENTS = 8
#: Rows of a stored block; a thousand blocks go to a worker at once.
BLOCK_ROWS = 256
SEED = 11


@dataclass(frozen=True)
class Whitening:
    """What is known of the rows that a whitening was fitted on.

    ``sums`` are exact; ``components`` are rows of unit length by falling ``eigenvalues``
    of the covariance (divisor ``n``), whose sum is ``trace``. ``identity_error`` is the
    largest absolute entry of the whitened rows' covariance minus the identity, over the
    components of a positive eigenvalue.
    """

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def scales(self) -> np.ndarray:
        """One over the standard deviation of each component, 0 where there is none."""
        usable = self.usable
        return np.where(usable, 1 / np.sqrt(np.where(usable, self.eigenvalues, 1.0)), 0.0)

    @property
    def usable(self) -> np.ndarray:
        """Whether a component's deviation is more than what rounding leaves."""
        return self.eigenvalues > 1e-20 * max(self.trace, 1e-300)


def valid_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows whose vector is whole and finite, and their whole-number entries by row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_list(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.fill_null(column.flatten(), math.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(~(np.abs(entries) <= LARGEST))))
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - sizes])
    entries = np.where(np.abs(entries) <= LARGEST, entries, 0.0)
    whole = np.floor(SCALE * entries).astype(np.int64) + OFFSET
    rows = np.flatnonzero(good)
    return rows, [whole[ends[i] - sizes[i] : ends[i]] for i in rows]


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """The vectors as rows; a shorter one is filled up with the form of 0."""
    out = np.full((len(vectors), width), OFFSET, np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v[:width]
    return out


def _blocks(batches):
    """Blocks of rows of one width as bytes, with their exact sums per dimension."""
    for batch in batches:
        _, vectors = valid_vectors(batch.column("__v"))
        for at in range(0, len(vectors), BLOCK_ROWS):
            part = vectors[at : at + BLOCK_ROWS]
            rows = matrix(part, max(map(len, part)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(part)], pa.int64()), pa.array([rows.shape[1]], pa.int64()),
                    pa.array([rows.astype("<i8").tobytes()], pa.binary()),
                    pa.array([rows.sum(axis=0).tolist()], pa.list_(pa.int64())),
                ],
                ["n", "width", "rows", "sums"],
            )


BLOCK_SCHEMA = "n long, width long, rows binary, sums array<bigint>"


def row_blocks(vectors: DataFrame, column: str) -> DataFrame:
    """The valid vectors as stored blocks of at most ``BLOCK_ROWS`` rows."""
    small_batches(vectors.sparkSession)
    given = vectors.select(F.col(column).alias("__v"))
    return stored(given.mapInArrow(_blocks, BLOCK_SCHEMA), "whitening-rows")


def column_sums(blocks: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Rows and exact sums per dimension; a block that is narrower stands for the form of 0."""
    width = blocks.agg(F.max("width")).first()[0] or 0
    n = blocks.agg(F.sum("n")).first()[0] or 0
    places = blocks.select("n", F.posexplode("sums").alias("place", "sum"))
    found = places.groupBy("place").agg(
        F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"), F.sum("n").alias("n")
    ).collect()
    sums = [0] * width
    for row in found:
        sums[row["place"]] = int(row["sum"]) + OFFSET * (n - row["n"])
    return n, tuple(sums)


def _deviations(rows: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n x - S``, exact: whole numbers of 64 bits where they fit, of any size otherwise."""
    largest = n * int(np.abs(rows).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if largest < 1 << 62:
        return n * rows - np.array(sums, np.int64)
    return n * rows.astype(object) - np.array(sums, object)


def centred(rows: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Rows minus the mean: subtracted before anything is rounded."""
    return _deviations(rows, n, sums).astype(np.float64) / n


def squared_deviation(rows: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sum of ``(n x - S)²`` per row, null where 64 bits cannot hold it."""
    off = _deviations(rows, n, sums)
    if off.dtype == object or int(np.abs(off).max(initial=0)) ** 2 * max(1, rows.shape[1]) >= 1 << 63:
        totals = [sum(int(x) ** 2 for x in row) for row in off]
        return [t if t < 1 << 63 else None for t in totals]
    return (off * off).sum(axis=1).tolist()


def _totals(blocks: DataFrame, n: int, sums: tuple[int, ...], products) -> np.ndarray:
    """Sum over all blocks of ``products(centred block)``, an array of fixed length.

    Each task adds up its own blocks and sends one array.
    """
    width = len(sums)

    def run(batches):
        total = None
        for batch in batches:
            for size, raw in zip(batch.column("width").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                rows = np.frombuffer(raw, "<i8").reshape(-1, size)
                if size < width:
                    rows = np.pad(rows, ((0, 0), (0, width - size)), constant_values=OFFSET)
                found = products(centred(rows, n, sums))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])

    parts = blocks.select("width", "rows").mapInArrow(run, "total array<double>").toArrow()
    arrays = np.array(parts.column("total").to_pylist(), np.float64)
    # A correctly rounded sum does not depend on the order in which the tasks end.
    return np.array([math.fsum(column) for column in arrays.T])


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """Full reorthogonalisation: twice, which leaves nothing but rounding."""
    if basis:
        known = np.array(basis)
        for _ in range(2):
            vector = vector - known.T @ (known @ vector)
    return vector


def _product(blocks, n, sums, vector, coefficients, images):
    """One pass: ``X vector`` less its share in the left vectors, as a combination of rows' products.

    Returns that combination, its image under Xᵀ, and the squares of the norm before and after.
    """
    width = len(sums)
    lefts, known = np.array(coefficients).reshape(-1, width), np.array(images).reshape(-1, width)

    def products(x):
        y = x @ vector
        # Xᵀ(Xv), the products of Xv with all left vectors, and its square.
        return np.concatenate((x.T @ y, (x @ lefts.T).T @ y, [y @ y]))

    total = _totals(blocks, n, sums, products)
    image, along, square = total[:width], total[width:-1], total[-1]
    return vector - lefts.T @ along, image - known.T @ along, square, square - along @ along


def bidiagonalise(
    blocks: DataFrame, n: int, sums: tuple[int, ...], trace: float
) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (rows) and singular values of the centred rows, falling.

    Golub-Kahan-Lanczos: ``X v_k = α_k u_k + β_(k-1) u_(k-1)`` and
    ``Xᵀ u_k = α_k v_k + β_k v_(k+1)``, with every new vector made orthogonal to all
    before. Where the recurrence breaks off, it goes on with a new direction, so equal
    and zero singular values are all found. It runs to the last dimension; the small
    bidiagonal matrix then holds all singular values.
    """
    width = len(sums)
    rng = np.random.Generator(np.random.PCG64(SEED))
    rights, coefficients, images = [], [], []
    alphas, betas = [], []
    tiny = 1e-13 * math.sqrt(max(trace * n, 0.0))
    vector = rng.standard_normal(width)
    vector /= np.linalg.norm(vector)
    while len(rights) < width:
        rights.append(vector)
        left, image, square, rest = _product(blocks, n, sums, vector, coefficients, images)
        if rest < 1e-6 * square:
            # Little is left of Xv, and the difference is mostly rounding: its own product tells more.
            left, image, _, rest = _product(blocks, n, sums, left, coefficients, images)
        alpha = math.sqrt(max(rest, 0.0))
        if alpha > tiny:
            left, image = left / alpha, image / alpha
        else:
            alpha, left, image = 0.0, np.zeros(width), np.zeros(width)
        coefficients.append(left)
        images.append(image)
        alphas.append(alpha)
        if len(rights) == width:
            break
        following = _orthogonal(image - alpha * vector, rights)
        beta = float(np.linalg.norm(following))
        if beta <= tiny:
            beta, following = 0.0, _orthogonal(rng.standard_normal(width), rights)
        betas.append(beta)
        vector = following / np.linalg.norm(following)
    small = np.diag(alphas) + np.diag(betas, 1)
    _, values, turned = np.linalg.svd(small)
    return turned @ np.array(rights), values


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on every valid vector of ``column``: null vectors, null and non-finite entries (and entries
    over 2^40) make one invalid. Of vectors of different lengths the shorter are filled up with 0.

    One pass stores the rows in blocks, one gives the exact sums, one the trace, one is made per
    dimension, and one measures the whitened covariance. Without valid rows, or with vectors
    without entries, there are no components.
    """
    blocks = row_blocks(vectors, column)
    n, sums = column_sums(blocks)
    if n == 0 or not sums:
        return Whitening(n, sums, np.zeros((0, len(sums))), np.zeros(0), 0.0, 0.0)
    trace = float(_totals(blocks, n, sums, lambda x: np.array([np.square(x).sum()]))[0]) / n
    directions, values = bidiagonalise(blocks, n, sums, trace)
    k = min(components, len(sums))
    fitted = Whitening(n, sums, directions[:k], values[:k] ** 2 / n, trace, 0.0)
    used = np.flatnonzero(fitted.usable)
    turn = (fitted.components * fitted.scales[:, None])[used].T

    def moments(x):
        w = x @ turn
        return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

    error = 0.0
    if len(used):
        total = _totals(blocks, n, sums, moments) / n
        mean, second = total[: len(used)], total[len(used) :].reshape(len(used), -1)
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(used))).max())
    return Whitening(n, sums, fitted.components, fitted.eigenvalues, trace, error)


def with_whitened(
    vectors: DataFrame, model: Whitening, column: str = "embedding", keep: list[str] | None = None,
    output: str = "whitened",
) -> DataFrame:
    """Rows of valid vectors with ``deviation`` (exact, null beyond 64 bits) and ``output``, an array of the
    projections over their standard deviations; a component without deviation gives null.

    ``keep`` (all columns by default) are carried along; one called ``deviation`` or like ``output``
    is replaced. No shuffle; vectors that are longer than those of the fit are cut to their length.
    """
    small_batches(vectors.sparkSession)
    kept = [c for c in (vectors.columns if keep is None else keep) if c not in (output, "deviation")]
    given = vectors.select(*kept, F.col(column).alias("__v"))
    n, sums = model.n, model.sums
    turn = (model.components * model.scales[:, None]).T
    unusable = np.flatnonzero(~model.usable)

    def run(batches):
        for batch in batches:
            picked, found = valid_vectors(batch.column("__v"))
            rows = matrix(found, len(sums))
            if n:
                whole, spread = centred(rows, n, sums) @ turn, squared_deviation(rows, n, sums)
            else:
                whole, spread = np.zeros((len(rows), 0)), [0] * len(rows)
            lists = whole.tolist()
            for i in unusable:
                for values in lists:
                    values[i] = None
            columns = [batch.column(c).take(pa.array(picked)) for c in kept]
            columns += [pa.array(spread, pa.int64()), pa.array(lists, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "deviation", output])

    fields = [given.schema[c] for c in kept]
    fields += [T.StructField("deviation", T.LongType()), T.StructField(output, T.ArrayType(T.DoubleType()))]
    return given.mapInArrow(run, T.StructType(fields))


def whitened_components(vectors: DataFrame, model: Whitening, column: str, key: str) -> DataFrame:
    """One row per valid vector and component, with the figures of the fit."""
    share = [float(e / model.trace) if model.trace > 0 else None for e in model.eigenvalues]
    shares = F.array(*[F.lit(s).cast("double") for s in share]) if share else F.array().cast("array<double>")
    rows = with_whitened(vectors, model, column, [key], "__whitened")
    return rows.select(key, "deviation", F.posexplode("__whitened").alias("__place", "whitened")).select(
        key,
        (F.col("__place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation", "whitened",
        F.get(shares, F.col("__place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
