"""Exact top-k by inner product over a pivot-distance index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.llm.common import stored

#: Pivots are fitted on at most this many rows, chosen by a hash of the id.
SAMPLE_ROWS = 4096
PIVOTS = 64
#: Most annuli around a pivot. Pivots times annuli bounds the summary that tasks receive.
ANNULI = 32
#: Vectors wanted in an annulus, while there are fewer than the most pivots and annuli.
SEGMENT_ROWS = 512
#: Vectors in a stored block, and queries handled together.
BLOCK_ROWS = 1024
QUERY_ROWS = 128
#: Annuli that each query searches to get its first bound.
FIRST_ANNULI = 2


def quantized(embedding: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component, as longs; null unless all components are finite."""
    x = lambda c: c.cast("double")
    finite = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < F.lit(float("inf"))))
    return F.when(
        embedding.isNotNull() & F.coalesce(finite, F.lit(False)),
        F.transform(embedding, lambda c: F.floor(F.lit(float(scale)) * x(c)).cast("bigint")),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.int64).reshape(len(column), -1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; floating point only where every sum stays below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def fit_pivots(vectors: DataFrame, pivots: int = PIVOTS, rows: int = SAMPLE_ROWS) -> dict[int, np.ndarray]:
    """For each vector length, pivots spread by farthest-first choice and a few means steps.

    Fitted on at most ``rows`` rows. Pivots influence the speed of a search only.
    """
    sample = vectors.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).toArrow()
    by_size: dict[int, list] = {}
    for v in sample.column("v").to_pylist():
        by_size.setdefault(len(v), []).append(v)
    found = {}
    for size, vs in by_size.items():
        x = np.array(vs, np.float64).reshape(len(vs), size)
        chosen = [0]
        nearest = ((x - x[0]) ** 2).sum(1)
        while len(chosen) < min(pivots, len(x)) and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, ((x - x[chosen[-1]]) ** 2).sum(1))
        p = x[chosen]
        for _ in range(5):
            home = _distances(x, p).argmin(1)
            p = np.array([x[home == i].mean(0) if (home == i).any() else p[i] for i in range(len(p))])
        found[size] = p
    return found


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    squared = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (x @ p.T)
    return np.sqrt(np.maximum(squared, 0))


def _keyed(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the nearest pivot, the distance to it and the length of the vector.

    Vectors of a length that the sample lacks are keyed to the origin.
    """
    def run(batches):
        for batch in batches:
            sizes = np.array(batch.column("dim"))
            pivot, dist, norm = (np.zeros(len(sizes), t) for t in (np.int32, np.float64, np.float64))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = _matrix(batch.column("v").take(pa.array(at))).astype(np.float64).reshape(len(at), size)
                p = pivots.get(int(size), np.zeros((1, size)))
                d = _distances(x, p)
                pivot[at] = d.argmin(1)
                dist[at] = d.min(1)
                norm[at] = np.sqrt((x * x).sum(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("vec_id", "dim", "v")] + [pa.array(c) for c in (pivot, dist, norm)],
                ["vec_id", "dim", "v", "pivot", "dist", "norm"],
            )

    given = vectors.select("vec_id", F.size("v").alias("dim"), "v")
    return given.mapInArrow(
        run, "vec_id long, dim int, v array<bigint>, pivot int, dist double, norm double"
    )


def index_shape(rows: int) -> tuple[int, int]:
    """Pivots and annuli for so many rows: about ``SEGMENT_ROWS`` in each, up to the most."""
    pivots = min(PIVOTS, max(1, round((rows / SEGMENT_ROWS) ** 0.5)))
    return pivots, min(ANNULI, max(1, round(rows / SEGMENT_ROWS / pivots)))


def build_index(
    vectors: DataFrame, pivots: dict[int, np.ndarray], annuli: int
) -> tuple[DataFrame, DataFrame]:
    """``(blocks, summary)`` of ``(vec_id, v)`` with whole-number vectors.

    Every row is indexed. A segment is an annulus of a pivot; its width is a part of
    the pivot's largest distance. A segment is cut into blocks of about
    ``BLOCK_ROWS`` rows, so many equal vectors make many blocks, not a large one.
    ``summary`` has at most pivots times annuli rows for each vector length.
    """
    keyed = stored(_keyed(vectors, pivots), "pivot-keyed")
    widths = keyed.groupBy("dim", "pivot").agg((F.max("dist") / annuli).alias("width"))
    ring = F.when(F.col("width") > 0, F.least(F.floor(F.col("dist") / F.col("width")), F.lit(annuli - 1))).otherwise(0)
    ringed = keyed.join(F.broadcast(widths), ["dim", "pivot"]).withColumn("ring", ring.cast("int"))
    summary = ringed.groupBy("dim", "pivot", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("dist").alias("near"), F.max("dist").alias("far"),
        F.max("norm").alias("norm"),
    )
    summary = stored(summary, "pivot-summary")
    parts = F.ceil(F.col("n") / BLOCK_ROWS).cast("bigint")
    part = F.pmod(F.xxhash64("vec_id"), parts).cast("int")
    segment = ["dim", "pivot", "ring"]
    blocks = (
        ringed.join(F.broadcast(summary.select(*segment, "n")), segment)
        .withColumn("part", part)
        .groupBy(*segment, "part")
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    )
    return stored(blocks, "pivot-blocks"), summary


def _upper(q: np.ndarray, pivots: np.ndarray, seg: dict[str, np.ndarray]) -> np.ndarray:
    """For each query and segment, a bound that no inner product in the segment exceeds.

    The distance of query and vector is at least the gap between their distances to
    the pivot; with the largest norm in the segment that bounds the product, as
    does the product of the norms.
    """
    squared = (q * q).sum(1)
    d = _distances(q, pivots)[:, seg["pivot"]]
    gap = np.maximum(0, np.maximum(d - seg["far"][None, :], seg["near"][None, :] - d))
    longest = seg["norm"][None, :]
    bound = np.minimum((squared[:, None] + longest**2 - gap**2) / 2, np.sqrt(squared)[:, None] * longest)
    return bound + 1e-6 * (1 + np.abs(bound))


def _probes(
    queries: DataFrame, summary: DataFrame, pivots: dict[int, np.ndarray], groups: int, first: bool
) -> DataFrame:
    """Pairs of query block and segment to be searched, with the queries that need it.

    The first time each query takes its annuli with the highest bounds; later all
    others whose bound reaches the query's k-th best score.
    """
    rows = summary.toArrow().to_pydict()
    arrays = {k: np.array(v) for k, v in rows.items()}
    by_size = {}
    for size in np.unique(arrays["dim"]) if len(arrays["dim"]) else []:
        at = arrays["dim"] == size
        by_size[int(size)] = {k: v[at] for k, v in arrays.items()}
    shared = queries.sparkSession.sparkContext.broadcast((by_size, pivots))

    def run(batches):
        by_size, pivots = shared.value
        for batch in batches:
            sizes = np.array(batch.column("dim"))
            out: dict[str, list] = {k: [] for k in ("dim", "pivot", "ring", "query_id", "v")}
            least = np.array(batch.column("least").to_pylist(), object)
            for size in np.unique(sizes):
                seg = by_size.get(int(size))
                if seg is None:
                    continue
                at = np.flatnonzero(sizes == size)
                q = _matrix(batch.column("v").take(pa.array(at))).reshape(len(at), size)
                p = pivots.get(int(size), np.zeros((1, size)))
                bound = _upper(q.astype(np.float64), p, seg)
                order = np.argsort(-bound, axis=1, kind="stable")
                for i, row in enumerate(at):
                    if first:
                        take = order[i, :FIRST_ANNULI]
                    else:
                        rest, least_i = order[i, FIRST_ANNULI:], least[row]
                        # Annuli come by falling bound: the first one below the k-th score ends the search.
                        stop = len(rest) if least_i is None else int(
                            np.searchsorted(-bound[i, rest], -float(least_i), "right")
                        )
                        take = rest[:stop]
                    out["dim"] += [int(size)] * len(take)
                    out["pivot"] += seg["pivot"][take].tolist()
                    out["ring"] += seg["ring"][take].tolist()
                    out["query_id"] += [batch.column("vec_id")[int(row)].as_py()] * len(take)
                    out["v"] += [q[i].tolist()] * len(take)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["dim"], pa.int32()), pa.array(out["pivot"], pa.int32()), pa.array(out["ring"], pa.int32()),
                 pa.array(out["query_id"], pa.int64()), pa.array(out["v"], pa.list_(pa.int64()))],
                list(out),
            )

    given = queries.select("vec_id", F.size("v").alias("dim"), "v", "least")
    found = given.mapInArrow(run, "dim int, pivot int, ring int, query_id long, v array<bigint>")
    bucket = F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")
    return (
        found.withColumn("bucket", bucket)
        .groupBy("dim", "pivot", "ring", "bucket")
        .agg(F.collect_list(F.struct("query_id", "v")).alias("asking"))
    )


def _search(probes: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query in each block that it has to look at."""

    def run(batches):
        for batch in batches:
            query, vec, score = [], [], []
            for asking, rows in zip(batch.column("asking"), batch.column("rows"), strict=True):
                asking, rows = asking.values, rows.values
                q_ids, v_ids = np.array(asking.field("query_id")), np.array(rows.field("vec_id"))
                products = _exact(_matrix(asking.field("v")), _matrix(rows.field("v")))
                for i, row in enumerate(products):
                    own = v_ids != q_ids[i]
                    row, ids = row[own], v_ids[own]
                    if len(row) > k:
                        edge = np.partition(row, len(row) - k)[len(row) - k]
                        near = row >= edge
                        row, ids = row[near], ids[near]
                    best = np.lexsort((ids, -row))[:k]
                    query.append(np.full(len(best), q_ids[i]))
                    vec.append(ids[best])
                    score.append(row[best])
            arrays = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (query, vec, score)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["query_id", "vec_id", "score"])

    pairs = probes.join(blocks, ["dim", "pivot", "ring"]).select("asking", "rows")
    return pairs.mapInArrow(run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest inner products, exact.

    ``vectors`` has ``vec_id`` and whole-number ``v``. Rows with a null id or vector
    take no part, repeated rows count once, a row is no candidate for its own id,
    and only vectors of the same length are compared. Ties go to the smaller id. A
    query with fewer candidates gets them all. A search starts in the annuli with
    the highest bounds; the k-th score found there decides, by the triangle
    inequality, which others are read. Products must fit a long.
    """
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    usable = stored(usable.select("vec_id", "v").dropDuplicates(), "pivot-rows")
    queries = usable.where(is_query)
    n_pivots, annuli = index_shape(usable.count())
    groups = max(1, -(-queries.count() // QUERY_ROWS))
    pivots = fit_pivots(usable, n_pivots)
    blocks, summary = build_index(usable, pivots, annuli)
    least = F.lit(None).cast("bigint")
    first = _probes(queries.withColumn("least", least), summary, pivots, groups, True)
    early = stored(_best(_search(first, blocks, k), k).drop("rank"), "pivot-first")
    bar = early.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    bar = bar.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least")).alias("least"))
    later = _probes(queries.join(bar, "vec_id", "left"), summary, pivots, groups, False)
    return _best(early.unionByName(_search(later, blocks, k)), k).select("query_id", "rank", "vec_id", "score")
