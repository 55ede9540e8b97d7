"""Centroid clustering in whole numbers, with Ptolemaic pivots.

Vectors are rows of exactly ``dims`` finite components, each turned into the
integer floor(scale * x).  Every vector's distances to a few fixed pivots are
worked out once and kept with it in a written table.  In each round a task knows
the centroids' distances to the pivots too, and for a fixed list of pivot pairs
(s, t) Ptolemy's inequality bounds the distance of vector x and centroid c:

    d(x, c) >= |d(x, s) d(c, t) - d(x, t) d(c, s)| / d(s, t)

The centroid with the least bound is measured first; others are measured only if
their bound does not exceed that.  The bound is lowered by more than all
rounding errors of its computation and skips a centroid only if it is strictly
greater, so every centroid that can be nearest, ties included, is measured
exactly in whole numbers.

A round is one pass that emits per task a count and a sum per cluster; the driver
sees the ``k`` centroids only.  Pivots influence nothing but the number of exact
measurements (``cc_checked``).

Rows with a null, short or long vector, or with a null or non-finite component,
are left out.  A null id hashes as the empty string; rows that share an id are
all clustered, and the first centroids are then ordered by their components.
Fewer vectors than ``k`` give fewer centroids; an empty table gives an empty
result.  Components beyond ``MAX_COMPONENT`` raise an error, since squared
distances would not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibflow.llm.common import clean_name, materialize

CLUSTERS = 8
ROUNDS = 10
DIMS = 64
SCALE = 1024
SEED = "3"
#: Distances to so many pivots are kept; every pair of them gives a bound.
PIVOTS = 4
#: Pivots are chosen among so many vectors of least hash (they decide speed, not results).
PIVOT_SAMPLE = 64
#: (2 * MAX_COMPONENT) ** 2 * 64 stays below 2 ** 63.
MAX_COMPONENT = 1 << 27
#: Up to this component size all terms of a squared distance are exact in a double.
_EXACT_IN_DOUBLE = 1 << 21
#: Relative allowance per product, far above the 2 ** -53 of each operation.
_SLACK = 2.0 ** -48
_BATCH = 1 << 14


def kept_vectors(vectors: DataFrame, embedding: str, dims: int, scale: int, out: str) -> DataFrame:
    """The rows with a whole vector, plus its integer components."""
    e = F.col(f"`{embedding}`")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = F.transform(e, lambda x: F.floor(x.cast("double") * scale))
    checked = F.when(F.forall(e, lambda x: F.abs(x.cast("double") * scale) <= MAX_COMPONENT), whole).otherwise(
        F.raise_error(F.lit(f"a component is beyond {MAX_COMPONENT} after scaling")))
    return vectors.where((F.size(e) == dims) & F.forall(e, finite)).withColumn(out, checked)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to the vector ``c``."""
    d = x - c
    if len(d) and max(abs(int(x.max())), abs(int(x.min())), int(np.abs(c).max())) <= _EXACT_IN_DOUBLE:
        d = d.astype(np.float64)
        return np.einsum("ij,ij->i", d, d).astype(np.int64)
    return np.einsum("ij,ij->i", d, d)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(x, p) for p in pivots], axis=1).astype(np.float64)) if len(pivots) else np.zeros((len(x), 0))


def lower_bounds(near: np.ndarray, centroid: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Lower bounds of the squared distances to one centroid, from distances to pivots; never above the exact value."""
    best = np.zeros(len(near))
    for s, t in combinations(range(pivots.shape[1]), 2):
        apart = pivots[s, t]
        if apart > 0:
            a, b = near[:, s] * centroid[t], near[:, t] * centroid[s]
            np.maximum(best, (np.abs(a - b) - (a + b) * _SLACK) / (apart * (1 + _SLACK)), out=best)
    return best * best * (1 - _SLACK)


def assign(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), squared distance and number of exact measurements per row."""
    n, k = len(x), len(centroids)
    to_pivots = pivot_distances(centroids, pivots)
    between = pivot_distances(pivots, pivots)
    bound = np.stack([lower_bounds(near, to_pivots[j], between) for j in range(k)], axis=1)
    first = bound.argmin(axis=1)
    cluster, checked = first.copy(), np.ones(n, np.int32)
    distance = np.empty(n, np.int64)
    for j in range(k):
        rows = np.flatnonzero(first == j)
        distance[rows] = squared(x[rows], centroids[j])
    for j in range(k):
        rows = np.flatnonzero((first != j) & (bound[:, j] <= distance))
        d = squared(x[rows], centroids[j])
        checked[rows] += 1
        better = (d < distance[rows]) | ((d == distance[rows]) & (j < cluster[rows]))
        cluster[rows[better]], distance[rows[better]] = j, d[better]
    return cluster, distance, checked


def _matrix(column: pa.Array, dims: int, dtype) -> np.ndarray:
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims), dtype=dtype)


def _round(centroids: np.ndarray, pivots: np.ndarray):
    """A pass over (components, pivot distances): one row per cluster with its count and sums."""
    k, dims = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                x = _matrix(part.column(0), dims, np.int64)
                cluster, _, _ = assign(x, _matrix(part.column(1), len(pivots), np.float64), centroids, pivots)
                count += np.bincount(cluster, minlength=k)
                for j in range(k):
                    total[j] += x[cluster == j].sum(axis=0)
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used])] + [
                pa.array(total[used, d]) for d in range(dims)], names=["cluster", "n"] + [f"s{d}" for d in range(dims)])

    return run, "cluster int, n long, " + ", ".join(f"s{d} long" for d in range(dims))


def _last(centroids: np.ndarray, pivots: np.ndarray):
    """The last pass: the other columns with cluster, squared distance and number of measurements."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                cluster, distance, checked = assign(_matrix(part.column(0), centroids.shape[1], np.int64),
                                                    _matrix(part.column(1), len(pivots), np.float64), centroids, pivots)
                yield pa.RecordBatch.from_arrays([part.column(2), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(checked)],
                                                 names=["others", "cluster", "distance", "checked"])

    return run


def _with_pivots(pivots: np.ndarray, dims: int, place: int):
    """A pass that adds the distances to the pivots; ``place`` is the column of components."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pivot_distances(_matrix(batch.column(place), dims, np.int64), pivots)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, max(1, near.shape[1]), dtype=np.int32)), pa.array(near.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "near"])

    return run


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice of up to ``n`` different rows of ``sample``."""
    if not len(sample):
        return sample
    chosen, gap = [0], squared(sample, sample[0])
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def hash_order(vec_id: Column, seed: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


def cluster_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
                    dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """The kept rows of ``vectors`` without the vector, plus ``cc_cluster``, ``cc_distance`` (squared),
    ``cc_cluster_inertia``, ``cc_inertia``, ``cc_centroid`` (components), ``cc_centroid_sha256`` and ``cc_checked``."""
    x = clean_name(vectors.columns, "cc_components")
    kept = kept_vectors(vectors, embedding, dims, scale, x)
    by_hash = kept.select(hash_order(F.col(f"`{vec_id}`"), seed).alias("h"), F.col(x).alias("x"))
    first = [r["x"] for r in by_hash.orderBy("h", "x").limit(max(k, PIVOT_SAMPLE)).collect()]  # bounded
    sample = np.array(first, np.int64).reshape(-1, dims)
    centroids, pivots = sample[:k].copy(), choose_pivots(sample, PIVOTS)
    others = [c for c in vectors.columns if c != embedding]
    # One table: everything a round needs, read by column.
    flat = kept.select(F.struct(F.lit(0).alias("z"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("others"),
                       F.col(x).cast("array<int>").alias("x"))
    cached_shape = T.StructType([*flat.schema.fields, T.StructField("near", T.ArrayType(T.DoubleType()))])
    cached = materialize(flat.mapInArrow(_with_pivots(pivots, dims, 1), cached_shape), "pivot-distances")
    for _ in range(rounds if len(centroids) else 0):
        step, schema = _round(centroids, pivots)
        sums = cached.select("x", "near").mapInArrow(step, schema).groupBy("cluster").agg(
            F.sum("n").alias("n"), *[F.sum(f"s{d}").alias(f"s{d}") for d in range(dims)])
        after = centroids.copy()
        for r in sums.collect():  # at most k rows
            after[r["cluster"]] = np.array([r[f"s{d}"] for d in range(dims)], np.int64) // r["n"]
        if (after == centroids).all():
            break  # further rounds change nothing
        centroids = after
    found_shape = T.StructType([flat.schema["others"], T.StructField("cluster", T.IntegerType()),
                                T.StructField("distance", T.LongType()), T.StructField("checked", T.IntegerType())])
    found = materialize(cached.select("x", "near", "others").mapInArrow(_last(centroids, pivots), found_shape), "clusters")
    final = vectors.sparkSession.createDataFrame(
        [(j, c, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())],
        "cluster int, centroid array<long>, centroid_sha256 string")
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    per_cluster = final.join(inertia, "cluster").withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0))))
    out = found.join(F.broadcast(per_cluster), "cluster")  # k rows
    return out.select(*[F.col("others").getField(f"c{i}").alias(c) for i, c in enumerate(others)],
                      F.col("cluster").alias("cc_cluster"), F.col("distance").alias("cc_distance"),
                      F.col("cluster_inertia").alias("cc_cluster_inertia"), F.col("inertia").alias("cc_inertia"),
                      F.col("centroid").alias("cc_centroid"), F.col("centroid_sha256").alias("cc_centroid_sha256"),
                      F.col("checked").alias("cc_checked"))
