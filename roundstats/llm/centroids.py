"""Centroid clustering by a bisector tournament (operator 13).

Vectors are made of integers, ``floor(scale * x)``, so that every sum, distance
and comparison is exact and no result depends on the order of additions. For
two centroids a < b (by number) a vector x is nearer to a, or as near, exactly
when ``2 (c_b - c_a) . x <= |c_b|^2 - |c_a|^2``: the sign of one linear
function, whose integer normal and threshold are computed once a round for every
pair. A tournament of k - 1 such tests leaves the nearest centroid: the winner
so far meets the next number, and on zero the smaller number, the winner so
far, stays. The distance to the final winner is computed exactly.

The integer vectors are written to the shared folder once. A round is one Arrow
pass over them that yields a row of sums per centroid and task, a partial
aggregate by component, and k times the dimension numbers on the driver (512 at
the defaults, whatever the input): the new centroids. Nothing else is collected
or broadcast, so a cluster of a third of all vectors is k rows a task.

Edge cases: vectors that are null, of another length, or with null or
non-finite components are left out. Of fewer vectors than k every one is a
start. Equal ids: the order of starts goes on by the components. Repeated rows
count and come back as often as given; a null id is hashed as the empty string and
kept. An empty table gives an empty result. A component beyond 2^27 after
scaling (131,072 at scale 1,024) is an error: squared distances would leave the
64 bits. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundstats.llm.common import Stage

DIM = 64
SCALE = 1024
K = 8
ROUNDS = 10
LARGEST = 1 << 27
ROWS = 1 << 11        # vectors a kernel works on at a time


# ------------------------------------------------------------- the kernels --

def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals (k, k, dim) and thresholds (k, k): x is nearer to a than to b,
    or a < b and as near, when ``normals[a, b] . x <= thresholds[a, b]``."""
    norms = (centroids * centroids).sum(axis=1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), norms[None, :] - norms[:, None]


def tournament(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of every row of ``x``."""
    best = np.zeros(len(x), np.int64)
    for j in range(1, len(thresholds)):
        beaten = np.einsum("ij,ij->i", normals[best, j], x) > thresholds[best, j]
        best[beaten] = j
    return best


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim).astype(np.int64, copy=False)


def _assign_kernel(centroids: np.ndarray, dim: int):
    def run(batches):
        normals, thresholds = bisectors(centroids)
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                x = _vectors(part.column(1), dim)
                best = tournament(x, normals, thresholds)
                gap = x - centroids[best]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(best, pa.int32()), pa.array(np.einsum("ij,ij->i", gap, gap), pa.int64())],
                    names=["vec_id", "cluster", "distance"])
    return run


def _sums_kernel(centroids: np.ndarray, dim: int):
    def run(batches):
        k = len(centroids)
        normals, thresholds = bisectors(centroids)
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                x = _vectors(b.column(0).slice(i, ROWS), dim)
                best = tournament(x, normals, thresholds)
                for c in np.unique(best):
                    sums[c] += x[best == c].sum(axis=0)
                counts += np.bincount(best, minlength=k)
        for c in np.flatnonzero(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), pa.array([counts[c]], pa.int64()), pa.array([sums[c]], pa.list_(pa.int64()))],
                names=["cluster", "n", "sums"])
    return run


# ------------------------------------------------------------- the rounds --

def integer_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` (``array<int>``): the whole vectors, scaled and floored."""
    v = F.col("embedding").cast("array<double>")
    ok = F.coalesce((F.size(v) == dim) & F.forall(v, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))), F.lit(False))
    whole = F.transform(v, lambda c: F.floor(c * F.lit(scale)))
    fits = F.forall(whole, lambda c: F.abs(c) <= LARGEST)
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST / scale}")))
    return vectors.where(ok).select("vec_id", checked.cast("array<int>").alias("x"))


def _starts(rows: DataFrame, k: int) -> np.ndarray:
    name = F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.select(F.sha2(name, 256).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r.x for r in first], np.int64)


def _step(rows: DataFrame, centroids: np.ndarray, dim: int) -> np.ndarray:
    """The centroids after one round: floors of the exact means."""
    parts = rows.select("x").mapInArrow(_sums_kernel(centroids, dim), "cluster int, n long, sums array<long>")
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "s")).groupBy("cluster", "pos") \
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    new = centroids.copy()
    for r in totals.collect():
        new[r.cluster, r.pos] = r.s // r.n
    return new


def fit(rows: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM) -> np.ndarray:
    """Final centroids (k, dim) of integer vectors ``vec_id, x`` (fewer than k
    only if there are fewer vectors)."""
    centroids = _starts(rows, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _step(rows, centroids, dim)
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` (squared) for integer vectors ``vec_id, x``."""
    schema = T.StructType([rows.schema["vec_id"]]).add("cluster", T.IntegerType()).add("distance", "long")
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_assign_kernel(centroids, centroids.shape[1]), schema)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` (its
    integer components) for every whole vector of ``vectors`` (``vec_id, embedding``)."""
    spark = vectors.sparkSession
    stage = Stage(spark, "centroids")
    rows = stage.write(integer_vectors(vectors, dim, scale))
    centroids = fit(rows, k, rounds, dim)
    out = stage.write(assign(rows, centroids))
    # k rows: bounded by the parameter, whatever the input.
    sums = {r.cluster: r.s for r in out.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    table = spark.createDataFrame(
        [(i, sums.get(i, 0), sum(sums.values()), c.tolist()) for i, c in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return out.join(F.broadcast(table), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
