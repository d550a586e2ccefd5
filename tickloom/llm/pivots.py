"""Exact integer centroid clustering with a LAESA table: distances to fixed pivots bound distances to moving centroids.

The distances of every vector to a few fixed pivots are computed once and stored beside the vector.  In each round the
driver knows the distance of each centroid to each pivot; the triangle inequality then gives, for every vector, a lower
bound to every centroid.  Only centroids whose bound does not exceed the best distance so far get an exact distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: Integers are below this in size, so that a squared distance of 64 components fits 63 bits.
LIMIT = 2**27


def integer_vectors(df: DataFrame, vector: str = "embedding", width: int = 64, scale: int = 1024) -> DataFrame:
    """The rows whose vector has ``width`` finite components, with ``v``: floor(scale * x) of each component."""
    x = F.col(vector)
    ok = (F.size(x) == width) & F.forall(x, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < float("inf")) & ~F.isnan(e.cast("double")))
    whole = F.transform(x, lambda e: F.floor(e.cast("double") * scale))
    large = F.exists("v", lambda e: F.abs(e) >= LIMIT)
    return df.where(F.coalesce(ok, F.lit(False))).withColumn("v", whole).withColumn(
        "v", F.when(large, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(F.col("v").cast("array<int>"))
    )


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances row by row."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def spread_out(candidates: np.ndarray, n: int) -> np.ndarray:
    """Up to n different rows, each the one with the largest sum of distances to those before it."""
    if not len(candidates):
        return candidates
    chosen, total = [0], np.zeros(len(candidates))
    while len(chosen) < n:
        total += np.sqrt(squared(candidates, candidates[chosen[-1]]).astype(float))
        total[chosen] = -1
        best = int(total.argmax())
        if total[best] <= 0:
            break
        chosen.append(best)
    return candidates[chosen]


def nearest(vectors: np.ndarray, far: np.ndarray, centroids: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of each vector, ties to the smaller number, and how many exact distances that took.

    ``far`` holds vector-pivot distances, ``reach`` centroid-pivot distances.
    """
    lower = np.zeros((len(vectors), len(centroids)))
    for p in range(far.shape[1]):
        np.maximum(lower, np.abs(far[:, p : p + 1] - reach[:, p]), out=lower)
    cluster = lower.argmin(1)
    best = squared(vectors, centroids[cluster])
    first, used = cluster.copy(), len(vectors)
    for c, centroid in enumerate(centroids):
        # the slack covers the rounding of roots and differences: a centroid that could tie is never left out
        open_ = np.flatnonzero((first != c) & (lower[:, c] <= np.sqrt(best.astype(float)) * (1 + 1e-9) + 1e-3))
        used += len(open_)
        d = squared(vectors[open_], centroid)
        wins = (d < best[open_]) | ((d == best[open_]) & (c < cluster[open_]))
        best[open_[wins]], cluster[open_[wins]] = d[wins], c
    return cluster, best, used


def cluster(
    df: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding", width: int = 64, k: int = 8, rounds: int = 10,
    salt: str = "3", scale: int = 1024, pivots: int = 16, candidates: int = 512,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    Starts: the k vectors with the smallest sha256 of ``salt:id``, repeated ids by their components; a NULL id comes
    last.  Every row is a vector of its own, also where ids or vectors repeat.  Vectors that are NULL, of another width or with
    a NULL or non-finite component are left out; fewer than k vectors give fewer centroids, none gives no rows.  Integers of 2^27 and
    more are refused, as their distances would not be exact.  Other columns are not read.

    ``pivots`` are spread over the ``candidates`` vectors with the smallest hashes (a bounded sample that decides only how much
    is pruned, never a result).  A round moves k * (width + 1) sums per task.
    """
    order = [F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).asc_nulls_last(), F.col("v")]
    kept = integer_vectors(df.select(F.col(id_column).alias("id"), F.col(vector).alias("x")), "x", width, scale).select("id", "v")
    starts = [r["v"] for r in kept.orderBy(*order).limit(max(candidates, k)).collect()]
    sample = np.array(starts, np.int64).reshape(-1, width)
    centroids, fixed = sample[:k], spread_out(sample, pivots)
    n = len(fixed)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in filter(len, batches):
            v = _matrix(b.column("v"), width, np.int64)
            far = np.sqrt(np.stack([squared(v, p) for p in fixed], 1).astype(float))
            offsets = pa.array(np.arange(len(v) + 1, dtype=np.int32) * n)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))], ["id", "v", "far"])

    types = dict(kept.dtypes)
    rows = stored(kept.mapInArrow(table, f"id {types['id']}, v array<int>, far array<double>"), "pivot-table")

    # the functions below run on executors only where there are rows, and then there are centroids and pivots
    def searched(b: pa.RecordBatch, at: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = _matrix(b.column("v"), width, np.int64)
        return v, *nearest(v, _matrix(b.column("far"), n, float), at, reach)[:2]

    def reaches(at: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([squared(at, p) for p in fixed], 1).astype(float)) if n else np.zeros((len(at), 0))

    for _ in range(rounds if n else 0):
        at, reach = centroids, reaches(centroids)

        def sums(batches: Iterator[pa.RecordBatch], at=at, reach=reach) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((len(at), width), np.int64), np.zeros((len(at), 1), np.int64)
            for b in filter(len, batches):
                v, c, _ = searched(b, at, reach)
                by = np.argsort(c, kind="stable")
                found, begin = np.unique(c[by], return_index=True)
                total[found] += np.add.reduceat(v[by], begin)
                count[:, 0] += np.bincount(c, minlength=len(at))
            both = np.hstack([total, count])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(at)), width + 1)), pa.array(np.tile(np.arange(width + 1), len(at))), pa.array(both.ravel())], ["c", "place", "part"]
            )

        parts = rows.select("v", "far").mapInArrow(sums, "c long, place long, part long")
        whole = {(r["c"], r["place"]): int(r["total"]) for r in parts.groupBy("c", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()}
        centroids = np.array([
            [whole[c, j] // whole[c, width] for j in range(width)] if whole[c, width] else at[c].tolist() for c in range(len(at))
        ], np.int64)

    at, reach = centroids, reaches(centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in filter(len, batches):
            _, c, d = searched(b, at, reach)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(c.astype(np.int32)), pa.array(d)], ["id", "cluster", "distance"])

    found = stored(rows.mapInArrow(last, f"id {types['id']}, cluster int, distance long"), "clusters")
    per = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in at]
    # k rows; a map beside each vector's cluster needs no join
    told = df.sparkSession.createDataFrame(
        [(c, s, sum(per.values()), names[c]) for c, s in sorted(per.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(told), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
