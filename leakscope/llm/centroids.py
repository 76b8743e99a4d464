"""Exact centroid clustering (Lloyd's rounds on integers) with Ptolemaic pivots.

Vectors are cut to integers once, and their exact distances to a few fixed
pivots are kept beside them. In Euclidean space Ptolemy's inequality holds for
any four points: for pivots p, q, a vector v and a centroid c,

    d(v, c) >= |d(v, p) d(c, q) - d(v, q) d(c, p)| / d(p, q).

In a round the centroids' distances to the pivots are computed on the driver
(centroids x pivots), every task bounds all its vectors' distances to all
centroids from the cached pivot distances, and only a centroid whose bound does
not exceed the best exact distance so far is compared component by component.
Bounds are doubles; each is lowered by ``SHRINK`` of the products it subtracts
before it is used, far more than their rounding errors, so no centroid that is
nearest or tied is skipped. Distances, sums and floors are integers, exact.

Every round is one pass over the written vectors; what comes back is one sum
per (task, centroid, component), added up by Spark. Only the centroids, a
number that is a parameter, pass through the driver.

Defined cases: vectors that are null, of another length, or with a null or
non-finite component are left out; equal hashes (repeated vec_ids) are taken in
the order of their vectors; with fewer rows than centroids every row starts one;
repeated rows count as often as they occur; a null vec_id hashes as none and
comes last; a component beyond 2^17 in size stops the job, since squared
distances would leave the long range; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import written

SIZE, SCALE, LARGEST = 64, 1024, 1 << 27
CLUSTERS, ROUNDS, PIVOTS = 8, 10, 6
CANDIDATES = 64    # vectors that pivots are chosen from
SHRINK = 1e-9


def kept(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, hash, v): integer vectors."""
    x = F.col("embedding")
    usable = F.coalesce((F.size(x) == size) & F.forall(
        x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y.cast("double")) < float("inf"))), F.lit(False))
    n = F.transform("embedding", lambda y: F.when(F.abs(y.cast("double")) * scale < float(LARGEST),
                                                  F.floor(y.cast("double") * scale))
                    .otherwise(F.raise_error(F.lit("a vector component is too large for exact distances"))))
    key = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    return vectors.where(usable).select("vec_id", key.alias("hash"), n.alias("v"))


def chosen_pivots(candidates: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each is the one farthest from those before."""
    if not len(candidates):
        return candidates
    picked = [0]
    near = _squared(candidates, candidates[0])
    while len(picked) < min(count, len(candidates)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, _squared(candidates, candidates[picked[-1]]))
    return candidates[picked]


def _squared(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    d = rows - one
    return np.einsum("ij,ij->i", d, d)


def bounds(to_pivots: np.ndarray, centroid_to_pivots: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Vectors x centroids: a number that squared distances do not fall below."""
    low = np.zeros((len(to_pivots), len(centroid_to_pivots)))
    for p in range(len(between)):
        for q in range(p):
            if between[p, q] > 0:
                a = np.outer(to_pivots[:, p], centroid_to_pivots[:, q])
                b = np.outer(to_pivots[:, q], centroid_to_pivots[:, p])
                np.maximum(low, (np.abs(a - b) - SHRINK * (a + b)) / between[p, q], out=low)
    return low * low * (1 - SHRINK)


def assign(v: np.ndarray, low: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, exact comparisons made): nearest centroid,
    the smaller number on ties. Each vector begins with its smallest bound."""
    n, k = low.shape
    first = low.argmin(1)
    d = v - centroids[first]
    cluster, best = first.copy(), np.einsum("ij,ij->i", d, d)
    made = n
    for c in range(k):
        rows = np.flatnonzero((low[:, c] <= best) & (first != c))
        if len(rows):
            made += len(rows)
            x = _squared(v[rows], centroids[c])
            better = (x < best[rows]) | ((x == best[rows]) & (c < cluster[rows]))
            best[rows[better]], cluster[rows[better]] = x[better], c
    return cluster, best, made


def _matrix(column, kind=np.int64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_squared(v, p) for p in pivots], 1).astype(float)) if len(pivots) else np.zeros((len(v), 0))


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS,
              size: int = SIZE, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) of every kept row, centroids)."""
    rows = kept(vectors, size, scale)
    head = rows.orderBy(F.asc_nulls_last("hash"), "v").limit(max(clusters, CANDIDATES)).collect()  # a bounded number
    start = np.array([r["v"] for r in head], np.int64).reshape(len(head), size)
    centroids, fixed = start[:clusters], chosen_pivots(start, pivots)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def measure(batches):
        for b in batches:
            d = _distances(_matrix(b.column("v")).reshape(b.num_rows, size), fixed)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(list(d), pa.list_(pa.float64()))],
                                             ["vec_id", "v", "to_pivots"])
    cached = written(rows.select("vec_id", "v").mapInArrow(measure, f"vec_id {kind}, v array<long>, to_pivots array<double>"),
                     "vectors")
    between = _distances(fixed, fixed)

    def nearest(b, centroids):
        v = _matrix(b.column("v")).reshape(b.num_rows, size)
        low = bounds(_matrix(b.column("to_pivots"), float).reshape(b.num_rows, len(fixed)), _distances(centroids, fixed), between)
        return v, *assign(v, low, centroids)

    for _ in range(rounds if len(centroids) else 0):
        def sums(batches, centroids=centroids):
            total, count = np.zeros((len(centroids), size), np.int64), np.zeros(len(centroids), np.int64)
            for b in batches:
                v, cluster, _, _ = nearest(b, centroids)
                count += np.bincount(cluster, minlength=len(centroids))
                for c in range(len(centroids)):
                    total[c] += v[cluster == c].sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(centroids)), pa.int32()), pa.array(count),
                                              pa.array(list(total), pa.list_(pa.int64()))], ["c", "n", "s"])
        each = cached.select("v", "to_pivots").mapInArrow(sums, "c int, n long, s array<long>")
        added = (each.select("c", "n", F.posexplode("s").alias("i", "x")).groupBy("c", "i")
                 .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect())
        centroids = centroids.copy()
        for r in added:
            if r["n"]:
                centroids[r["c"], r["i"]] = int(r["x"]) // r["n"]

    def last(batches):
        for b in batches:
            _, cluster, best, _ = nearest(b, centroids)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(best)],
                                             ["vec_id", "cluster", "distance"])
    return cached.mapInArrow(last, f"vec_id {kind}, cluster int, distance long"), centroids.tolist()


def report(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS) -> DataFrame:
    """The columns of op12."""
    found, centroids = clustered(vectors, clusters, rounds, pivots)
    found = written(found, "clusters")
    spark = vectors.sparkSession
    names = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    named = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    per = (found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("cluster_inertia"))
           .join(named, "cluster").withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(1)))))  # over one row a centroid
    return found.join(F.broadcast(per), "cluster").select(  # one row a centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
