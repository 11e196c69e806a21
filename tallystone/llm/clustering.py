"""K-means over integer vectors, with candidates cut by Ptolemy's inequality over fixed pivot pairs.

Each vector keeps its distances to a few pivots, measured once. For a vector x, a centroid c and pivots p and q, Ptolemy's
inequality gives ``d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)``; the largest such value over all pivot pairs
bounds the distance from below without reading the vector. The centroid of the least bound is measured exactly; of the others, only
those whose bound, rounded down, does not exceed that distance. Distances are whole numbers, so ties and sums are exact.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import materialize, pick

#: Pivots: the kept vectors that come after the first centroids in the order of their hashes.
PIVOTS = 5
#: Relative slack of a bound, far above the rounding of its few operations on doubles.
SLACK = 1e-12
#: Size of a scaled component from which a squared distance may not fit in a long.
TOO_LARGE = 1 << 27


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _binary(rows: np.ndarray, kind: str) -> pa.Array:
    return pa.array([r.tobytes() for r in rows.astype(kind)], pa.binary())


def _exact(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to a vector, or to a row each."""
    gap = v - c
    return np.einsum("ij,ij->i", gap, gap)


def whole_vectors(rows: DataFrame, components: int, scale: int) -> DataFrame:
    """``vec_id, v`` of vectors with exactly ``components`` finite components: ``floor(scale * x)`` as packed 32-bit integers."""

    def run(batches):
        for batch in batches:
            at = batch.column("v")
            sizes = at.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            fits = np.flatnonzero(sizes == components)
            flat = at.take(pa.array(fits)).flatten()
            absent = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, components).any(axis=1)
            x = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, components)
            good = ~absent & np.isfinite(x).all(axis=1)
            whole = np.floor(x[good] * scale)
            if (np.abs(whole) >= TOO_LARGE).any():
                raise ValueError(f"a component of {TOO_LARGE // scale} or more: squared distances would not fit in a long")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(fits[good])), _binary(whole, "<i4")], names=["vec_id", "v"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", F.col("v").cast("array<double>").alias("v")).mapInArrow(run, f"vec_id {kind}, v binary")


def to_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vec_id, v, d``: with the packed distances to all pivots."""
    width = pivots.shape[1]

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), "<i4", width).astype(np.int64)
            d = np.sqrt(np.stack([_exact(v, p) for p in pivots], axis=1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, _binary(d, "<f8")], names=["vec_id", "v", "d"])

    return vectors.mapInArrow(run, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, v binary, d binary")


class Bounds:
    """Lower bounds of the distances to some centroids, from distances to the pivots."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        self.of_centroids = np.sqrt(np.stack([_exact(centroids, p) for p in pivots], axis=1).astype(np.float64))
        between = np.sqrt(np.stack([_exact(pivots, p) for p in pivots]).astype(np.float64))
        self.pairs = [(p, q, between[p, q]) for p, q in combinations(range(len(pivots)), 2) if between[p, q] > 0]

    def __call__(self, d: np.ndarray) -> np.ndarray:
        """Rows by centroids; never above the true distance."""
        least = np.zeros((len(d), len(self.of_centroids)))
        for p, q, apart in self.pairs:
            a, b = np.outer(d[:, p], self.of_centroids[:, q]), np.outer(d[:, q], self.of_centroids[:, p])
            np.maximum(least, (np.abs(a - b) - SLACK * (a + b)) / apart, out=least)
        return least * (1 - SLACK)


def nearest(v: np.ndarray, d: np.ndarray, centroids: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, ...]:
    """Number of the nearest centroid (the smallest of ties), squared distance, and how many were measured, by row."""
    least = bounds(d)
    cluster = np.argmin(least, axis=1)
    best = _exact(v, centroids[cluster])
    first = cluster.copy()
    measured = np.ones(len(v), np.int32)
    for c in range(len(centroids)):
        rows = np.flatnonzero((first != c) & (least[:, c] ** 2 * (1 - SLACK) <= best))
        found = _exact(v[rows], centroids[c])
        measured[rows] += 1
        nearer = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
        rows, found = rows[nearer], found[nearer]
        best[rows], cluster[rows] = found, c
    return cluster, best, measured


def _assigner(pivots: np.ndarray, centroids: np.ndarray):
    bounds, width = Bounds(pivots, centroids), centroids.shape[1]

    def assign(batch: pa.RecordBatch):
        v = _matrix(batch.column("v"), "<i4", width).astype(np.int64)
        return v, *nearest(v, _matrix(batch.column("d"), "<f8", len(pivots)), centroids, bounds)

    return assign


def cluster_sums(vectors: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and component sums of each cluster; a task sends one row a cluster."""
    assign, (k, width) = _assigner(pivots, centroids), centroids.shape

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            v, cluster, _, _ = assign(batch)
            n += np.bincount(cluster, minlength=k)
            for c in range(k):
                total[c] += v[cluster == c].sum(axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([[int(n[c]), *total[c].tolist()] for c in some], pa.list_(pa.int64()))], names=["cluster", "sums"])

    parts = vectors.mapInArrow(run, "cluster int, sums array<bigint>").select("cluster", F.posexplode("sums").alias("place", "x"))
    whole = parts.groupBy("cluster", "place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()  # k * (width + 1) rows
    sums = np.zeros((k, width + 1), object)
    for r in whole:
        sums[r["cluster"], r["place"]] = int(r["x"])
    return sums[:, 0], sums[:, 1:]


def cluster_vectors(
    rows: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3, components: int = 64, scale: int = 1024,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """K-means (Lloyd's rounds) over ``floor(scale * x)`` with exact whole-number arithmetic.

    The first centroids are the vectors with the smallest SHA-256 of ``seed:key``, in that order (of equal keys by components).
    Each round assigns every vector to its nearest centroid, the smallest number of ties, and moves centroids with vectors to the
    floor of their mean; others stay. Vectors are assigned once more at the end. Besides the pivots' and centroids'
    numbers, which do not grow, nothing passes the driver.

    Returns one row per kept vector: ``vec_id, cluster, distance`` (squared), ``measured`` (centroids not cut by their bound),
    ``cluster_inertia, inertia, centroid_sha256``. Vectors that are NULL, of another length, or with a NULL or non-finite
    component are left out; components whose distances would not fit in a long are refused; a NULL key counts as the empty text; repeated rows count
    each; with fewer vectors than ``clusters`` there are as many clusters as vectors; an empty table gives none; other columns are not read.
    """
    spark = rows.sparkSession
    kept = materialize(whole_vectors(pick(rows, **{key: "vec_id", vector: "v"}), components, scale), "whole-vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = kept.select(hashed.alias("hashed"), "v").orderBy("hashed", "v").limit(clusters + PIVOTS).collect()
    first = np.array([np.frombuffer(r["v"], "<i4") for r in sorted(first, key=lambda r: (r["hashed"], bytes(r["v"])))], np.int64).reshape(-1, components)
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long, measured int"
    if not len(first):
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids, pivots = first[:clusters], first[-PIVOTS:]
    vectors = materialize(to_pivots(kept, pivots), "pivot-distances")
    for _ in range(rounds):
        n, sums = cluster_sums(vectors, pivots, centroids)
        centroids = np.array([[s // m for s in row] if m else old for m, row, old in zip(n, sums, centroids.tolist(), strict=True)], np.int64)
    assign = _assigner(pivots, centroids)

    def run(batches):
        for batch in batches:
            _, cluster, distance, measured = assign(batch)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(measured)], names=["vec_id", "cluster", "distance", "measured"])

    assigned = materialize(vectors.mapInArrow(run, schema), "clusters")
    of = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # one row a cluster
    inertia = sum(r["cluster_inertia"] for r in of)
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    told = [(r["cluster"], r["cluster_inertia"], inertia, digest(r["cluster"])) for r in of]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "measured", "cluster_inertia", "inertia", "centroid_sha256")
