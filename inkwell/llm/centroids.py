"""Centroid clustering: Lloyd rounds on integer vectors with Ptolemaic pivots.

Every vector keeps its distances to a few fixed pivots (the first initial
centroids).  For two pivots p, q, Ptolemy's inequality bounds the distance of
a vector x to a centroid c from below without looking at x:

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

The pivot distances are computed once and stored with the vectors; a round
computes only the k x pivots distances of the centroids.  Bounds are lowered by
more than their rounding error, so a centroid is left out only if it is
certainly farther than the best one so far; the survivors are compared by
exact integer arithmetic, ties by the smaller number.

Spark: one stored table of (id, integers, pivot distances); a round is one
pass over it that returns k partial sums per task, added per cluster and
replaced on the driver (k rows).  Sums are exact integers of any size.

Defined cases: vectors that are null, of another length, or hold a null or a
non-finite component are left out.  Equal rows and repeated ids are vectors of
their own.  A null id counts as the text "null" in the seeding hash; equal
hashes go by the components.  Fewer than k vectors give as many centroids; an
empty table gives no rows.  Distances and sums beyond a long are given as
2^63 - 1 (they are compared exactly).  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import stored

# k, rounds, dimension, grid of the integers, seed of the first centroids.
K, ROUNDS, DIM, SCALE, SEED = 8, 10, 64, 1024, 3
PIVOTS = 8
LONG_MAX = (1 << 63) - 1
# Components below this magnitude go by 64-bit arithmetic (DIM * (2 * x)^2 fits
# up to 256 components); larger ones by Python's integers.
NARROW = 1 << 26
# Relative slack of the bounds: over ten times the error of the six roundings
# that lead to one.
SLACK = 64 * 2.0 ** -53


def integers(values: list[float], scale: int = SCALE) -> list[int]:
    """floor(scale * x) exactly, x as a double (scale is a power of two)."""
    return [int(np.floor(scale * x)) if abs(x) < 1e300 else int(x) * scale for x in values]


def matrix(rows: list[list[int]], dim: int) -> np.ndarray:
    """int64 if all components are narrow, Python integers otherwise."""
    wide = any(abs(x) >= NARROW for r in rows for x in r)
    return np.array(rows, dtype=object if wide else np.int64).reshape(len(rows), dim)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to one vector c."""
    if x.dtype == object or c.dtype == object:
        d = x.astype(object) - c.astype(object)
        return (d * d).sum(axis=1) if len(d) else np.zeros(0, dtype=object)
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Rounded distances of the rows of x to the rows of points."""
    return np.sqrt(np.array([squared(x, p) for p in points], dtype=np.float64).reshape(len(points), len(x))).T


class Pivots:
    """Fixed pivots and the pairs that give bounds: each with the farthest other."""

    def __init__(self, points: np.ndarray):
        self.points, self.gaps = points, distances(points, points)
        far = {tuple(sorted((p, int(np.argmax(self.gaps[p]))))) for p in range(len(points))}
        self.pairs = sorted((p, q) for p, q in far if self.gaps[p, q] > 0)

    def bounds(self, near: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances (rows x centroids); ``near`` are
        the rows' cached pivot distances."""
        to = distances(centroids, self.points)
        least = np.zeros((len(near), len(centroids)))
        for p, q in self.pairs:
            a, b = near[:, p, None] * to[None, :, q], near[:, q, None] * to[None, :, p]
            np.maximum(least, (np.abs(a - b) - SLACK * (a + b)) / self.gaps[p, q], out=least)
        return least * least * (1 - SLACK)


def assign(x: np.ndarray, near: np.ndarray, pivots: Pivots, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, exact squared distance) of each row, and the number
    of exact distances that were needed."""
    least = pivots.bounds(near, centroids)
    first = least.argmin(axis=1)
    best = np.zeros(len(x), dtype=object if object in (x.dtype, centroids.dtype) else np.int64)
    for c in np.unique(first):
        best[first == c] = squared(x[first == c], centroids[c])
    cluster, checked = first.astype(np.int64), len(x)
    for c in np.argsort(least.sum(axis=0), kind="stable"):
        rows = np.flatnonzero((first != c) & (least[:, c] <= best.astype(np.float64) * (1 + SLACK)))
        d = squared(x[rows], centroids[c])
        nearer = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
        best[rows[nearer]], cluster[rows[nearer]] = d[nearer], c
        checked += len(rows)
    return cluster, best, checked


# --- stored rows --------------------------------------------------------------
_ROWS = "vec_id bigint, narrow boolean, ints binary, near binary"


def _encode(row: list[int]) -> tuple[bool, bytes]:
    if all(abs(x) < NARROW for x in row):
        return True, np.array(row, dtype="<i4").tobytes()
    return False, ",".join(map(str, row)).encode()


def _decode(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Integers and pivot distances of a batch of stored rows."""
    raw = batch.column(2).to_pylist()
    if all(batch.column(1).to_pylist()):
        x = np.frombuffer(b"".join(raw), dtype="<i4").astype(np.int64).reshape(len(raw), dim)
    else:
        x = matrix([np.frombuffer(r, dtype="<i4").tolist() if n else [int(v) for v in r.split(b",")]
                    for n, r in zip(batch.column(1).to_pylist(), raw)], dim)
    near = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype="<f8").reshape(len(raw), -1)
    return x, near


def kept_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, x array<double>) of the vectors with ``dim`` finite components."""
    finite = F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
            .filter(F.col("x").isNotNull() & (F.size("x") == dim)).filter(finite))


def first_centroids(kept: DataFrame, k: int = K, scale: int = SCALE, seed: int = SEED) -> list[list[int]]:
    """The k vectors with the smallest seeding hash (a top-k, k rows)."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return [integers(r["x"], scale) for r in kept.orderBy(mark, "x").limit(k).collect()]


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
            seed: int = SEED, n_pivots: int = PIVOTS) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) per kept vector, the final centroids)."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dim)
    centroids = first_centroids(kept, k, scale, seed)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not centroids:
        return spark.createDataFrame([], schema), []
    pivots = Pivots(matrix(centroids[:n_pivots], dim))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [integers(x, scale) for x in batch.column(1).to_pylist()]
            near = distances(matrix(rows, dim), pivots.points).astype("<f8")
            coded = [_encode(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in coded], pa.bool_()), pa.array([b for _, b in coded], pa.binary()),
                 pa.array([n.tobytes() for n in near], pa.binary())], names=["vec_id", "narrow", "ints", "near"])

    rows = stored(kept.mapInArrow(prepare, _ROWS), "pivot-distances")
    for _ in range(rounds):
        for c, n, total in _sums(rows, pivots, matrix(centroids, dim)):
            centroids[c] = [s // n for s in total]

    final = matrix(centroids, dim)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c, d, _ = assign(*_decode(batch, dim), pivots, final)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(c.astype(np.int32)), pa.array([min(int(x), LONG_MAX) for x in d], pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    return stored(rows.mapInArrow(last, schema), "assigned"), centroids


def _sums(rows: DataFrame, pivots: Pivots, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """(cluster, vectors, componentwise sums) of the clusters that have any: a
    task gives one row per cluster, a cluster's rows are added in one group (as
    many as there were tasks)."""
    dim = centroids.shape[1]
    schema = "cluster int, n bigint, total array<string>"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = [0] * len(centroids), [np.zeros(dim, dtype=object) for _ in centroids]
        for batch in batches:
            if batch.num_rows:
                x, near = _decode(batch, dim)
                c, _, _ = assign(x, near, pivots, centroids)
                for i in np.unique(c):
                    n[i] += int((c == i).sum())
                    total[i] = total[i] + x[c == i].sum(axis=0).astype(object)
        has = [i for i in range(len(centroids)) if n[i]]
        yield _summed([(i, n[i], total[i]) for i in has])

    def add(group: pa.Table) -> pa.Table:
        total = [sum(map(int, column)) for column in zip(*group.column("total").to_pylist())]
        return pa.Table.from_batches([_summed([(group.column("cluster")[0].as_py(), sum(group.column("n").to_pylist()), total)])])

    found = rows.mapInArrow(part, schema).groupBy("cluster").applyInArrow(add, schema).collect()
    return [(r["cluster"], r["n"], [int(x) for x in r["total"]]) for r in found]


def _summed(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([[str(int(x)) for x in r[2]] for r in rows], pa.list_(pa.string()))], names=["cluster", "n", "total"])


def clustered(vectors: DataFrame, **how) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256 (the components as decimal integers joined by commas)."""
    found, centroids = cluster(vectors, **how)
    spark = vectors.sparkSession
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    whole = min(sum(sums.values()), LONG_MAX)
    about = [(c, min(s, LONG_MAX), whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
             for c, s in sorted(sums.items())]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
