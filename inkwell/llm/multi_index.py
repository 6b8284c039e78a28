"""Near-duplicate embeddings by an inverted multi-index.

Vectors are scaled to length one and cut into two halves; each half has a
codebook of its own (k-means on a bounded sample), and a pair of codewords is a
cell of the product grid.  Every distinct vector is indexed under its cell.

A query's cost of a codeword is the squared distance of its half to the plane
that parts that codeword's region from its own one (0 for its own).  A cell's
cost is the sum over the halves, and multi-sequence traversal visits cells by
growing cost until the target recall is met: the bound is the share
``target_recall`` of the costs that sampled vectors need to reach partners
drawn at exactly the threshold cosine in random directions, the hardest ones.
A pair is found if either side visits the other's cell, so recall is higher
than the target for one side; all that meet are verified by their cosine in
double precision.

Spark: equal vectors are one node with a number of copies.  A node's row goes
to each cell that it visits; the one in its own cell is the member that others
are compared with.  Cells with more than ``CHUNK`` members are split by a hash
of the node and visitors go to each chunk, so a task holds one chunk of members
and streams the visitors past it as matrix products.  No pairs are emitted: a
batch of visitors gives its link counts and the edges of a spanning forest, at
most one row per node.  A pair is counted where it is met first: the visitor's
count there, the member's only if the member does not visit the other cell.

Cost: a large group of *different* near copies is still compared all with all
(as counting links asks), spread over its chunks.

Defined cases: vectors that are null, zero, empty, or hold a null or non-finite
component, and null labels, link with nothing (n_links 0, their own component).
Vectors of different lengths never link.  Rows of equal vectors and label link
with one another; repeated ids are rows of their own and count as links.  A
component's id is its smallest vec_id that is not null; a null vec_id is kept
only if its component has no other.  Other columns are not looked at; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import stored
from inkwell.llm.simhash import components

THRESHOLD = 0.98
TARGET_RECALL = 0.99  # of partners at the threshold, for one side
# Sampled vectors that fit the codebooks, and of them those that fit the bound.
SAMPLE, PROBES = 16384, 4096
CELL = 512  # members per cell that the number of codewords aims at
MAX_CODEWORDS = 1024
CHUNK = 2048  # members that a task compares with at once
VISITORS = 1024  # visitors per matrix product
KMEANS_ROUNDS = 10


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 5e-324) if x.shape[1] else x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def k_means(x: np.ndarray, k: int, rounds: int = KMEANS_ROUNDS) -> np.ndarray:
    """Codewords of a bounded sample; starts from rows spread over it."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = ((centres ** 2).sum(axis=1)[None] - 2 * x @ centres.T).argmin(axis=1)
        for c in np.unique(near):
            centres[c] = x[near == c].mean(axis=0)
    return np.unique(centres, axis=0)


@dataclass
class Grid:
    """Two codebooks and the traversal bound."""

    books: tuple[np.ndarray, np.ndarray]
    bound: float = 0.0

    def halves(self, u: np.ndarray) -> list[np.ndarray]:
        cut = self.books[0].shape[1]
        return [u[:, :cut], u[:, cut:]]

    def costs(self, u: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(own codeword, cost of each codeword), per half."""
        out = []
        for x, book in zip(self.halves(u), self.books):
            d = (x ** 2).sum(axis=1)[:, None] + (book ** 2).sum(axis=1)[None] - 2 * x @ book.T
            own = d.argmin(axis=1)
            gaps = np.sqrt(((book[:, None] - book[None]) ** 2).sum(axis=2))
            cost = np.maximum(d - d[np.arange(len(x)), own][:, None], 0) / np.maximum(2 * gaps[own], 1e-12)
            out.append((own, cost ** 2))
        return out

    def cells(self, u: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(own cell, visited cells by growing cost, own one first) of each row.

        The traversal's prefix up to the bound, for all rows at once: per row
        and codeword of one half, the codewords of the other within what the
        bound leaves."""
        (a, ca), (b, cb) = self.costs(u)
        width = len(self.books[1])
        ca[np.arange(len(u)), a] = cb[np.arange(len(u)), b] = 0.0
        visited: list[np.ndarray] = []
        for i in range(len(u)):
            near = np.flatnonzero(ca[i] <= self.bound)
            total = ca[i, near][:, None] + cb[i][None]
            r, c = np.nonzero(total <= self.bound)
            cell = near[r] * width + c
            order = np.lexsort((cell, total[r, c], cell != a[i] * width + b[i]))
            visited.append(cell[order].astype(np.int32))
        return (a * width + b).astype(np.int32), visited

    def fit_bound(self, u: np.ndarray, threshold: float, target_recall: float, seed: int = 7) -> None:
        """The traversal bound that reaches ``target_recall`` of partners at
        the threshold, in random directions from the sampled vectors u."""
        if u.shape[1] < 2 or not len(u):
            self.bound = math.inf
            return
        noise = np.random.default_rng(seed).standard_normal(u.shape)
        noise -= (noise * u).sum(axis=1)[:, None] * u
        noise /= np.maximum(np.linalg.norm(noise, axis=1)[:, None], 1e-12)
        partners = threshold * u + math.sqrt(1 - threshold ** 2) * noise
        need = sum(cost[np.arange(len(u)), own] for (_, cost), (own, _) in
                   zip(self.costs(u), self.costs(partners)))
        self.bound = float(np.quantile(need, target_recall, method="higher"))


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All (cost, i, j) by growing first[i] + second[j]: the two cost lists are
    sorted, and a heap holds the border of the visited part of the grid."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen = [(float(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}
    while heap:
        cost, i, j = heapq.heappop(heap)
        yield cost, int(a[i]), int(b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (float(first[a[x]] + second[b[y]]), x, y))


def fit(sample: np.ndarray, codewords: int, threshold: float = THRESHOLD,
        target_recall: float = TARGET_RECALL) -> Grid:
    """Codebooks and bound from a bounded sample of unit vectors."""
    cut = sample.shape[1] // 2
    k = max(1, min(codewords, MAX_CODEWORDS, len(sample) // 8))
    grid = Grid((k_means(sample[:, :cut], k), k_means(sample[:, cut:], k)))
    grid.fit_bound(sample[:PROBES], threshold, target_recall)
    return grid


# --- linked pairs of one batch --------------------------------------------------
def forest(met: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest node that each row and column of a link matrix reaches."""
    a, b, most = rows.copy(), columns.copy(), np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(a, np.where(met, b[None], most).min(axis=1, initial=most))
        new_b = np.minimum(b, np.where(met, new_a[:, None], most).min(axis=0, initial=most))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b


_FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("least", pa.int64())])


class Members:
    """The members of one chunk of a cell."""

    def __init__(self, rows: list[dict], vectors: np.ndarray):
        self.nodes = np.array([r["node"] for r in rows], dtype=np.int64)
        self.copies = np.array([r["copies"] for r in rows], dtype=np.int64)
        self.vectors = vectors
        self.visit = np.concatenate([np.asarray(r["visits"], dtype=np.int64) for r in rows])
        self.owner = np.repeat(np.arange(len(rows)), [len(r["visits"]) for r in rows])

    def meet(self, rows: list[dict], vectors: np.ndarray, threshold: float) -> pa.RecordBatch | None:
        """Counts and forest edges of a batch of visitors."""
        nodes = np.array([r["node"] for r in rows], dtype=np.int64)
        copies = np.array([r["copies"] for r in rows], dtype=np.int64)
        met = (vectors @ self.vectors.T >= threshold) & (nodes[:, None] != self.nodes[None])
        if not met.any():
            return None
        # Does the member visit the visitor's own cell?  Then it counts there.
        homes, at = np.unique([r["home"] for r in rows], return_inverse=True)
        back = np.zeros((len(homes), len(self.nodes)), dtype=bool)
        place = np.searchsorted(homes, self.visit)
        known = np.flatnonzero((place < len(homes)) & (homes[np.minimum(place, len(homes) - 1)] == self.visit))
        back[place[known], self.owner[known]] = True
        mine = met @ self.copies
        theirs = copies @ (met & ~back[at])
        a, b = forest(met, nodes, self.nodes)
        p, m = np.flatnonzero(met.any(axis=1)), np.flatnonzero(met.any(axis=0))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([nodes[p], self.nodes[m]])), pa.array(np.concatenate([mine[p], theirs[m]])),
             pa.array(np.concatenate([a[p], b[m]]))], schema=_FOUND)


def _vectors(column: pa.Array, dim: int, dtype: str) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=dtype).astype(np.float64).reshape(len(column), dim)


# --- Spark ------------------------------------------------------------------------
def _linkable() -> Column:
    finite = F.forall("embedding", lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda v: v.cast("double") != 0), F.lit(False))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(label, embedding, dim, copies, least id, node): one row per distinct
    vector of a label, numbered in stored files."""
    found = rows.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    return stored(found.withColumn("dim", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()),
                  "distinct-vectors")


def links(vectors: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL,
          cell: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """(node, links, least) rows of distinct vectors: link counts, to be added
    by node, and the smallest node that each one reached in one task."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "node bigint, links bigint, least bigint")
    wide = "f4" if "array<float>" in dict(vectors.dtypes)["embedding"] else "f8"
    grids = {}
    sizes = vectors.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("dim").agg(F.max("n").alias("n"))
    for dim, n in sorted((r["dim"], r["n"]) for r in sizes.collect()):  # a row per length of vectors
        sample = (vectors.filter(F.col("dim") == dim).orderBy(F.xxhash64("node")).limit(SAMPLE)
                  .select("embedding").toArrow().column(0).combine_chunks())
        x = unit(np.asarray(sample.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim))
        grids[dim] = fit(x, math.ceil(math.sqrt(n / cell)), threshold, target_recall)
    if not grids:
        return empty

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                values = part.column(4).flatten().to_numpy(zero_copy_only=False)
                own, visits = grids[dim].cells(unit(values.astype(np.float64).reshape(-1, dim)))
                size = values.astype(wide).tobytes()
                step = int(dim) * np.dtype(wide).itemsize
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), part.column(3), pa.array(own), pa.array(visits, pa.list_(pa.int32())),
                     pa.array([size[i * step:(i + 1) * step] for i in range(part.num_rows)], pa.binary())],
                    names=["label", "dim", "node", "copies", "home", "visits", "v"])

    kind = vectors.schema["label"].dataType.simpleString()
    placed = stored(vectors.select("label", "dim", "node", "copies", "embedding").mapInArrow(
        place, f"label {kind}, dim int, node bigint, copies bigint, home int, visits array<int>, v binary"), "cells")
    hot = (placed.groupBy("label", "dim", F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > chunk).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")).drop("n"))
    rows = (placed.withColumn("cell", F.explode("visits")).join(hot, ["label", "dim", "cell"], "left")
            .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .withColumn("member", (F.col("cell") == F.col("home")) &
                        (F.col("chunk") == F.pmod(F.xxhash64("node"), F.col("chunks")))))
    key = ["label", "dim", "cell", "chunk"]
    # Visitors need no list of visits: only members are asked for theirs.
    rows = rows.select(*key, "member", "node", "copies", "home",
                       F.when(F.col("member"), F.col("visits")).alias("visits"), "v")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _meet(batches, wide, threshold):
            if found is not None:
                yield found

    dealt = rows.repartition(*key).sortWithinPartitions(*key, F.desc("member"), "node")
    return stored(dealt.mapInArrow(meet, "node bigint, links bigint, least bigint"), "links")


def _meet(batches: Iterator[pa.RecordBatch], dtype: str, threshold: float) -> Iterator[pa.RecordBatch | None]:
    """Sorted rows, members of each chunk first: the members are held, all
    rows (a member visits its own cell too) are compared with them."""
    key, held, vectors, members = None, [], [], None
    waiting: list[dict] = []
    waiting_v: list[np.ndarray] = []

    def flush():
        nonlocal waiting, waiting_v, members
        if not held or not waiting:
            waiting, waiting_v = [], []
            return None
        if members is None:
            members = Members(held, np.array(vectors))
        found = members.meet(waiting, np.array(waiting_v), threshold)
        waiting, waiting_v = [], []
        return found

    for batch in batches:
        rows = batch.select(["label", "dim", "cell", "chunk", "member", "node", "copies", "home", "visits"]).to_pylist()
        raw = batch.column(batch.schema.get_field_index("v")).to_pylist()
        for row, v in zip(rows, raw):
            now = (row["label"], row["dim"], row["cell"], row["chunk"])
            if now != key:
                yield flush()
                key, held, vectors, members = now, [], [], None
            u = unit(np.frombuffer(v, dtype=dtype).astype(np.float64)[None])[0]
            if row["member"]:
                held.append(row)
                vectors.append(u)
            elif not held:
                continue  # nothing is indexed in this cell
            waiting.append(row)
            waiting_v.append(u)
            # Members come first, so they are complete once a visitor arrives.
            if len(waiting) >= VISITORS and not row["member"]:
                yield flush()
    yield flush()


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD,
                    target_recall: float = TARGET_RECALL, cell: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept (vec_id = component_id)."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    distinct = distinct_vectors(rows.filter(_linkable()))
    found = links(distinct, threshold, target_recall, cell, chunk)
    counts = found.groupBy("node").agg(F.sum("links").alias("others"))
    edges = found.filter("least < node").select(F.col("node").alias("u"), F.col("least").alias("v")).distinct()
    roots = stored(components(edges), "vector-components")
    named = (roots.join(distinct.select("node", "least_id"), "node").groupBy("root")
             .agg(F.min("least_id").alias("component_id")))
    about = (distinct.join(counts, "node", "left").join(roots, "node", "left").join(named, "root", "left")
             .select("label", "embedding", F.xxhash64("embedding").alias("h"),
                     (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component_id", "least_id").alias("component_id")))
    linked = rows.filter(_linkable()).withColumn("h", F.xxhash64("embedding")).join(
        about, ["label", "h", "embedding"]).select("vec_id", "n_links", "component_id")
    single = rows.filter(~_linkable()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(single).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
