"""Centroids, manifest and multi-index against brute force."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.llm import centroids, manifest, multi_index
from inkwell.llm.queries import QUERIES
from llm_rows import awkward_rows
from llm_vectors import awkward_vectors, brute_clusters, brute_links

VECTORS = "vec_id bigint, embedding array<float>, label int"


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# --- centroids ----------------------------------------------------------------
def test_op11(spark, tables):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows_of(QUERIES["op11_centroids"](spark, tables), *columns) == Counter(brute_clusters(awkward_vectors()))


def test_fewer_vectors_than_centroids_and_ties(spark):
    rows = [(1, [1.0, 1.0], 0), (2, [1.0, 1.0], 0), (3, [-1.0, 0.0], 0)]
    got = centroids.clustered(spark.createDataFrame(rows, "vec_id int, embedding array<double>, cluster int"), dim=2)
    assert rows_of(got, "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256") == \
        Counter(brute_clusters(rows, dim=2))


@pytest.mark.parametrize("spread", [1, 200, 1 << 30])
def test_bounds_never_exceed_distances(spread):
    rng = np.random.default_rng(spread)
    middles = rng.integers(-1000, 1000, (6, 16))
    x = [[int(v) * spread for v in middles[i % 6] + rng.integers(-9, 9, 16)] for i in range(300)]
    x = centroids.matrix(x + x[:5], 16)
    c = centroids.matrix([[int(v) * spread for v in m] for m in middles], 16)
    pivots = centroids.Pivots(c[:4])
    near = centroids.distances(x, pivots.points)
    exact = np.array([centroids.squared(x, m) for m in c], dtype=np.float64).T
    assert (pivots.bounds(near, c) <= exact).all()
    cluster, d, checked = centroids.assign(x, near, pivots, c)
    want = [min((int(centroids.squared(x[i:i + 1], m)[0]), j) for j, m in enumerate(c)) for i in range(len(x))]
    assert [(int(a), int(b)) for a, b in zip(d, cluster)] == want
    assert checked < len(x) * len(c) / 2  # most centroids are ruled out by the pivots


def test_pivots_that_coincide_give_no_bound():
    x = centroids.matrix([[0, 0], [5, 5]], 2)
    pivots = centroids.Pivots(centroids.matrix([[1, 1], [1, 1]], 2))
    assert pivots.pairs == []
    got = centroids.assign(x, centroids.distances(x, pivots.points), pivots, centroids.matrix([[4, 4], [0, 1], [1, 0]], 2))
    assert got[0].tolist() == [1, 0] and got[1].tolist() == [1, 2]


# --- manifest -----------------------------------------------------------------
def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Levels of a tree, from its nodes to the one that is left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][a:a + 16]) for a in range(0, len(levels[-1]), 16)])
    return levels


def brute_manifest(docs):
    """docs: (doc_id, text, lang, source, n_chars)."""
    lower = {c: c + 32 for c in range(65, 91)}
    leaf = lambda r, text: H(map(field, (r[0], r[3], r[2], r[4], text)))
    sources = sorted({r[3] for r in docs}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in docs if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for s in sources}
    trees = {s: climb([leaf(r, r[1]) for r in rows]) for s, rows in own.items()}
    top = climb([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for i, r in enumerate(own[s]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now = leaf(r, r[1].translate(lower) if hit and r[1] is not None else r[1])
            proof = []
            for levels, j in ((trees[s], i), (top, at)):
                for level in levels[:-1]:
                    run, slot = level[j // 16 * 16:j // 16 * 16 + 16], j % 16
                    proof += run[:slot] + run[slot + 1:]
                    now = H(run[:slot] + [now] + run[slot + 1:])
                    j //= 16
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], top[-1][0], H(proof), now, now == top[-1][0]))
    return Counter(out)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_op12(spark, tables):
    want = brute_manifest([r[:5] for r in awkward_rows()])
    assert rows_of(QUERIES["op12_manifest"](spark, tables), *COLUMNS) == want


@pytest.mark.parametrize("counts", [{"a": 1}, {"a": 16, "b": 17}, {"a": 9000, None: 4097, "ü": 4096, "z": 1}])
def test_manifest_over_several_blocks(spark, counts):
    rows = [(i, f"Text {i}" if i % 7 else None, "en", s, i) for s, n in counts.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = rows_of(manifest.manifest(docs.repartition(5).withColumn("idx", F.lit(1)).withColumn("g", F.lit("x"))), *COLUMNS)
    assert got == brute_manifest(rows)
    assert len(rows) < 10 or {k[-1] for k in got} == {True, False}


def test_manifest_of_very_many_sources(spark):
    rows = [(i, "T", "en", f"s{i % 5000}", 1) for i in range(5100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert rows_of(manifest.manifest(docs), *COLUMNS) == brute_manifest(rows)


def test_states_resume_at_every_slot():
    run = [H([str(i)]) for i in range(13)]
    parent = manifest.Parent(run)
    assert parent.digest == H(run)
    for slot in range(13):
        assert parent.fold(slot, "x") == H(run[:slot] + ["x"] + run[slot + 1:])
        assert parent.fold(slot, run[slot]) == parent.digest  # the states are copies: folding leaves them as they were


# --- multi-index ----------------------------------------------------------------
def test_op13(spark, tables):
    got = rows_of(QUERIES["op13_multi_index"](spark, tables), "vec_id", "n_links", "component_id", "kept")
    assert got == Counter(brute_links(awkward_vectors()))


def planted(n=3000, hot=700, dim=32, seed=3):
    """A third of all rows in one group of near copies, pairs and loners."""
    rng = np.random.default_rng(seed)
    loose = rng.standard_normal((n - hot - 600, dim))
    centre = rng.standard_normal(dim)
    pairs = rng.standard_normal((300, dim))
    noisy = lambda v, s: v + rng.standard_normal(v.shape) * s
    x = np.concatenate([loose, noisy(np.repeat(centre[None], hot, 0), 0.1), pairs, noisy(pairs, 0.15)]).astype(np.float32)
    order = rng.permutation(n)
    return [(int(i), x[j].tolist(), int(j % 2)) for i, j in enumerate(order)]


@pytest.mark.parametrize("cell, chunk", [(512, 2048), (8, 16)])
def test_recall_against_brute_force(spark, cell, chunk):
    """Few large cells, and many small ones with a hot one in many chunks."""
    rows = planted()
    x = multi_index.unit(np.array([r[1] for r in rows], dtype=np.float64))
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    docs = spark.createDataFrame(rows, VECTORS).repartition(7)
    got = {r["vec_id"]: r for r in multi_index.near_duplicates(docs, cell=cell, chunk=chunk).collect()}
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= near[i].sum() for i in range(len(rows)))  # none below the threshold
    assert found >= 0.97 * near.sum() > 100_000
    if cell == 512:
        assert found == near.sum()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_pairs_are_counted_once_however_often_they_meet(spark):
    """A target of 1 visits far more cells; the counts stay exact."""
    rows = planted(900, 200)
    docs = spark.createDataFrame(rows, VECTORS)
    plain = {r["vec_id"]: r["n_links"] for r in multi_index.near_duplicates(docs, cell=4, chunk=32, target_recall=1.0).collect()}
    x = multi_index.unit(np.array([r[1] for r in rows], dtype=np.float64))
    near = (x @ x.T >= 0.98) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    assert plain == {i: int(near[i].sum()) - 1 for i in range(len(rows))}


def test_traversal_is_a_prefix_of_the_multi_sequence():
    rng = np.random.default_rng(1)
    u = multi_index.unit(rng.standard_normal((500, 24)))
    grid = multi_index.fit(u, 12)
    own, visited = grid.cells(u[:60])
    (a, ca), (b, cb) = grid.costs(u[:60])
    for i in range(60):
        ca[i, a[i]] = cb[i, b[i]] = 0.0
        walk = list(multi_sequence_until(ca[i], cb[i], grid.bound))
        assert visited[i][0] == own[i] and sorted(visited[i]) == sorted(p * len(grid.books[1]) + q for p, q in walk)
    costs = [c for c, _, _ in multi_index.multi_sequence(ca[0], cb[0])]
    assert costs == sorted(costs) and len(costs) == ca.shape[1] * cb.shape[1]


def multi_sequence_until(first, second, bound):
    for cost, i, j in multi_index.multi_sequence(first, second):
        if cost > bound:
            return
        yield i, j


def test_target_recall_of_partners_at_the_threshold():
    rng = np.random.default_rng(2)
    u = multi_index.unit(rng.standard_normal((6000, 64)))
    grid = multi_index.fit(u[:4000], 16, target_recall=0.95)
    q, noise = u[4000:], rng.standard_normal((2000, 64))
    noise -= (noise * q).sum(axis=1)[:, None] * q
    partners = 0.98 * q + math.sqrt(1 - 0.98 ** 2) * multi_index.unit(noise)
    home, _ = grid.cells(partners)
    _, visited = grid.cells(q)
    assert 0.93 < np.mean([h in v for h, v in zip(home, visited)]) < 0.97
    assert np.mean([len(v) for v in visited]) < 0.05 * len(grid.books[0]) * len(grid.books[1])


def test_forest_reaches_the_smallest_node_of_a_chain():
    met = np.zeros((4, 4), dtype=bool)
    for i in range(4):
        met[i, i] = True
        if i < 3:
            met[i, i + 1] = True
    a, b = multi_index.forest(met, np.array([9, 8, 7, 6]), np.array([15, 14, 13, 5]))
    assert a.tolist() == [5] * 4 and b.tolist() == [5] * 4
