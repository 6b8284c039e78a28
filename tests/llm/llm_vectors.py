"""Rows of the awkward embeddings table and brute force over them."""

import hashlib
import math

import numpy as np


def awkward_vectors(dim=64):
    rng = np.random.default_rng(5)
    rows = []

    def add(vec_id, v, label):
        rows.append((vec_id, None if v is None else [None if x is None else float(x) for x in v], label))

    for i in range(60):
        add(i, rng.standard_normal(dim).astype(np.float32) / 8, i % 3)
    for g in range(3):  # near copies, some pairs on either side of the threshold
        centre = rng.standard_normal(dim)
        for i in range(14):
            add(100 + 20 * g + i, (centre + rng.standard_normal(dim) * (0.08 + 0.01 * i)).astype(np.float32), g % 2)
    for i in range(5):  # exact copies, one under another label, scaled copies
        add(300 + i, rows[3][1], 0 if i else 1)
    add(310, [2 * x for x in rows[3][1]], 0)
    add(311, [-x for x in rows[3][1]], 0)
    add(7, rows[7][1], rows[7][2])  # a row twice
    add(7, rng.standard_normal(dim).astype(np.float32), 1)  # an id twice
    add(None, rows[3][1], 0)
    add(None, rng.standard_normal(dim).astype(np.float32), 2)
    add(320, rows[4][1], None)
    add(321, rows[4][1], None)
    add(330, None, 0)
    add(331, [], 0)
    add(332, [0.0] * dim, 0)
    add(333, [0.0] * dim, 0)
    add(334, [None] + [1.0] * (dim - 1), 0)
    add(335, [float("nan")] + [1.0] * (dim - 1), 0)
    add(336, [float("inf")] + [1.0] * (dim - 1), 0)
    add(340, [1.0, 2.0], 0)
    add(341, [1.0, 2.001], 0)
    add(342, [3.0], 0)
    add(343, [4.0], 0)
    add(350, [np.float32(3e37)] + [1.0] * (dim - 1), 2)  # beyond 64-bit integers
    add(351, [-0.0005] * dim, 2)  # rounds towards minus infinity
    return rows


def linkable(v, label):
    return (label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)
            and any(v))


def cosine(a, b):
    a, b = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
    return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))


def brute_links(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) per row, all pairs compared."""
    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la == lb and linkable(a, la) and linkable(b, lb) and len(a) == len(b) and cosine(a, b) >= threshold:
                near[i].append(j)
                near[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), component, rows[i][0] == component))
    return out


def brute_clusters(rows, k=8, rounds=10, dim=64):
    """Plain Lloyd rounds in Python's integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], v) for i, v, _ in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))
    centroids = [x for _, x, _ in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x, _ in kept]
        centroids = [[sum(col) // len(col) for col in zip(*[x for (_, x, _), o in zip(kept, own) if o == c])] if c in own else old
                     for c, old in enumerate(centroids)]
    near, top = [nearest(x) for _, x, _ in kept], (1 << 63) - 1
    out = []
    for (vec_id, _, _), (d, c) in zip(kept, near):
        out.append((vec_id, c, min(d, top), min(sum(min(e, top) for e, b in near if b == c), top),
                    min(sum(min(sum(min(e, top) for e, b in near if b == a), top) for a in range(k)), top),
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()))
    return out
