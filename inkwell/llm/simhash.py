"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: A-Z lower-cased, words are runs of characters other than blank
and \\t to \\r, shingles of three words (fewer words: the whole sequence) as
often as they come, each hashed with XXH64 (UTF-8, seed 42); a bit is 1 if it
is set in more than half of the hashes.  A text without words has fingerprint
zero and links like any other.

Two fingerprints link at ``radius`` (3) or fewer differing bits.  With the 64
bits cut into m partitions and thresholds t_i that sum up to radius - m + 1,
any linked pair differs in at most t_i bits of some partition i (-1: the
partition is not asked).  Correlated bits share a partition, so that the
others stay selective; for every m, dynamic programming allocates the
thresholds with the least estimated cost, and the cheapest m is taken.
Estimates come from the counts of all bits and bit pairs over all distinct
fingerprints.  A partition with threshold t is probed with all keys within t
bits, meets the index through an equi-join, and candidates are verified on
the full distance.

Copies never meet: rows are first reduced to distinct fingerprints with their
smallest doc_id.  Links are contracted to components by alternating star
steps, each a join and a minimum per node, never a group in one task.

Null and empty texts have fingerprint zero.  A null doc_id keeps its row and
never is a component_id, unless no row of the component has a doc_id.
Repeated rows each get their row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import frame, slices, stored, texts_of

SHINGLE, SEED, RADIUS, BITS = 3, 42, 3, 64
UNIT_BYTES = 8 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# What a candidate pair costs against a row that is sent to the join.
PAIR_COST = 4.0


def shingle_hashes(text: str, k: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    words = text.encode().translate(_LOWER).split()  # bytes.split: blank and \t to \r
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(line, seed)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends[k - 1:].tolist())),
                       dtype=np.uint64, count=len(words) - k + 1)


def fingerprint(text: str, k: int = SHINGLE, seed: int = SEED) -> int:
    h = shingle_hashes(text, k, seed)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, k: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, mark, fp): a hash of the text that tells rows with one doc_id
    apart, and the fingerprint as a signed bigint."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", UNIT_BYTES):
            yield frame(schema, [batch.column(0), batch.column(1),
                                 [signed(fingerprint(t, k, seed)) for t in texts_of(batch.column(2))]])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                        F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id bigint, mark bigint, fp bigint"))


def hex16(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# --- partitions and thresholds --------------------------------------------
def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of fps(fp), and for every two bits in how many both are set: one
    64 x 64 table per task, summed by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            for i in range(0, batch.num_rows, 1 << 14):
                x = np.asarray(batch.column(0).slice(i, 1 << 14)).astype("<i8").view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
                n += len(bits)
        at = np.arange(BITS * BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[at, -1].astype(np.int32)), pa.array(np.r_[total.ravel(), n])], names=["at", "n"])

    got = fps.select("fp").mapInArrow(run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()
    table, n = np.zeros(BITS * BITS), 0
    for r in got:
        if r["at"] < 0:
            n = r["n"]
        else:
            table[r["at"]] = r["n"]
    return int(n), table.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of equal width; each starts with the free bit that is most
    correlated and takes in the free bits most correlated with it."""
    p = both.diagonal() / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = set(range(BITS)), []
    for i in range(m):
        width = len(free) // (m - i)
        first = max(sorted(free), key=lambda b: max((corr[b, c] for c in free), default=0))
        part = [first]
        free.remove(first)
        while len(part) < width:
            best = max(sorted(free), key=lambda b: corr[b, part].mean())
            part.append(best)
            free.remove(best)
        out.append(part)
    return out


def match_within(n: int, both: np.ndarray, part: list[int], most: int) -> list[float]:
    """Chance that two rows drawn at random differ in at most 0, 1, .. most
    bits of the partition: a chain over its bits, each depending on the one
    before through the counts of the pair."""
    def agree(a):
        q = both[a, a] / n
        return q * q + (1 - q) ** 2

    def agree_both(a, b):
        p11, pa, pb = both[a, b] / n, both[a, a] / n, both[b, b] / n
        return p11 ** 2 + (pa - p11) ** 2 + (pb - p11) ** 2 + (1 - pa - pb + p11) ** 2

    state = np.zeros((most + 2, 2))  # differing bits (most + 1: more), last bit agreed
    q = agree(part[0])
    state[0, 1], state[1, 0] = q, 1 - q
    for a, b in zip(part, part[1:]):
        qa, qb, qab = agree(a), agree(b), agree_both(a, b)
        after = (min(1.0, max(0.0, (qb - qab) / max(1 - qa, 1e-12))), min(1.0, qab / max(qa, 1e-12)))
        new = np.zeros_like(state)
        for d, last in itertools.product(range(most + 2), (0, 1)):
            new[d, 1] += state[d, last] * after[last]
            new[min(d + 1, most + 1), 0] += state[d, last] * (1 - after[last])
        state = new
    return np.cumsum(state.sum(axis=1))[:most + 1].tolist()


def keys_within(width: int, t: int) -> int:
    return sum(math.comb(width, i) for i in range(t + 1))


def allocate(n: int, both: np.ndarray, parts: list[list[int]], radius: int, most: int = 2):
    """(cost, thresholds) with the least estimated cost of rows and candidate
    pairs among all thresholds from -1 to most that sum up to radius - m + 1."""
    pairs = n * (n - 1) / 2
    best = {0: (0.0, ())}
    for part in parts:
        chance = match_within(max(n, 1), both, part, most)
        cost = {-1: 0.0}
        for t in range(most + 1):
            rows = n if t == 0 else n * (1 + keys_within(len(part), t))
            cost[t] = rows + PAIR_COST * pairs * chance[t]
        new: dict[int, tuple[float, tuple[int, ...]]] = {}
        for (total, (c, ts)), (t, own) in itertools.product(best.items(), cost.items()):
            if total + t not in new or (c + own, (*ts, t)) < new[total + t]:
                new[total + t] = (c + own, (*ts, t))
        best = new
    return best.get(radius - len(parts) + 1)


def plan(n: int, both: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the cheapest plan."""
    found = []
    for m in range(2, 2 * radius + 1):
        parts = group_bits(n, both, m)
        got = allocate(n, both, parts, radius)
        if got:
            found.append((got[0], m, list(zip(parts, got[1]))))
    return [(bits, t) for bits, t in min(found)[2] if t >= 0]


# --- links and components ---------------------------------------------------
def links(fps: DataFrame, asked: list[tuple[list[int], int]], radius: int = RADIUS) -> DataFrame:
    """(u, v), u > v, of distinct fingerprints fps(fp) within the radius."""
    probes, index = [], []
    for i, (bits, t) in enumerate(asked):
        mask = signed(sum(1 << b for b in bits))
        key = F.col("fp").bitwiseAND(F.lit(mask))
        flips = [0]
        for d in range(1, t + 1):
            flips += [signed(sum(1 << b for b in c)) for c in itertools.combinations(sorted(bits), d)]
        near = [key] if t == 0 else [F.explode(F.array(*[key.bitwiseXOR(F.lit(x)) for x in flips]))]
        probes.append(fps.select("fp", F.lit(i).alias("part"), near[0].alias("key")))
        index.append(fps.select(F.col("fp").alias("other"), F.lit(i).alias("part"), key.alias("key")))

    def union(frames):
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    met = union(probes).join(union(index), ["part", "key"]).filter(
        (F.col("fp") > F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius))
    return met.select(F.col("fp").alias("u"), F.col("other").alias("v")).distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) of every node on an edge (u > v); the root is the smallest
    node of its component.  Alternates large-star steps (every larger
    neighbour points to the smallest neighbour) and small-star steps (so do
    the smaller ones and the node itself) until nothing changes.  Rounds grow
    with the logarithm of the table; more than ``rounds`` raise an error."""
    def state(e):
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    edges = stored(edges, "links")
    seen = state(edges)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u and v > m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u > v").distinct())
        edges = stored(small, "small-star")
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def grouped(docs: DataFrame, radius: int = RADIUS, k: int = SHINGLE, seed: int = SEED,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, fp, root, component_id), one row per document; root is
    the component's smallest fingerprint."""
    rows = stored(fingerprints(docs, k, seed, id_col, text_col), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    n, both = bit_counts(fps)
    if n < 2:
        ids = fps.select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    else:
        found = components(links(fps, plan(n, both, radius), radius))
        smallest = (found.join(fps, found["node"] == fps["fp"])
                    .groupBy("root").agg(F.min("first").alias("component_id")))
        linked = found.join(smallest, "root").select(F.col("node").alias("fp"), "root", "component_id")
        ids = fps.join(linked, "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id"))
    return rows.join(ids, "fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, k: int = SHINGLE, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document."""
    return grouped(docs, radius, k, seed, id_col, text_col).select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
