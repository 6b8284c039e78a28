"""Exact repeats of ``min_length`` (200) bytes with a logarithmic family of
suffix arrays.

A window is ``min_length`` bytes of one document.  Its anchor is the ``GRAM``
bytes with the least hash among all such runs of bytes in it (the leftmost of
equals), so equal windows have equal anchors at equal offsets.  Successive
windows with the same anchor position are a run, and the suffix that starts
at the anchor is what gets indexed: about two suffixes per
``min_length - GRAM`` bytes stand for all of them.

* Suffix arrays: the entries (anchor hash, run hash) of a batch, sorted.  They
  are dealt to tasks by anchor hash; within its share each task keeps levels
  of doubling size.  A new batch is sorted, merge-scanned against itself and
  every level, and becomes a level; two levels of equal size merge.
* A run whose whole content (run hash) comes twice is covered.  A run whose
  anchor comes again, but not the run, is an edge: its bytes and those of one
  representative per covered run of that anchor are fetched and compared
  window by window.  Other runs have no repeat.
* Anchors with more than their share of all entries (``hot``, a list of at
  most 8 per task) skip the index, as they are known to repeat: their run and
  window hashes are counted with partial aggregation, so a passage that a
  third of all rows hold never meets in one task.

Documents are known by the hash of their text: equal texts have equal repeats.
Which documents a step needs is told by a Bloom filter of bounded size, so
that other texts stay where they are; a false hit only costs the trip.

Null and empty texts have no bytes and nothing removed; texts shorter than
``min_length`` keep all.  Copies (also repeated rows) are removed in all
places.  A null doc_id is an ordinary one.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import frame, partitions, stored, text_or_empty, texts_of

MIN_LENGTH, GRAM, BATCHES = 200, 96, 8
BLOCK = 1 << 19  # windows of one text that are handled at once
HOT_ENTRIES = 20_000  # an anchor with fewer entries is never hot
CELLS = 1 << 16
BLOOM_BITS = 1 << 27  # at most 16 MB
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


class Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up, self.down = np.ones(1, dtype=_U), np.ones(1, dtype=_U)

    def upto(self, n: int):
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.r_[self.up, self.up * _U(pow(_BASE, k, 1 << 64))]
            self.down = np.r_[self.down, self.down * _U(pow(_BASE, -k, 1 << 64))]
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


def rolling(data: np.ndarray):
    """A function (starts, ends) -> hashes of data[start:end]."""
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:-1], out=sums[1:])
    return lambda s, e: mixed((sums[e] - sums[s]) * down[s])


def least_in_windows(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost minimum of h[i:i + w] for every i."""
    v, at, size = h, np.arange(len(h)), 1
    while size < w:
        step = min(size, w - size)
        n = len(v) - step
        right = v[step:] < v[:n]
        at = np.where(right, at[step:], at[:n])
        v = np.where(right, v[step:], v[:n])
        size += step
    return at


def runs(data: bytes, min_length: int = MIN_LENGTH, gram: int = GRAM):
    """(anchor hash, run hash, first window, number of windows) of all runs."""
    out = ([], [], [], [])
    for a in range(0, len(data) - min_length + 1, BLOCK):
        part = np.frombuffer(data, dtype=np.uint8)[a:a + BLOCK + min_length - 1]
        digest = rolling(part)
        at = np.arange(len(part) - gram + 1)
        anchor = digest(at, at + gram)
        least = least_in_windows(anchor, min_length - gram + 1)
        first = np.r_[0, np.flatnonzero(np.diff(least)) + 1]
        after = np.r_[first[1:], len(least)]
        place = least[first]
        # The run's bytes and where the anchor is in them.
        run = digest(first, after - 1 + min_length) ^ mixed(
            ((after - first).astype(_U) << _U(32)) + (place - first).astype(_U))
        for col, x in zip(out, (anchor[place], run, first + a, after - first)):
            col.append(x)
    if not out[0]:
        return tuple(np.zeros(0, dtype=t) for t in (_U, _U, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in out)


ENTRY = pa.schema([("h", pa.int64()), ("f", pa.int64()), ("t", pa.int64()),
                   ("s", pa.int32()), ("m", pa.int32())])
ENTRY_SQL = "h bigint, f bigint, t bigint, s int, m int"


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Texts with their hash t."""
    text = text_or_empty(text_col)
    return docs.select(text.alias("text"), F.xxhash64(text).alias("t"))


def entries(texts: DataFrame, min_length: int) -> DataFrame:
    """Index entries of keyed texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got, size = [], 0
            for t, text in zip(batch.column(1).to_pylist(), texts_of(batch.column(0))):
                h, f, s, m = runs(text.encode(), min_length)
                got.append((h.view(np.int64), f.view(np.int64), np.full(len(h), t, dtype=np.int64), s, m))
                size += len(h)
                if size > 1 << 18:
                    yield frame(ENTRY, [np.concatenate(c) for c in zip(*got)])
                    got, size = [], 0
            if size:
                yield frame(ENTRY, [np.concatenate(c) for c in zip(*got)])

    return texts.filter(F.octet_length("text") >= min_length).mapInArrow(run, ENTRY_SQL)


def hot_anchors(found: DataFrame, shards: int) -> DataFrame | None:
    """(h) of the anchors with more than an eighth of a task's mean share of
    entries (so at most 8 per task), found through the counts of ``CELLS``
    hash cells; None if there are none."""
    spark = found.sparkSession
    cell = F.pmod(F.col("h"), F.lit(CELLS)).cast("int")
    counts = found.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()
    limit = max(HOT_ENTRIES, sum(r["n"] for r in counts) // (8 * shards))
    cells = [(r["cell"],) for r in counts if r["n"] > limit]
    if not cells:
        return None
    cells = F.broadcast(spark.createDataFrame(cells, "cell int"))  # at most CELLS rows
    rows = (found.withColumn("cell", cell).join(cells, "cell", "left_semi")
            .groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select("h").collect())
    return spark.createDataFrame([(r["h"],) for r in rows], "h bigint") if rows else None


# --- the index family ---------------------------------------------------------
class Levels:
    """Levels of doubling size over entries with one 64-bit key; ``met`` tells
    which entries have met an equal key."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.met = keys, np.zeros(len(keys), dtype=bool)
        self.levels: list[tuple[int, np.ndarray]] = []  # (rank, entries in key order)

    def insert(self, new: np.ndarray) -> None:
        """Add a batch of entry numbers: sort, scan, merge."""
        new = new[np.argsort(self.keys[new], kind="stable")]
        k = self.keys[new]
        same = k[1:] == k[:-1]
        self.met[new[1:][same]] = True
        self.met[new[:-1][same]] = True
        for _, old in self.levels:
            self._scan(k, new, old)
        rank, level = 0, new
        while self.levels and self.levels[-1][0] == rank:
            _, old = self.levels.pop()
            level = np.concatenate([old, level])
            level = level[np.argsort(self.keys[level], kind="stable")]  # two sorted halves: a merge
            rank += 1
        self.levels.append((rank, level))

    def _scan(self, k: np.ndarray, new: np.ndarray, old: np.ndarray) -> None:
        there = self.keys[old]
        a, b = np.searchsorted(there, k, side="left"), np.searchsorted(there, k, side="right")
        hit = b > a
        self.met[new[hit]] = True
        step = np.zeros(len(old) + 1, dtype=np.int64)
        np.add.at(step, a[hit], 1)
        np.add.at(step, b[hit], -1)
        self.met[old[np.cumsum(step[:-1]) > 0]] = True


COVERED, EDGE, WITNESS = 0, 1, 2  # a witness is covered, and an edge may meet it
MATCH = pa.schema([("h", pa.int64()), ("t", pa.int64()), ("s", pa.int32()), ("m", pa.int32()),
                   ("kind", pa.int32())])
MATCH_SQL = "h bigint, t bigint, s int, m int, kind int"


def matches_of(table: pa.Table, batches: int = BATCHES) -> pa.RecordBatch:
    """Entries with a repeated anchor in one task's share of the index."""
    h, f, t, s, m = (np.asarray(table.column(c)) for c in ("h", "f", "t", "s", "m"))
    both = mixed((h.view(_U) * _U(_BASE)) ^ f.view(_U))
    anchors, whole = Levels(h), Levels(both)
    batch = t % batches
    for b in range(batches):
        new = np.flatnonzero(batch == b)
        if len(new):
            anchors.insert(new)
            whole.insert(new)
    kind = np.where(whole.met, COVERED, EDGE)
    edged = np.unique(h[anchors.met & ~whole.met])
    candidates = np.flatnonzero(whole.met & np.isin(h, edged))
    if len(candidates):
        kind[candidates[np.unique(both[candidates], return_index=True)[1]]] = WITNESS
    pick = np.flatnonzero(anchors.met)
    # Copies of a text give the same entries: one of each is enough.
    order = pick[np.lexsort((-kind[pick], s[pick], t[pick]))]
    if len(order):
        order = order[np.r_[True, (np.diff(t[order]) != 0) | (np.diff(s[order]) != 0)]]
    return frame(MATCH, [h[order], t[order], s[order], m[order], kind[order]])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = list(batches)
    if got:
        yield matches_of(pa.Table.from_batches(got))


def hot_matches(found: DataFrame) -> DataFrame:
    """The same for entries of hot anchors, by counting: copies and equal runs
    are added up before they are sent."""
    single = found.groupBy("h", "f", "t", "s", "m").agg(F.count(F.lit(1)).alias("n"))
    single = stored(single, "hot-entries")
    whole = (single.groupBy("h", "f").agg(F.sum("n").alias("n"), F.min(F.struct("t", "s")).alias("one"))
             .filter("n > 1").select("h", "f", "one"))
    kind = (F.when(F.col("one").isNull(), EDGE)
            .when((F.col("one.t") == F.col("t")) & (F.col("one.s") == F.col("s")), WITNESS)
            .otherwise(COVERED))
    return single.join(whole, ["h", "f"], "left").select("h", "t", "s", "m", kind.cast("int").alias("kind"))


# --- fetching texts -------------------------------------------------------------
def member_test(keys: DataFrame):
    """A column function that tells whether a text hash may be in keys(t): a
    Bloom filter of one bit per key in 16 times as many places (2^27 at most),
    built by Spark's bitmap aggregate and broadcast."""
    spark = keys.sparkSession
    n = keys.select(F.approx_count_distinct("t")).first()[0]
    bits = 1 << 15
    while bits < min(BLOOM_BITS, 16 * n):
        bits *= 2
    place = F.pmod(F.col("t"), F.lit(bits))
    parts = (keys.select(place.alias("p"))
             .groupBy(F.bitmap_bucket_number(F.col("p") + 1).alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("bitmap")).collect())
    table = np.zeros(bits // 8, dtype=np.uint8)
    for r in parts:
        at = (r["bucket"] - 1) * 4096
        table[at:at + 4096] = np.frombuffer(r["bitmap"], dtype=np.uint8)[:len(table) - at]
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def member(t: pd.Series) -> pd.Series:
        p = t.to_numpy() % bits
        return pd.Series((shared.value[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1)

    return member


PIECE = pa.schema([("h", pa.int64()), ("t", pa.int64()), ("s", pa.int32()), ("m", pa.int32()),
                   ("bytes", pa.binary())])
PIECE_SQL = "h bigint, t bigint, s int, m int, bytes binary"


def pieces(texts: DataFrame, wanted: DataFrame, min_length: int) -> DataFrame:
    """The bytes of edges and witnesses, fetched from their documents."""
    member = member_test(wanted.select("t"))
    lists = wanted.groupBy("t").agg(F.collect_list(F.struct("h", "s", "m")).alias("runs"))
    # A text with copies is fetched once per copy: its entries are witnesses,
    # for which once or twice is the same.
    joined = texts.filter(member("t")).join(lists, "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, text, own in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                rows = [(r["h"], t, r["s"], r["m"], data[r["s"]:r["s"] + r["m"] - 1 + min_length]) for r in own]
                for a in range(0, len(rows), 1 << 14):
                    yield frame(PIECE, zip(*rows[a:a + (1 << 14)]))

    return joined.select("t", "text", "runs").mapInArrow(run, PIECE_SQL)


SPAN = pa.schema([("t", pa.int64()), ("s", pa.int32()), ("m", pa.int32())])
SPAN_SQL = "t bigint, s int, m int"


def window_hashes(data: bytes, m: int, min_length: int) -> np.ndarray:
    at = np.arange(m)
    return rolling(np.frombuffer(data, dtype=np.uint8))(at, at + min_length)


def compare(min_length: int):
    """Runs of windows that come again among all pieces of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, ms, ts, ss = [], [], [], [], []
        for batch in batches:
            for h, t, s, m, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                hashes.append(window_hashes(data, m, min_length) ^ _U(h & ((1 << 64) - 1)))
                ms.append(m)
                ts.append(t)
                ss.append(s)
        if not hashes:
            return
        t, s, m = np.repeat(ts, ms), np.repeat(ss, ms), np.array(ms)
        w = np.concatenate(hashes)
        pos = s + np.arange(len(w)) - np.repeat(np.cumsum(m) - m, m)
        order = np.argsort(w, kind="stable")
        same = w[order][1:] == w[order][:-1]
        hit = np.zeros(len(w), dtype=bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        t, pos = t[hit], pos[hit]
        if not len(t):
            return
        new = np.r_[True, (np.diff(t) != 0) | (np.diff(pos) != 1)]
        first = np.flatnonzero(new)
        yield frame(SPAN, [t[first], pos[first], np.diff(np.r_[first, len(t)])])

    return run


def compare_hot(found: DataFrame, min_length: int) -> DataFrame:
    """The same for pieces of hot anchors: window hashes are counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("t", pa.int64()), ("s", pa.int32()), ("w", pa.list_(pa.int64()))])
        for batch in batches:
            got = [(t, s, (window_hashes(data, m, min_length) ^ _U(h & ((1 << 64) - 1))).view(np.int64))
                   for h, t, s, m, data in zip(*(batch.column(i).to_pylist() for i in range(5)))]
            if got:
                yield frame(schema, zip(*got))

    windows = found.mapInArrow(run, "t bigint, s int, w array<bigint>").select(
        "t", "s", F.posexplode("w").alias("i", "w"))
    windows = windows.groupBy("w", "t", (F.col("s") + F.col("i")).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    windows = stored(windows, "hot-windows")
    again = windows.groupBy("w").agg(F.sum("n").alias("n")).filter("n > 1").select("w")
    return windows.join(again, "w").select("t", "s", F.lit(1).alias("m"))


def repeats(docs: DataFrame, min_length: int = MIN_LENGTH, text_col: str = "text") -> DataFrame:
    """(t, spans): per text hash, the runs (s, m) of repeated windows: m
    windows from byte s on."""
    spark = docs.sparkSession
    shards = partitions(spark)
    texts = keyed(docs, text_col)
    found = stored(entries(texts, min_length), "entries")
    hot = hot_anchors(found, shards)
    cold = found if hot is None else found.join(F.broadcast(hot), "h", "left_anti").select(*found.columns)
    matches = stored(cold.repartition(shards, "h").mapInArrow(_index, MATCH_SQL), "matches")
    spans = matches.filter(F.col("kind") != EDGE).select("t", "s", "m")
    edges = matches.filter(F.col("kind") != COVERED)
    if not edges.isEmpty():
        spans = spans.unionByName(
            pieces(texts, edges, min_length).repartition(shards, "h").mapInArrow(compare(min_length), SPAN_SQL))
    if hot is not None:
        matches = stored(hot_matches(found.join(F.broadcast(hot), "h", "left_semi")), "hot-matches")
        spans = spans.unionByName(matches.filter(F.col("kind") != EDGE).select("t", "s", "m"))
        edged = matches.filter(F.col("kind") == EDGE).select("h").distinct()
        edges = matches.filter(F.col("kind") != COVERED).join(F.broadcast(edged), "h", "left_semi")
        if not edges.isEmpty():
            spans = spans.unionByName(compare_hot(pieces(texts, edges, min_length), min_length))
    spans = spans.groupBy("t", "s").agg(F.max("m").alias("m"))
    return stored(spans.groupBy("t").agg(F.collect_list(F.struct("s", "m")).alias("spans")), "repeats")


# --- removal ---------------------------------------------------------------------
def keep_mask(n: int, spans, min_length: int) -> tuple[np.ndarray, int]:
    """Which of n bytes stay, and how many maximal runs go."""
    step = np.zeros(n + 1, dtype=np.int64)
    s = np.array([x["s"] for x in spans], dtype=np.int64)
    e = s + np.array([x["m"] for x in spans], dtype=np.int64) - 1 + min_length
    np.add.at(step, s, 1)
    np.add.at(step, e, -1)
    gone = np.cumsum(step[:-1]) > 0
    return ~gone, int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0


def remove_repeats(docs: DataFrame, min_length: int = MIN_LENGTH, text_col: str = "text") -> DataFrame:
    """All columns of docs, with n_bytes, n_removed, n_spans (bigint) and kept
    (binary: the bytes that stay)."""
    if {"n_bytes", "n_removed", "n_spans", "kept", "t"} & {c.lower() for c in docs.columns}:
        docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept", "t")
    spans = repeats(docs, min_length, text_col)
    member = member_test(spans.select("t"))
    text = text_or_empty(text_col)
    cols = docs.columns
    rows = docs.withColumn("_t", F.xxhash64(text)).withColumn("_hit", member("_t"))
    size = F.octet_length(text).cast("bigint")
    zero = F.lit(0).cast("bigint")
    whole = rows.filter(~F.col("_hit")).select(
        *cols, size.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        text.cast("binary").alias("kept"))
    joined = (rows.filter("_hit").join(spans, F.col("_t") == F.col("t"), "left")
              .select(*cols, "spans"))
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, kept = [], [], [], []
            for value, own in zip(texts_of(batch.column(at)), batch.column(len(cols)).to_pylist()):
                data = value.encode()
                stay, n = keep_mask(len(data), own or [], min_length)
                left = np.frombuffer(data, dtype=np.uint8)[stay].tobytes()
                sizes.append(len(data))
                removed.append(len(data) - len(left))
                counts.append(n)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(cols))), pa.array(sizes, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary())],
                names=[*cols, "n_bytes", "n_removed", "n_spans", "kept"])

    return whole.unionByName(joined.mapInArrow(run, whole.schema))
