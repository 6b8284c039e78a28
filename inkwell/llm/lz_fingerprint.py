"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into LZ78 phrases: from left to right, the shortest string
that is no phrase yet becomes one.  A remainder that is a phrase already adds
none.  Every phrase is hashed, and the fingerprint holds, for each of
``COMPONENTS`` hash functions, the least value over the phrase set, reduced to
16 bits.  The likeness of two fingerprints is the share of equal components,
an estimate of the Jaccard similarity of the phrase sets, which is high for
texts that compress well together.

``edited_fingerprints`` also fingerprints each text with its last third
replaced by the start of the next document (descending doc_id, the first one
after the last).  Both parses share the phrases of the untouched part.  For
the order, documents are dealt to blocks between quantiles of doc_id; the
greatest document of a block is sent to the block above as well, where it is
the next of the block's last one.  So a text moves once, no order over all
rows is made, and a block streams through a task document by document.

Defined results: a null text is empty; empty texts have all components at
their greatest value, and two such fingerprints have likeness 1.  Rows with a
null doc_id come after all others.  Among rows with one doc_id the order is
that of their texts; repeated rows follow each other.  A single row is its own
next one.  Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import frame, partitions, texts_of

COMPONENTS = 64
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_PICK = np.random.Generator(np.random.PCG64(20240611))  # fixed hash functions
_MULTIPLY = _PICK.integers(0, 1 << 63, COMPONENTS, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _PICK.integers(0, 1 << 63, COMPONENTS, dtype=np.uint64)
NONE = np.full(COMPONENTS, 2**64 - 1, dtype=np.uint64)


def phrase_ends(text: str, start: int, stop: int, known: set[str]) -> list[int]:
    """Ends of the phrases of text[start:stop]; adds them to ``known``, which
    holds every prefix of what it holds."""
    ends, size = [], 4
    while start < stop:
        size = min(size, stop - start)
        phrase = text[start:start + size]
        if phrase in known:
            while phrase in known and start + size < stop:
                size += 1
                phrase = text[start:start + size]
            if phrase in known:
                break  # the remainder is a phrase already
        else:
            while size > 1:
                shorter = text[start:start + size - 1]
                if shorter in known:
                    break
                phrase, size = shorter, size - 1
        known.add(phrase)
        start += size
        ends.append(start)
    return ends


class Powers:
    def __init__(self):
        self.up, self.down = np.ones(1, dtype=_U), np.ones(1, dtype=_U)

    def upto(self, n: int):
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.r_[self.up, self.up * _U(pow(_BASE, k, 1 << 64))]
            self.down = np.r_[self.down, self.down * _U(pow(_BASE, -k, 1 << 64))]
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def least_hashes(text: str, start: int, ends: list[int]) -> np.ndarray:
    """Least value of every hash function over the phrases."""
    if not ends:
        return NONE
    codes = np.frombuffer(text[start:ends[-1]].encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(_U)
    up, down = _POWERS.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=_U)
    np.cumsum((codes + _U(1)) * up[:-1], out=sums[1:])
    e = np.array(ends, dtype=np.int64) - start
    s = np.r_[0, e[:-1]]
    h = (sums[e] - sums[s]) * down[s]
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(29)
    out = NONE
    for a in range(0, len(h), 1 << 12):
        x = h[a:a + (1 << 12), None] * _MULTIPLY + _ADD
        out = np.minimum(out, (x ^ (x >> _U(32))).min(axis=0))
    return out


def components(least: np.ndarray) -> np.ndarray:
    """16 bits of every least value (mixed, as its high bits are small)."""
    return ((least * _U(0x94D049BB133111EB)) >> _U(48)).astype("<u2")


def shown(parts: np.ndarray) -> str:
    return parts.byteswap().tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


class Parsed:
    """A text, parsed: the fingerprint, and the state before its last third."""

    def __init__(self, text: str):
        self.text, self.n = text, len(text)
        self.cut = self.n - self.n // 3
        self.known: set[str] = set()
        ends = phrase_ends(text, 0, self.cut, self.known)
        self.resume = ends[-1] if ends else 0
        self.common = least_hashes(text, 0, ends)
        self.parts = components(self._with(text, set(self.known)))

    def _with(self, text: str, known: set[str]) -> np.ndarray:
        ends = phrase_ends(text, self.resume, len(text), known)
        return np.minimum(self.common, least_hashes(text, self.resume, ends))

    def edited(self, following: str):
        """The edited text and its components; uses up the state."""
        text = self.text[:self.cut] + following[:self.n // 3]
        return text, components(self._with(text, self.known))


def fingerprint(text: str) -> str:
    return shown(Parsed(text).parts)


ROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                 ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                 ("near_edited", pa.float64()), ("near_next", pa.float64())])
ROW_SQL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")


def _compared(doc_id, own: Parsed, following: Parsed) -> tuple:
    text, edited = own.edited(following.text)
    return (doc_id, own.n, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), shown(own.parts),
            shown(edited), likeness(own.parts, edited), likeness(own.parts, following.parts))


def _blocks(uppers: np.ndarray):
    """Adds block and guest: rows of block b have keys up to uppers[b] (the
    uppers descend and are keys themselves).  Rows with the greatest key of a
    block also go, as guests, to the block above, those of the first block to
    the last one."""
    rising, last = uppers[::-1], len(uppers) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.asarray(batch.column(1))
            block = last - np.searchsorted(rising, key, side="left")
            top = np.flatnonzero(key == uppers[block])
            for rows, at, guest in ((batch, block, 0),
                                    (batch.take(pa.array(top)), np.where(block > 0, block - 1, last)[top], 1)):
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(at, pa.int32()), pa.array([guest] * len(at), pa.int32())],
                    names=["doc_id", "key", "text", "block", "guest"])

    return run


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the one after it; a block's guests come last and are only looked at."""
    before, block, out = None, None, []
    for batch in batches:
        for doc_id, text, b, guest in zip(batch.column(0).to_pylist(), texts_of(batch.column(2)),
                                          batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            if b != block:
                before, block = None, b
            elif before is None:
                continue  # a further guest
            own = Parsed(text)
            if before is not None:
                out.append(_compared(*before, own))
            before = None if guest else (doc_id, own)
            if len(out) >= 1024:
                yield frame(ROW, zip(*out))
                out = []
    if out:
        yield frame(ROW, zip(*out))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), one row per document."""
    spark = docs.sparkSession
    # Rows without an id come after all others.
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Bounds: quantiles of the keys, eight blocks per task.
    tasks = partitions(spark)
    n = 8 * tasks
    found = rows.agg(F.percentile_approx("key", F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(20 * n)).alias("q"),
                     F.max("key").alias("top")).first()
    uppers = np.array(sorted({*(found["q"] or []), *([] if found["top"] is None else [found["top"]])},
                             reverse=True) or [0], dtype=np.int64)
    return (rows.mapInArrow(_blocks(uppers), "doc_id bigint, key bigint, text string, block int, guest int")
            .repartition(tasks, "block").sortWithinPartitions("block", "guest", F.desc("key"), "text")
            .mapInArrow(_chain, ROW_SQL))
