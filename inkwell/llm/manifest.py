"""Merkle dataset manifest with SHA midstate trees.

Each document is a leaf: the SHA-256 of its fields, each written with its
byte length.  The leaves of a source, in the order of doc_id, are hashed in
runs of 16 until one node is left (subroot); the subroots, in the order of
the sources, likewise give the root.

A parent's hash is read child by child, and the parent retains a copy of the
hash state before each child slot.  Verifying a document folds its leaf up to
the root: at each parent the state before its slot is resumed and fed the
replacement and the siblings to the right only.

Spark: leaves are column expressions; positions are a distributed row number
per source.  Subtrees of three levels (4,096 neighbouring nodes) are built in
one task each, however many documents a source has, and leave one node per
subtree, until every source has one.  The way down gives each subtree the
siblings on its own path above (left and right of it, a few KB) as one extra
row in front of its nodes, so hash states are rebuilt once per subtree and
shared by its 4,096 documents.  Tables are written between the steps.

Defined cases: null fields are written "-"; null doc_ids come first and are
never tampered with; equal doc_ids go by their leaf, equal rows are leaves of
their own; null is a source like any other and comes first; a single document
is its own subroot and root, its proof the hash of nothing; an empty table
has no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import stored
from inkwell.plans.ranking import distributed_row_number

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, DEPTH = 16, 3
BLOCK = FANOUT ** DEPTH
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_NODES = "g string, idx bigint, digest string"
_PATHS = "g string, idx bigint, path array<struct<left:string,right:string>>, subroot string, root string"
_PATH_TYPE = "array<struct<left:string,right:string>>"


# --- hash trees ---------------------------------------------------------------
class Parent:
    """A node over a run of children, with the hash state before each slot."""

    __slots__ = ("run", "states", "digest")

    def __init__(self, run: list[str]):
        state, self.run, self.states = hashlib.sha256(), run, []
        for child in run:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def fold(self, slot: int, replacement: str) -> str:
        """The node's digest with another child in ``slot``."""
        return resume(self.states[slot], replacement, "".join(self.run[slot + 1:]))

    def siblings(self, slot: int) -> tuple[str, str]:
        return "".join(self.run[:slot]), "".join(self.run[slot + 1:])


def resume(state, replacement: str, right: str) -> str:
    state = state.copy()
    state.update(replacement.encode() + right.encode())
    return state.hexdigest()


def subtree(digests: list[str], alone: bool) -> list[list[Parent]]:
    """Levels of parents over the nodes of one block: three of them, or, if
    the block is all its tree has, as many as leave one node."""
    levels: list[list[Parent]] = []
    while (len(digests) > 1) if alone else len(levels) < DEPTH:
        levels.append([Parent(digests[a:a + FANOUT]) for a in range(0, len(digests), FANOUT)])
        digests = [p.digest for p in levels[-1]]
    return levels


def is_alone(block: int, n: int) -> bool:
    """The first block with fewer nodes than it can hold has no others beside
    it.  (A full one reaches one node by three levels in either case.)"""
    return block == 0 and n < BLOCK


# --- blocks in Spark ----------------------------------------------------------
def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("g", "block").sortWithinPartitions("g", "block", "idx")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of sorted batches, by (g, block); a block is bounded."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = (row["g"], row["block"])
            if now != key and rows:
                yield key, rows
                rows = []
            key = now
            rows.append(row)
    if rows:
        yield key, rows


def _emit(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _up(nodes: DataFrame) -> DataFrame:
    """One node per block of nodes."""
    schema = pa.schema([("g", pa.string()), ("idx", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (g, block), rows in _groups(batches):
            digests = [r["digest"] for r in rows]
            levels = subtree(digests, is_alone(block, len(rows)))
            out.append({"g": g, "idx": block, "digest": levels[-1][0].digest if levels else digests[0]})
            if len(out) >= 4096:
                yield _emit(out, schema)
                out = []
        yield _emit(out, schema)

    rows = nodes.select("g", F.expr(f"idx div {BLOCK}").alias("block"), "idx", "digest")
    return _dealt(rows).mapInArrow(run, _NODES)


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, their blocks' nodes, and so on until each tree has one."""
    out = [nodes]
    while (out[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        out.append(stored(_up(out[-1]), "manifest-nodes"))
    return out


def _above(paths: DataFrame, nodes: DataFrame, extra: list[Column]) -> DataFrame:
    """Nodes with the path of their block as a row in front of them."""
    front = [F.lit(None).cast(t).alias(n) for n, t in (("path", _PATH_TYPE), ("subroot", "string"), ("root", "string"))]
    rows = nodes.select("g", F.expr(f"idx div {BLOCK}").alias("block"), "idx", "digest", *extra, *front)
    head = paths.select("g", F.col("idx").alias("block"), F.lit(-1).cast("bigint").alias("idx"), "path", "subroot", "root")
    return _dealt(rows.unionByName(head, allowMissingColumns=True))


def _local(levels: list[list[Parent]], i: int) -> Iterator[tuple[Parent, int]]:
    """(parent, slot) on the way up from the block's node i."""
    for level in levels:
        yield level[i // FANOUT], i % FANOUT
        i //= FANOUT


def _down(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Paths of all nodes from the paths of their blocks."""
    path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    schema = pa.schema([("g", pa.string()), ("idx", pa.int64()), ("path", path),
                        ("subroot", pa.string()), ("root", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, block), (head, *rows) in _groups(batches):
            levels = subtree([r["digest"] for r in rows], is_alone(block, len(rows)))
            out = []
            for i, row in enumerate(rows):
                own = [dict(zip(("left", "right"), p.siblings(s))) for p, s in _local(levels, i)]
                out.append({"g": g, "idx": row["idx"], "path": own + head["path"],
                            "subroot": head["subroot"], "root": head["root"]})
            for a in range(0, len(out), 512):
                yield _emit(out[a:a + 512], schema)

    return _above(paths, nodes, []).mapInArrow(run, _PATHS)


# --- manifest -----------------------------------------------------------------
def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(text: Column | None = None) -> Column:
    """The leaf of a documents row, with another text if one is given."""
    values = [F.col(c) if c != "text" or text is None else text for c in FIELDS]
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def tampered() -> Column:
    """True where 5 divides the unsigned CRC-32 of the decimal doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Positions from 0 within each tree (the column idx)."""
    return stored(distributed_row_number(rows, group, order, "idx", "bigint")
                  .withColumn("idx", F.col("idx") - 1), "manifest-positions")


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified (see the module's text)."""
    spark = docs.sparkSession
    changed = leaf_of(F.translate("text", UPPER, UPPER.lower()))
    schema = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
              "folded_root string, verified boolean")
    leaves = stored(docs.select(
        F.col("source").alias("g"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf_of().alias("digest"),
        F.when(tampered(), changed).alias("changed")), "manifest-leaves")
    leaves = _numbered(leaves, "g", [F.asc_nulls_first("doc_id"), F.asc("digest")])
    trees = _levels(leaves)

    # The tree over the sources: its nodes are numbered in their order.
    subroots = trees[-1].select(F.col("g").alias("source"), "digest", F.lit("").alias("g"))
    subroots = _numbered(subroots, "g", [F.asc_nulls_first("source")])
    over = _levels(subroots)
    root = over[-1].first()  # one row
    if root is None:
        return spark.createDataFrame([], schema)
    paths = spark.createDataFrame([("", 0, [], None, root["digest"])], _PATHS)
    for nodes in reversed(over):
        paths = stored(_down(paths, nodes), "manifest-paths")
    paths = (paths.drop("subroot").join(subroots.select("idx", "source", F.col("digest").alias("subroot")), "idx")
             .select(F.col("source").alias("g"), F.lit(0).cast("bigint").alias("idx"), "path", "subroot", "root"))
    for nodes in reversed(trees[1:]):
        paths = stored(_down(paths, nodes), "manifest-paths")

    out = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in
                     ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, block), (head, *rows) in _groups(batches):
            levels = subtree([r["digest"] for r in rows], is_alone(block, len(rows)))
            above = [(hashlib.sha256(p["left"].encode()), p["right"]) for p in head["path"]]
            shared = "".join(p["left"] + p["right"] for p in head["path"]).encode()
            found = []
            for i, row in enumerate(rows):
                proof, now = hashlib.sha256(), row["changed"] or row["digest"]
                for parent, slot in _local(levels, i):
                    proof.update("".join(parent.siblings(slot)).encode())
                    now = parent.fold(slot, now)
                proof.update(shared)
                for state, right in above:
                    now = resume(state, now, right)
                found.append({"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": head["subroot"], "root": head["root"],
                              "proof_sha256": proof.hexdigest(), "folded_root": now, "verified": now == head["root"]})
            yield _emit(found, out)

    return _above(paths, leaves, [F.col("doc_id"), F.col("changed")]).mapInArrow(fold, schema)
