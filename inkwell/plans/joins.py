"""Joins between data that grows with the corpus and a workload.

One plan whatever the sizes: the planner broadcasts the smaller side if its
own estimate (a local table, a stored file) is below the session's broadcast
threshold, and adaptive execution does so at run time.  If neither does, the
salt spreads each key of the large side over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tasks a single key of the large side is spread over in a shuffled join.
SALTS = 16


def _salted(large: DataFrame, small: DataFrame, spread_by: str, salts: int) -> tuple[DataFrame, DataFrame]:
    return (large.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")),
            small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))


def salted_join(large: DataFrame, small: DataFrame, on: list[str], spread_by: str,
                salts: int = SALTS, shuffled: bool = False) -> DataFrame:
    """Inner equi-join on the columns ``on``; the salt is taken from the large
    side's column ``spread_by``, the small side is repeated per salt.  With
    ``shuffled`` it is never broadcast (for a side that grows with the corpus, of
    which the planner does not see that it is repeated)."""
    a, b = _salted(large, small, spread_by, salts)
    return a.join(b.hint("merge") if shuffled else b, [*on, "_salt"]).drop("_salt")


def every_pair(large: DataFrame, small: DataFrame, spread_by: str, salts: int = SALTS) -> DataFrame:
    """Every row of ``large`` with every row of ``small``: for queries that
    return all documents, where the pairs are the result."""
    return salted_join(large, small, [], spread_by, salts)


# Ids per bit mask.
_ID_BITS = 6


def _marked(rows: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    number = F.col(id_col).cast("bigint")
    block = F.shiftright(number, _ID_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND((1 << _ID_BITS) - 1).cast("int"))
    masks = ids.filter(F.col(id_col).isNotNull()).groupBy(block.alias("_block")).agg(F.bit_or(bit).alias("_mask"))
    return (rows.withColumn("_block", block).join(F.broadcast(masks), "_block", how)
            .withColumn("_in", F.coalesce(F.col("_mask").bitwiseAND(bit) != 0, F.lit(False))).drop("_block", "_mask"))


def with_ids(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose bigint id is among ``ids``.  The ids travel as one mask of 64 bits
    per 64 numbers, never more rows than ids, to where the rows are: texts and
    postings are not shuffled, also if a list of the ids were too long for the planner
    to broadcast."""
    return _marked(rows, ids, id_col, "inner").filter("_in").drop("_in")


def without_ids(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose bigint id is not among ``ids`` (null ids stay), likewise."""
    return _marked(rows, ids, id_col, "left").filter("not _in").drop("_in")
