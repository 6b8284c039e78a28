"""Edit distance columns.

Unit costs use Spark's built-in ``levenshtein`` (JVM side, optional cutoff).
Weighted costs [match, indel, mismatch] have no built-in; the table is computed
with folds over character arrays, also on the JVM side.  ``weighted_distance``
is the same for two Python strings (the suggestion stream, tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: default costs [match, insertion/deletion, mismatch].
DEFAULT_COSTS = (0, 1, 1)
GAP = "-"


def edit_distance(a, b, max_distance: int | None = None) -> Column:
    """Unit-cost distance; with ``max_distance`` values above it are -1."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    if max_distance is None:
        return F.levenshtein(ca, cb)
    return F.levenshtein(ca, cb, max_distance)


def weighted_distance(s: str, t: str, costs=DEFAULT_COSTS, hyphen: str = "plain",
                      weight: Callable[[str, str], int] | None = None) -> int:
    """Weighted edit distance of two strings (dynamic programming over prefixes).

    ``hyphen="gap"`` treats '-' as the gap symbol of the cost function: a
    real hyphen inserted or deleted costs the match cost, and a hyphen
    against another character costs an indel.  The first row and column
    always cost ``indel`` per character.  ``weight(x, y)`` replaces the cost
    function; '-' on one side then stands for a deletion or an insertion.
    """
    match, indel, mismatch = costs
    n, m = len(s), len(t)
    if n == 0:
        return m * indel
    if m == 0:
        return n * indel
    gap = hyphen == "gap"

    def w(x: str, y: str) -> int:
        if weight:
            return weight(x, y)
        if x == y:
            return match
        if gap and (x == GAP or y == GAP):
            return indel
        return mismatch

    named = gap or weight is not None  # '-' is the gap symbol
    del_cost = [w(c, GAP) if named else indel for c in s]
    ins_cost = [w(GAP, c) if named else indel for c in t]
    prev = [j * indel for j in range(m + 1)]
    for i in range(1, n + 1):
        cur = [i * indel] + [0] * m
        si = s[i - 1]
        for j in range(1, m + 1):
            cur[j] = min(prev[j] + del_cost[i - 1], cur[j - 1] + ins_cost[j - 1],
                         prev[j - 1] + w(si, t[j - 1]))
        prev = cur
    return prev[m]


def weighted_edit_distance(a, b, costs=DEFAULT_COSTS, hyphen: str = "plain",
                           weight: Callable[[Column, Column], Column] | None = None) -> Column:
    """Weighted distance column (null when either side is null).

    ``weighted_distance`` as nested folds over character arrays: the outer
    one carries a row of the table, the inner one builds the next row.
    ``weight(x, y)`` is a column expression over two characters that replaces
    the cost function (E4); the literal '-' on one side stands for a deletion
    or an insertion.  The first row and column keep the indel cost."""
    match, indel, mismatch = (F.lit(int(c)).cast("bigint") for c in costs)
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    gap = hyphen == "gap"

    def chars(c):
        return F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))

    def deleted(x):
        if weight:
            return weight(x, F.lit(GAP)).cast("bigint")
        return F.when(x == GAP, match).otherwise(indel) if gap else indel

    def inserted(y):
        return weight(F.lit(GAP), y).cast("bigint") if weight else deleted(y)

    def pair_cost(x, y):
        if weight:
            return weight(x, y).cast("bigint")
        out = F.when(x == y, match)
        if gap:
            out = out.when((x == GAP) | (y == GAP), indel)
        return out.otherwise(mismatch)

    def next_row(state, x):
        # The inner fold carries (previous cell, row so far).
        row, first = state["row"], state["row"][0] + indel
        start = F.array(first)
        cells = F.aggregate(
            F.sequence(F.lit(0), F.size(state["other"]) - 1),
            start,
            lambda cur, j: F.array_append(cur, F.least(
                F.get(row, j + 1) + deleted(x),
                F.element_at(cur, -1) + inserted(F.get(state["other"], j)),
                F.get(row, j) + pair_cost(x, F.get(state["other"], j)))))
        return F.struct(cells.alias("row"), state["other"].alias("other"))

    first_row = F.transform(F.sequence(F.lit(0), F.length(cb)), lambda j: j.cast("bigint") * indel)
    full = F.aggregate(chars(ca), F.struct(first_row.alias("row"), chars(cb).alias("other")), next_row,
                       lambda s: F.element_at(s["row"], -1))
    return (F.when(ca.isNull() | cb.isNull(), F.lit(None).cast("bigint"))
            .when(F.length(cb) == 0, F.length(ca).cast("bigint") * indel)
            .otherwise(full))
