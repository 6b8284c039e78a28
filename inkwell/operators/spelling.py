"""Spelling suggestions mined from a query log.

Within a session, when a single-word query follows another single-word query
at edit distance <= 3 and the new word is at least twice as frequent in the
index (previous / current <= 0.5), the pair is recorded as a correction of
the previous word (a later pair for the same word overwrites it).  Each query
is then offered the latest correction recorded up to that point in its
session for exactly its text.

All steps are as-of lookups within a session (see ``plans.asof``): no
self-join of a session with itself, no whole session in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import normalize_term
from inkwell.plans.asof import last_value_before
from inkwell.session import stored

# Fixed values of the suggestion rule.
MAX_DISTANCE = 3
RATIO = 0.5


def is_single_word(q) -> F.Column:
    """Single word: no space and not starting with '!'."""
    col = F.col(q) if isinstance(q, str) else q
    return ~col.contains(" ") & ~col.startswith("!")


def _earliest(df: DataFrame, *cols: F.Column) -> DataFrame:
    """Rows that precede all rows of a log: no ts, and a sequence below theirs."""
    return df.select("session_id", *cols, F.lit(None).cast("bigint").alias("ts"), F.lit(-1).alias("_seq"))


def previous_query(log: DataFrame, bucket_width: int | None = None, last: DataFrame | None = None) -> DataFrame:
    """(session_id, ts, query, prev): the latest earlier single-word query
    of the session (multi-word queries are skipped, not resets).  ``last``
    (session_id, prev) holds what came before the log."""
    d = log.select("session_id", "ts", "query", F.lit(0).alias("_seq"),
                   F.when(is_single_word("query"), F.col("query")).alias("_single"))
    if last is not None:
        d = d.unionByName(_earliest(last, F.lit(None).cast("string").alias("query"), F.col("prev").alias("_single")))
    return last_value_before(d, ["session_id"], "ts", "_seq", "_single", "prev",
                             bucket_width).filter("_seq = 0").select("session_id", "ts", "query", "prev")


def _cf(stats: DataFrame, name: str) -> DataFrame:
    return stats.select(F.col("term").alias(f"{name}_term"), F.col("cf").alias(f"{name}_cf"))


def dominates(pairs: DataFrame, stats: DataFrame, ratio: float = RATIO) -> DataFrame:
    """Add ``dominates``: the current word occurs and prev_cf / cur_cf <=
    ratio; false without a previous word.  Frequencies by left joins to the
    term statistics (the vocabulary side is shuffled or broadcast by AQE)."""
    p = (pairs.withColumn("prev_term", normalize_term("prev"))
         .withColumn("cur_term", normalize_term("query"))
         .join(_cf(stats, "prev"), "prev_term", "left")
         .join(_cf(stats, "cur"), "cur_term", "left"))
    prev_cf = F.coalesce("prev_cf", F.lit(0))
    cur_cf = F.coalesce("cur_cf", F.lit(0))
    dom = (F.col("prev").isNotNull() & (F.col("prev") != "") & (cur_cf > 0)
           & (prev_cf <= F.lit(ratio) * cur_cf))
    return p.withColumn("dominates", dom).withColumn("prev_cf", prev_cf).withColumn(
        "cur_cf", cur_cf).drop("prev_term", "cur_term")


def mine_corrections(log: DataFrame, stats: DataFrame, max_distance: int = MAX_DISTANCE,
                     ratio: float = RATIO, bucket_width: int | None = None,
                     last: DataFrame | None = None) -> DataFrame:
    """(session_id, ts, word, correction, distance) recorded corrections."""
    pairs = previous_query(log, bucket_width, last).filter(
        is_single_word("query") & F.col("prev").isNotNull())
    pairs = pairs.withColumn("distance", F.levenshtein("prev", "query", max_distance))
    pairs = pairs.filter((F.col("distance") >= 0))
    return dominates(pairs, stats, ratio).filter("dominates").select(
        "session_id", "ts", F.col("prev").alias("word"), F.col("query").alias("correction"),
        "distance")


def latest_corrections(corrections: DataFrame) -> DataFrame:
    """The last correction per (session, word) (later pairs overwrite)."""
    return corrections.groupBy("session_id", "word").agg(
        F.max(F.struct("ts", "correction")).alias("m")).select(
        "session_id", "word", F.col("m.correction").alias("correction"),
        F.col("m.ts").alias("ts"))


def suggest(log: DataFrame, stats: DataFrame, max_distance: int = MAX_DISTANCE,
            ratio: float = RATIO, bucket_width: int | None = None) -> DataFrame:
    """P5: (session_id, ts, query, suggestion) for queries with a correction
    recorded at or before them in the session for exactly their text."""
    return _offered(log, mine_corrections(log, stats, max_distance, ratio, bucket_width), None, bucket_width)


def suggest_with(log: DataFrame, stats: DataFrame, last: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P5 for a log that goes on from an earlier one: (suggestions, corrections
    recorded in it), given each session's last single-word query (session_id,
    prev) and the corrections known so far (session_id, word, correction)."""
    mined = stored(mine_corrections(log, stats, last=last), "mined-corrections")
    return _offered(log, mined, known), mined


def _offered(log: DataFrame, corr: DataFrame, known: DataFrame | None = None,
             bucket_width: int | None = None) -> DataFrame:
    no_query = F.lit(None).cast("string").alias("query")
    events = corr.select("session_id", F.col("word").alias("key"), "ts", F.lit(0).alias("_seq"),
                         F.col("correction").alias("_value"), no_query)
    if known is not None:
        events = events.unionByName(_earliest(known, F.col("word").alias("key"), F.col("correction").alias("_value"), no_query))
    asks = log.select("session_id", F.col("query").alias("key"), "ts", F.lit(1).alias("_seq"),
                      F.lit(None).cast("string").alias("_value"), "query")
    merged = last_value_before(events.unionByName(asks), ["session_id", "key"], "ts", "_seq",
                               "_value", "suggestion", bucket_width)
    return merged.filter((F.col("_seq") == 1) & F.col("suggestion").isNotNull()).select(
        "session_id", "ts", "query", "suggestion")
