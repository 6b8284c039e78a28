"""Words used in similar contexts (distributional similarity).

For a word w: its contexts are the (previous, next) term pairs around its
first occurrence in each document.  Each context picks an anchor (the
previous term if it occurs and is longer than the next, else the next
term); at the anchor's first occurrence in every document the term between
it and the other context term is a candidate.  Candidates are counted.
``mode="all"`` uses every occurrence instead of first occurrences.

Neighbour terms are read from each document's term array beside the exploded
place and first occurrences come from a sort inside it: narrow maps over the
input splits.  The contexts of the asked words are found and stored first; the
planner then knows their size, and only rows that meet one of them leave
their task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import begins_run, exploded, offset_of, placed_terms, with_terms
from inkwell.operators.postings import term_counts
from inkwell.session import stored, write_parquet

PAGE_SIZE = 10
# Hash buckets of (pre, post) that stored frames are kept in and looked up by.
FRAME_BUCKETS = 16
# Fixed value: a candidate is listed only if it has a character other than a digit.
NON_NUMERIC = r"[^0-9]"


def _around(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, pos, wpos, term, prev2, prev1, next1, next2) of rows with a place
    ``pos`` in a document's terms, read from the array beside it."""
    near = [F.get("_t", F.col("pos") + k).alias(name)
            for k, name in ((-2, "prev2"), (-1, "prev1"), (1, "next1"), (2, "next2"))]
    return rows.select(*keep, "pos", offset_of().alias("wpos"), "term", *near)


def neighbours(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every term position with the terms 1 and 2 before and after."""
    d = with_terms(docs, "doc_id", text_col=text_col)
    return _around(exploded(d, "doc_id", "_t", "_w"), "doc_id")


def first_occurrence_contexts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """W1 with neighbours: the first occurrence of each term in each document
    (sort by (term, pos) inside the row, the head of each run of equal terms)."""
    d = with_terms(docs, "doc_id", text_col=text_col)
    d = d.select("*", placed_terms().alias("_s"))
    rows = exploded(d, "doc_id", "_t", "_w", "_s", array="_s", pos="_k", value="_head")
    rows = rows.filter(begins_run("_s", "_k", lambda x: x["term"]))
    return _around(rows.select("doc_id", "_t", "_w", "_head.term", "_head.pos"), "doc_id")


def first_occurrence(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, term, pos, wpos) of the first occurrence per document."""
    return first_occurrence_contexts(docs, text_col).select("doc_id", "term", "pos", "wpos")


def _asked(words: DataFrame, name: str) -> DataFrame:
    """The distinct asked words as column ``name``, stored: the planner knows how
    few they are and meets them where the occurrences are.  Of a frame whose size it
    does not know it expects the worst, and every occurrence would be shuffled."""
    return stored(words.select(F.col("word").alias(name)).distinct(), "asked-words")


def word_contexts(docs: DataFrame, words: DataFrame, mode: str = "first") -> DataFrame:
    """Distinct (word, pre, post) around the word (first occurrence per
    document, or every occurrence); document edges have no pair."""
    src = first_occurrence_contexts(docs) if mode == "first" else neighbours(docs)
    return (src.join(_asked(words, "term"), "term")
            .filter(F.col("prev1").isNotNull() & F.col("next1").isNotNull())
            .select(F.col("term").alias("word"), F.col("prev1").alias("pre"),
                    F.col("next1").alias("post")).distinct())


def context_anchors(contexts: DataFrame, stats: DataFrame) -> DataFrame:
    """anchor = pre if it occurs and is longer than post, else post;
    contexts where neither occurs are skipped."""
    cf = stats.select("term", "cf")
    pre_cf = cf.select(F.col("term").alias("pre"), F.col("cf").alias("pre_cf"))
    post_cf = cf.select(F.col("term").alias("post"), F.col("cf").alias("post_cf"))
    c = (contexts.join(pre_cf, "pre", "left").join(post_cf, "post", "left")
         .withColumn("pre_cf", F.coalesce("pre_cf", F.lit(0)))
         .withColumn("post_cf", F.coalesce("post_cf", F.lit(0)))
         .filter((F.col("pre_cf") > 0) | (F.col("post_cf") > 0)))
    use_pre = (F.col("pre_cf") > 0) & (F.length("pre") > F.length("post"))
    return c.select("word", "pre", "post",
                    F.when(use_pre, F.col("pre")).otherwise(F.col("post")).alias("anchor"),
                    F.when(use_pre, F.lit("pre")).otherwise(F.lit("post")).alias("side"))


def similar_candidates(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """One row per (context, document) where the anchor's first occurrence
    is followed (pre side) or preceded (post side) by the other context term
    at distance 2; the word in between is the candidate (not the word itself).

    Each first occurrence is offered once per side (pre: other = next2,
    candidate = next1; post: other = prev2, candidate = prev1), so one
    equi-join on (anchor, side, other) serves both sides in a single pass.
    The anchors are stored first: first occurrences of other terms are
    dropped by a semi-join before they are doubled, both with a side whose
    size the planner knows."""
    a = stored(anchors.select("word", "pre", "post", "side", F.col("anchor").alias("term"),
                              F.when(F.col("side") == "pre", F.col("post"))
                              .otherwise(F.col("pre")).alias("other")), "anchors")
    occ = first_occurrence_contexts(docs).join(a.select("term").distinct(), "term", "left_semi")
    sides = occ.select("doc_id", "term", F.inline(F.array(
        F.struct(F.lit("pre").alias("side"), F.col("next2").alias("other"),
                 F.col("next1").alias("candidate")),
        F.struct(F.lit("post").alias("side"), F.col("prev2").alias("other"),
                 F.col("prev1").alias("candidate")))))
    return (sides.join(a.hint("shuffle_hash"), ["term", "side", "other"])
            .filter(F.col("candidate") != F.col("word"))
            .select("word", "pre", "post", "side", "doc_id", "candidate"))


def similar_words(docs: DataFrame, words: DataFrame, stats: DataFrame | None = None,
                  mode: str = "first") -> DataFrame:
    """(word, candidate, n) counts of words seen in the word's contexts."""
    if mode == "first":
        if stats is None:
            from inkwell.operators.postings import build_postings
            stats = term_counts(build_postings(docs)).groupBy("term").agg(
                F.sum("tf").alias("cf"))
        anchors = context_anchors(word_contexts(docs, words, "first"), stats)
        cand = similar_candidates(docs, anchors)
        return cand.groupBy("word", "candidate").agg(F.count("*").alias("n"))
    if mode != "all":
        raise ValueError(f"unknown mode {mode!r}")
    # The word's contexts first (stored, so their size is known); then only
    # trigrams in one of them are counted.
    tri = neighbours(docs).select(F.col("prev1").alias("pre"), F.col("next1").alias("post"),
                                  F.col("term").alias("candidate")).dropna(subset=["pre", "post"])
    ctx = stored(tri.join(_asked(words, "candidate"), "candidate").select(F.col("candidate").alias("word"), "pre", "post")
                 .distinct(), "contexts")
    # Contexts grow with the corpus: shuffled, not broadcast; one exchange serves both joins.
    counts = (tri.join(ctx.select("pre", "post").hint("shuffle_hash"), ["pre", "post"], "left_semi")
              .groupBy("pre", "post", "candidate").agg(F.count("*").alias("n")))
    hits = counts.join(ctx.hint("shuffle_hash"), ["pre", "post"]).filter(F.col("candidate") != F.col("word"))
    return hits.groupBy("word", "candidate").agg(F.sum("n").alias("n"))


def frames(docs: DataFrame, *keys: str) -> DataFrame:
    """(keys, pre, post, word, n): how often a word stands between two others, one row
    per place.  Additive: rows of one frame and word are added up when they are looked
    up, frames of deltas are appended and those of removed documents subtracted."""
    carried = F.struct(*keys) if keys else F.lit(0)
    rows = neighbours(docs.select(carried.alias("doc_id"), "text")).filter(
        F.col("prev1").isNotNull() & F.col("next1").isNotNull())
    return rows.select(*[F.col(f"doc_id.{k}").alias(k) for k in keys], F.col("prev1").alias("pre"),
                       F.col("next1").alias("post"), F.col("term").alias("word"), F.lit(1).cast("bigint").alias("n"))


def write_frames(rows: DataFrame, path: str) -> None:
    """Frames by the bucket of (pre, post), sorted by frame, so that equal ones lie side
    by side and cost little.  Each task writes its own rows: no frame is shuffled."""
    bucket = F.pmod(F.xxhash64("pre", "post"), F.lit(FRAME_BUCKETS)).cast("int")
    rows = rows.withColumn("frame_bucket", bucket).sortWithinPartitions("frame_bucket", "pre", "post", "word")
    write_parquet(rows, path, "overwrite", "frame_bucket", plain=("pre",))


def similar_in_frames(rows: DataFrame, words: DataFrame) -> DataFrame:
    """W7 from frames (with signed counts, if some were removed): no text is
    read.  The asked words' frames are found first; of the others only those
    that share one are paired.  Stored frames are taken bucket by bucket, whose
    shuffle files go before those of the next come."""
    asked = _asked(words, "word")
    if "frame_bucket" not in rows.columns:
        return _similar_in_frames(rows, asked)
    hits = [stored(_similar_in_frames(rows.filter(F.col("frame_bucket") == b), asked), "similar")
            for b in range(FRAME_BUCKETS)]
    return reduce(DataFrame.unionByName, hits).groupBy("word", "candidate").agg(F.sum("n").alias("n"))


def _similar_in_frames(rows: DataFrame, asked: DataFrame) -> DataFrame:
    own = stored(rows.join(asked, "word", "left_semi").groupBy("word", "pre", "post").agg(F.sum("n").alias("n"))
                 .filter("n > 0").select("word", "pre", "post"), "contexts")
    # The contexts of a frequent word grow with the corpus: shuffled, never gathered on the
    # driver for a broadcast.  Rows of no context are dropped before the others are added up.
    near = (rows.join(own.select("pre", "post").hint("shuffle_hash"), ["pre", "post"], "left_semi")
            .groupBy("pre", "post", "word").agg(F.sum("n").alias("n")).filter("n > 0")
            .withColumnRenamed("word", "candidate"))
    hits = near.join(own.hint("shuffle_hash"), ["pre", "post"]).filter("candidate <> word")
    return hits.groupBy("word", "candidate").agg(F.sum("n").alias("n"))


def similar_report(similar: DataFrame, page_no: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """Candidates with a non-digit character, by count desc then word,
    one page per query word (window group limit keeps it bounded per task)."""
    w = Window.partitionBy("word").orderBy(F.desc("n"), F.asc("candidate"))
    lo, hi = (page_no - 1) * size, page_no * size
    return (similar.filter(F.col("candidate").rlike(NON_NUMERIC))
            .withColumn("rank", F.row_number().over(w))
            .filter((F.col("rank") > lo) & (F.col("rank") <= hi)))
