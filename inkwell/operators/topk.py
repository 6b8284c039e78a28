"""Q13 with bounds: pages of ranked search without scoring all that matches.

A phrase of one word occurs tf times in a document; a longer one at most as
often as its words allow (tf - m + 1 of a word that it holds m times, the least
over its words), and not at all if a word is missing.  So term counts alone, one
row per document and word, give every (query, document) a greatest and a least
score, and candidates already hold all words of a phrase, the rarest included.

Positions are read for candidates only:

1. the documents of the greatest possible scores, ``PROBES`` times as many as the
   page reaches to, are scored; the page's last place among them, or among the least
   scores, is a floor for the page;
2. documents whose greatest score lies below the floor are dropped, the others
   scored; a phrase is matched once, whatever the number of queries;
3. locations are looked up for the page's rows alone.

Ties with the floor stay, so a page equals the full ranking's page.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.postings import DEFAULT_TERM_BUCKETS, Index, term_bucket, term_counts
from inkwell.operators.search import (ID_BLOCK, PAGE_SIZE, _first_key, _location, _matched, _negation_only_ids,
                                      complement_page, explode_query_terms, page, term_hits)
from inkwell.plans.joins import salted_join
from inkwell.session import stored

# Documents scored for the floor, per place up to the page's last.  More give a
# higher floor; the page is the same.
PROBES = 20


def _uses(query_terms: DataFrame) -> DataFrame:
    """(query_id, term_no, negated, n_words, phrase, words) per query term."""
    uses = query_terms.groupBy("query_id", "term_no").agg(
        F.first("negated").alias("negated"), F.first("n_words").alias("n_words"),
        F.transform(F.array_sort(F.collect_list(F.struct("offset", "word"))), lambda w: w["word"]).alias("words"))
    return stored(uses.withColumn("phrase", F.concat_ws(" ", "words")), "bounded-uses")


def _asked(index: Index, words: DataFrame) -> Index:
    """The postings and counts of the asked words.  An index that holds no
    counts is read once and its postings of these words stored."""
    if index.counts is not None:
        return Index(index.docs, index.postings, index.buckets, index.counts)
    words = words.select(F.col("word").alias("term")).distinct()
    parts = index.postings if isinstance(index.postings, list) else [index.postings]
    if "term_bucket" in parts[0].columns:
        words = words.withColumn("term_bucket", term_bucket("term", index.buckets or DEFAULT_TERM_BUCKETS))
    on = [c for c in ("term", "term_bucket") if c in words.columns]
    rows = reduce(DataFrame.unionByName, [salted_join(p, words, on, "doc_id") for p in parts])
    rows = stored(rows.select("doc_id", "pos", "wpos", "term"), "asked-postings")
    return Index(index.docs, rows, None, term_counts(rows))


def phrase_caps(counts: DataFrame, uses: DataFrame) -> DataFrame:
    """(phrase, doc_id, cap): most occurrences of a phrase that the counts of its
    words admit, in documents that hold all of them; exact for single words."""
    words = (uses.select("phrase", "words").distinct()
             .select("phrase", F.size(F.array_distinct("words")).alias("n_distinct"), F.explode("words").alias("term"))
             .groupBy("phrase", "n_distinct", "term").agg(F.count("*").alias("times")))
    met = salted_join(counts.select("doc_id", "term", "tf"), words, ["term"], "doc_id")
    return (met.groupBy("phrase", "doc_id")
            .agg(F.count("*").alias("k"), F.first("n_distinct").alias("n_distinct"),
                 F.min(F.col("tf") - F.col("times") + 1).alias("cap"))
            .filter("k = n_distinct and cap > 0").select("phrase", "doc_id", "cap"))


def score_bounds(caps: DataFrame, uses: DataFrame) -> DataFrame:
    """(query_id, doc_id, most, least) of documents that may be results.
    ``least`` is 0 where a negated phrase may exclude the document."""
    rows = salted_join(caps, uses.select("phrase", "query_id", "negated", "n_words"), ["phrase"], "doc_id")
    sure, points = F.col("n_words") == 1, F.col("cap") * F.col("n_words")
    positive = ~F.col("negated")
    agg = rows.groupBy("query_id", "doc_id").agg(
        F.sum(F.when(positive, points)).alias("most"),
        F.coalesce(F.sum(F.when(positive & sure, points)), F.lit(0)).alias("least"),
        F.bool_or(F.col("negated") & sure).alias("out"), F.bool_or(F.col("negated")).alias("maybe_out"))
    return agg.filter(~F.col("out") & F.col("most").isNotNull()).select(
        "query_id", "doc_id", "most", F.when(F.col("maybe_out"), 0).otherwise(F.col("least")).alias("least"))


def _last_of_top(rows: DataFrame, by: str, n: int) -> DataFrame:
    """(query_id, floor): the n-th greatest ``by``; no row for a query with fewer."""
    w = Window.partitionBy("query_id").orderBy(F.desc(by), F.asc("doc_id"))
    return (rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).filter(F.col("_r") == n)
            .select("query_id", F.col(by).alias("floor")))


def _scores(asked: Index, caps: DataFrame, uses: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) of the documents ``wanted`` (query_id, doc_id)
    that are results.  Only phrases of several words need positions."""
    pairs = wanted.join(uses.select("query_id", "phrase", "n_words", "words", "negated"), "query_id") \
        .join(caps, ["phrase", "doc_id"])
    long_ = uses.filter("n_words > 1").select("phrase", "n_words", "words").distinct()
    asked_of = stored(pairs.filter("n_words > 1").select("phrase", "doc_id").distinct(), "bounded-pairs")
    found = _occurrences(asked, long_, asked_of).groupBy("phrase", "doc_id").agg(F.count("*").alias("n"))
    n = pairs.join(found, ["phrase", "doc_id"], "left").withColumn(
        "n", F.when(F.col("n_words") == 1, F.col("cap")).otherwise(F.coalesce("n", F.lit(0))))
    agg = n.filter("n > 0").groupBy("query_id", "doc_id").agg(
        F.sum(F.when(~F.col("negated"), F.col("n") * F.col("n_words"))).cast("bigint").alias("score"),
        F.bool_or("negated").alias("out"))
    return agg.filter(~F.col("out") & F.col("score").isNotNull()).select("query_id", "doc_id", "score")


def _occurrences(asked: Index, phrases: DataFrame, docs_of: DataFrame) -> DataFrame:
    """(phrase, doc_id, start, wpos) of ``phrases`` in the documents that
    ``docs_of`` (phrase, doc_id) names for each."""
    terms = phrases.select(F.col("phrase").alias("query_id"), F.lit(0).alias("term_no"), F.lit(False).alias("negated"),
                           "n_words", F.posexplode("words").alias("offset", "word"))
    hits = term_hits(asked.postings, terms, asked.buckets).withColumnRenamed("query_id", "phrase")
    return (hits.join(docs_of, ["phrase", "doc_id"], "left_semi").groupBy("phrase", "doc_id", "start")
            .agg(F.count("*").alias("k"), F.first("n_words").alias("n_words"), F.min("wpos").alias("wpos"))
            .filter("k = n_words"))


def candidates(index: Index, query_terms: DataFrame, hi: int) -> tuple[Index, DataFrame, DataFrame, DataFrame, DataFrame]:
    """The asked part of the index, the uses, phrase caps, score bounds and the
    (query_id, doc_id) that can be among a query's first ``hi`` results."""
    uses = _uses(query_terms)
    asked = _asked(index, query_terms)
    caps = stored(phrase_caps(asked.counts, uses), "phrase-caps")
    bounds = stored(score_bounds(caps, uses), "score-bounds")
    w = Window.partitionBy("query_id").orderBy(F.desc("most"), F.asc("doc_id"))
    first = bounds.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= PROBES * hi).select("query_id", "doc_id")
    floors = _last_of_top(_scores(asked, caps, uses, stored(first, "most-likely")), "score", hi).unionByName(
        _last_of_top(bounds, "least", hi)).groupBy("query_id").agg(F.max("floor").alias("floor"))
    kept = bounds.join(stored(floors, "page-floors"), "query_id", "left").filter(
        F.col("most") >= F.coalesce("floor", F.lit(0))).select("query_id", "doc_id")
    return asked, uses, caps, bounds, stored(kept, "page-candidates")


def bounded_page(index: Index, queries: DataFrame, page_no: int = 1, size: int = PAGE_SIZE,
                 block: int = ID_BLOCK) -> DataFrame:
    """Q13: the rows of ``search_page``: (query_id, doc_id, score, location, rank).
    Queries without positive terms are cut from the ordered ids, as there."""
    query_terms = explode_query_terms(queries)
    ids = _negation_only_ids(queries, query_terms)
    asked, uses, caps, _, kept = candidates(
        index, query_terms.join(ids, "query_id", "left_anti"), page_no * size)
    top = stored(page(_scores(asked, caps, uses, kept), page_no, size), "page-rows")
    # Locations: the first occurrence of the first positive term that occurs.
    shown = top.select("query_id", "doc_id").join(uses.filter(~F.col("negated")), "query_id")
    docs_of = stored(shown.select("phrase", "doc_id").distinct(), "page-phrases")
    at = (_occurrences(asked, uses.filter(~F.col("negated")).select("phrase", "n_words", "words").distinct(), docs_of)
          .groupBy("phrase", "doc_id").agg(F.min("wpos").alias("wpos")))
    located = shown.join(at, ["phrase", "doc_id"]).groupBy("query_id", "doc_id").agg(
        F.min(_first_key("term_no", "wpos")).alias("first_key"))
    hits = top.join(located, ["query_id", "doc_id"]).select(
        "query_id", "doc_id", "score", _location("first_key").alias("location"), "rank")
    excluded = _matched(index, query_terms.join(ids, "query_id", "left_semi")) \
        .filter("neg = 1").select("query_id", "doc_id")
    others = complement_page(index.all_docs(), ids, excluded, page_no, size, block).select(
        "query_id", "doc_id", F.lit(1).cast("bigint").alias("score"), F.lit(0).alias("location"), "rank")
    return hits.unionByName(others)


def page_work(index: Index, queries: DataFrame, page_no: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """(query_id, n_possible, n_scored): documents that may match a query with
    positive terms, and those that its page needs scored."""
    terms = explode_query_terms(queries)
    terms = terms.join(_negation_only_ids(queries, terms), "query_id", "left_anti")
    _, _, _, bounds, kept = candidates(index, terms, page_no * size)
    possible = bounds.groupBy("query_id").agg(F.count("*").alias("n_possible"))
    return possible.join(kept.groupBy("query_id").agg(F.count("*").alias("n_scored")), "query_id", "left").select(
        "query_id", "n_possible", F.coalesce("n_scored", F.lit(0)).cast("bigint").alias("n_scored"))
