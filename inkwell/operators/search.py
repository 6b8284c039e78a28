"""Ranked search over a positional index, as a workload of many queries.

Plan shape (one Spark job for the whole workload):

* query terms are joined to postings on the word (and term bucket for a stored
  index, so partitions are pruned) through a salt: the planner broadcasts the
  terms if they are small by its own estimate, and if not, a stop word is
  spread over the salts instead of being one hot key;
* a phrase is matched once, however many queries ask for it: relational
  division of its hits, grouped by (phrase, doc, start), folded to one row per
  (phrase, doc) behind the same exchange; single words are the n = 1 case;
* phrases of three words and more are met by their rarest word only; its few
  candidates then look up the other words by (doc, pos), so that a passage's
  frequent words are not joined with all of their postings;
* those rows fan out to the queries' terms, and one aggregation by (query, doc)
  yields score, first location and the "hit a negated term" flag together, so
  negation needs no extra join;
* queries without positive terms (negation-only or empty) return every document
  that is not excluded; a page of them is cut from the ordered ids by counts of
  exclusions per block of ids, without holding queries x documents rows.

Only hits are shuffled, never texts or whole postings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import fold_stops, normalize_term, snippet_of, split_words
from inkwell.operators.postings import DEFAULT_TERM_BUCKETS, Index, term_bucket
from inkwell.plans.joins import every_pair, salted_join
from inkwell.plans.ranking import distributed_row_number
from inkwell.session import stored

# Fixed values of the query syntax.
NEGATED_PHRASE = r'!"(.+?)"'
PHRASE = r'"(.+?)"'
PAGE_SIZE = 10
QUERY_KINDS = ["empty", "negated", "mixed", "phrase", "words", "word"]
# Ids per block when a page is cut from the ordered ids.
ID_BLOCK = 1024
# Phrases of as many words or more are found by their rarest word.
LONG_PHRASE = 3


def explode_query_terms(queries: DataFrame, query_col: str = "query") -> DataFrame:
    """Q1: (query_id, term_no, negated, n_words, offset, word) per query word.

    Term order: negated phrases, then phrases, then whitespace words.  Any
    '!' in a term negates it and is removed.  Words are normalised like index
    terms; terms left without words are dropped.
    """
    q = F.coalesce(F.col(query_col), F.lit(""))
    neg = F.regexp_extract_all(q, F.lit(NEGATED_PHRASE), 1)
    rest = F.regexp_replace(q, NEGATED_PHRASE, "")
    phr = F.regexp_extract_all(rest, F.lit(PHRASE), 1)
    rest = F.regexp_replace(rest, PHRASE, "")
    raw = F.concat(F.transform(neg, lambda x: F.concat(F.lit("!"), x)), phr,
                   F.split(rest, r"\s+"))
    terms = queries.select("query_id", F.posexplode(raw).alias("term_no", "raw"))
    terms = terms.select(
        "query_id", F.col("term_no").cast("int").alias("term_no"),
        F.col("raw").contains("!").alias("negated"),
        F.filter(F.transform(F.split(F.regexp_replace("raw", "!", ""), r"\s+"),
                             lambda w: normalize_term(w)),
                 lambda w: w != "").alias("words"))
    terms = terms.filter(F.size("words") > 0)
    return terms.select(
        "query_id", "term_no", "negated",
        F.size("words").cast("int").alias("n_words"),
        F.posexplode("words").alias("offset", "word")).select(
        "query_id", "term_no", "negated", "n_words",
        F.col("offset").cast("int").alias("offset"), "word")


def query_kinds(queries: DataFrame, query_terms: DataFrame) -> DataFrame:
    """(query_id, kind) of every query: empty, negated (nothing else), mixed
    (negated and positive terms), phrase, words or word."""
    terms = query_terms.filter(F.col("offset") == 0).groupBy("query_id").agg(
        F.count_if("negated").alias("n_neg"), F.count_if(~F.col("negated")).alias("n_pos"),
        F.max("n_words").alias("longest"))
    kind = (F.when(F.col("n_pos").isNull(), "empty").when(F.col("n_pos") == 0, "negated")
            .when(F.col("n_neg") > 0, "mixed").when(F.col("longest") > 1, "phrase")
            .when(F.col("n_pos") > 1, "words").otherwise("word"))
    return queries.select("query_id").distinct().join(terms, "query_id", "left").select("query_id", kind.alias("kind"))


def term_hits(postings: DataFrame | list[DataFrame], query_terms: DataFrame, buckets: int | None = None) -> DataFrame:
    """Q2: postings of every query word, tagged with the query term.  Postings
    of several segments are joined each on their own, so each prunes its buckets.

    A stored index is partitioned by term bucket (``buckets`` of them); the
    join then also matches the bucket so dynamic partition pruning reads
    only the query words' buckets."""
    if isinstance(postings, list):
        return reduce(DataFrame.unionByName, [term_hits(p, query_terms, buckets) for p in postings])
    qt = query_terms.select("query_id", "term_no", "negated", "n_words", "offset",
                            F.col("word").alias("term"))
    on = ["term"]
    if "term_bucket" in postings.columns:
        qt = qt.withColumn("term_bucket", term_bucket("term", buckets or DEFAULT_TERM_BUCKETS))
        on.append("term_bucket")
    return salted_join(postings, qt, on, spread_by="doc_id").select(
        "query_id", "term_no", "negated", "n_words", "doc_id",
        (F.col("pos") - F.col("offset")).alias("start"), "wpos")


def phrase_hits(postings: DataFrame | list[DataFrame] | None, query_terms: DataFrame, buckets: int | None = None,
                hits: DataFrame | None = None) -> DataFrame:
    """Q3: occurrences of every query term: (query, term, doc, start, start_wpos).

    Relational division: hits grouped by (query, term, doc, start) with one
    hit per phrase word form an occurrence (single words trivially; overlaps
    and repeated words included).  The key contains the start position, so a
    hot document or word is never one hot group.  ``hits`` are the term hits, if
    they are known.
    """
    if hits is None:
        query_terms, long = split_long(query_terms)
        hits = term_hits(postings, query_terms, buckets)
    else:
        long = None
    found = (hits
            .groupBy("query_id", "term_no", "doc_id", "start")
            .agg(F.count("*").alias("k"), F.first("n_words").alias("n_words"),
                 F.first("negated").alias("negated"), F.min("wpos").alias("start_wpos"))
            .filter(F.col("k") == F.col("n_words"))
            .select("query_id", "term_no", "negated", "n_words", "doc_id", "start", "start_wpos"))
    return found if long is None else found.unionByName(long_phrase_hits(postings, long, buckets))


def split_long(query_terms: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows of short phrases, stored rows of long ones or None).  A phrase is long
    if it has ``LONG_PHRASE`` words or more, each place once; others, such as
    those of an id that is given twice, are matched by division."""
    key = ["query_id", "term_no"]
    whole = (query_terms.groupBy(*key).agg(
        F.max("n_words").alias("n"), F.min("n_words").alias("least"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct("offset").alias("places"), F.max("offset").alias("last"))
        .filter((F.col("n") >= LONG_PHRASE) & (F.col("least") == F.col("n")) & (F.col("rows") == F.col("n"))
                & (F.col("places") == F.col("n")) & (F.col("last") == F.col("n") - 1)
                & F.col("query_id").isNotNull()).select(*key))
    long = stored(query_terms.join(whole, key, "left_semi"), "long-phrases")
    if long.isEmpty():
        return query_terms, None
    return query_terms.join(long.select(*key).distinct(), key, "left_anti"), long


def long_phrase_hits(postings: DataFrame | list[DataFrame], terms: DataFrame, buckets: int | None = None) -> DataFrame:
    """Q3 for long phrases: the hits of each phrase's rarest word, by counted
    frequency, are its candidates; their other words are looked up by (doc, pos).
    A phrase with a word that does not occur has no candidates."""
    parts = postings if isinstance(postings, list) else [postings]
    words = terms.select(F.col("word").alias("term")).distinct()
    if "term_bucket" in parts[0].columns:
        words = words.withColumn("term_bucket", term_bucket("term", buckets or DEFAULT_TERM_BUCKETS))
    on = words.columns

    def asked() -> DataFrame:
        """Postings of the phrases' words (few: the planner broadcasts them)."""
        return reduce(DataFrame.unionByName, [p.join(words, on, "left_semi").select("doc_id", "pos", "wpos", "term")
                                              for p in parts])

    key = ["query_id", "term_no"]
    frequency = asked().groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    rarest = (terms.join(frequency.withColumnRenamed("term", "word"), "word", "left")
              .groupBy(*key).agg(F.min(F.struct(F.coalesce("cf", F.lit(0)).alias("cf"), F.col("offset"))).alias("m"))
              .filter("m.cf > 0").select(*key, F.col("m.offset").alias("offset")))
    anchors = stored(terms.join(rarest, [*key, "offset"], "left_semi"), "anchors")
    candidates = stored(term_hits(postings, anchors, buckets).filter("start >= 0")
                        .select(*key, "negated", "n_words", "doc_id", "start").distinct(), "candidates")
    wanted = stored(candidates.join(terms.select(*key, "offset", F.col("word").alias("term")), key)
                    .withColumn("pos", (F.col("start") + F.col("offset")).cast("int")).drop("offset"), "wanted")
    near = asked().join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    return (near.join(wanted.hint("shuffle_hash"), ["doc_id", "pos", "term"])
            .groupBy(*key, "doc_id", "start")
            .agg(F.count("*").alias("k"), F.first("n_words").alias("n_words"),
                 F.first("negated").alias("negated"), F.min("wpos").alias("start_wpos"))
            .filter("k = n_words")
            .select(*key, "negated", "n_words", "doc_id", "start", "start_wpos"))


_WPOS_BITS = 32


def _first_key(term_no, wpos):
    """(term_no, wpos) packed in one bigint: its minimum is the first
    position of the first hitting term (a hash aggregate, unlike min(struct))."""
    return F.shiftleft(F.col(term_no).cast("bigint"), _WPOS_BITS) + F.col(wpos).cast("bigint")


def _location(first_key):
    return (F.col(first_key).bitwiseAND(F.lit((1 << _WPOS_BITS) - 1)) + 1).cast("int")


def _scored(occ: DataFrame) -> DataFrame:
    """Q4-Q8 in one aggregation by (query, doc)."""
    pos = ~F.col("negated")
    return occ.groupBy("query_id", "doc_id").agg(
        F.sum(F.when(pos, F.col("n_words"))).cast("bigint").alias("score"),
        F.min(F.when(pos, _first_key("term_no", "start_wpos"))).alias("first_key"),
        F.max(F.col("negated").cast("int")).alias("neg"))


def disjunction(index: Index, query_terms: DataFrame) -> DataFrame:
    """Q4: documents matching any positive term (before negation)."""
    s = _scored(phrase_hits(index.postings, query_terms, index.buckets))
    return s.filter(F.col("score").isNotNull()).select("query_id", "doc_id")


def search_score(index: Index, query_terms: DataFrame) -> DataFrame:
    """Q5: score = sum over matching terms of occurrences x words in the term."""
    s = _scored(phrase_hits(index.postings, query_terms, index.buckets))
    return s.filter(F.col("score").isNotNull()).select("query_id", "doc_id", "score")


def search_location(index: Index, query_terms: DataFrame) -> DataFrame:
    """Q6: 1-based word location of the first hitting term's first occurrence."""
    s = _scored(phrase_hits(index.postings, query_terms, index.buckets))
    return s.filter(F.col("score").isNotNull()).select(
        "query_id", "doc_id", _location("first_key").alias("location"))


def docs_with_any(index: Index, query_terms: DataFrame) -> DataFrame:
    """Q7: (query, doc) pairs where any negated term of the query occurs."""
    neg_terms = query_terms.filter("negated")
    return phrase_hits(index.postings, neg_terms, index.buckets).select(
        "query_id", "doc_id").distinct()


def _negation_only_ids(queries: DataFrame, query_terms: DataFrame) -> DataFrame:
    positive = query_terms.filter(~F.col("negated")).select("query_id")
    return queries.select("query_id").distinct().join(positive, "query_id", "left_anti")


def negation_only(index: Index, queries: DataFrame, query_terms: DataFrame,
                  scored: DataFrame | None = None) -> DataFrame:
    """Q9/Q10: queries without positive terms return every document not
    hit by a negated term, score 1, location 0."""
    ids = _negation_only_ids(queries, query_terms)
    if scored is None:
        excluded = docs_with_any(index, query_terms)
    else:
        excluded = scored.filter(F.col("neg") == 1).select("query_id", "doc_id")
    excluded = excluded.join(ids, "query_id", "left_semi")
    base = every_pair(index.all_docs(), ids, spread_by="doc_id")
    return base.join(excluded, ["query_id", "doc_id"], "left_anti").select(
        "query_id", "doc_id", F.lit(1).cast("bigint").alias("score"),
        F.lit(0).alias("location"))


def _matched(index: Index, query_terms: DataFrame) -> DataFrame:
    """(query_id, doc_id, score, first_key, neg) of every query and document
    that share a term."""
    uses = query_terms.groupBy("query_id", "term_no").agg(
        F.first("negated").alias("negated"), F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_list(F.struct("offset", "word"))).alias("words"))
    # Stored, so that the planner knows its size before the postings are read.
    uses = stored(uses.withColumn("phrase", F.concat_ws(" ", F.col("words.word"))), "query-phrases")
    # Words hold no blanks, so equal texts are equal phrases.
    phrases = (uses.select("phrase", "n_words", "words.word").distinct()
               .select(F.col("phrase").alias("query_id"), F.lit(0).alias("term_no"), F.lit(False).alias("negated"),
                       "n_words", F.posexplode("word").alias("offset", "word")))
    # One exchange by (phrase, doc) serves both levels; a group is one document's hits.
    phrases, long = split_long(phrases)
    hits = term_hits(index.postings, phrases, index.buckets).repartition("query_id", "doc_id")
    found = (hits.groupBy("query_id", "doc_id", "start")
             .agg(F.count("*").alias("k"), F.first("n_words").alias("n_words"), F.min("wpos").alias("wpos"))
             .filter("k = n_words").select("query_id", "doc_id", "wpos"))
    if long is not None:
        found = found.unionByName(long_phrase_hits(index.postings, long, index.buckets).select(
            "query_id", "doc_id", F.col("start_wpos").alias("wpos")))
    per_doc = (found.groupBy("query_id", "doc_id")
               .agg(F.count("*").alias("n"), F.min("wpos").alias("first_wpos"))
               .withColumnRenamed("query_id", "phrase"))
    rows = salted_join(per_doc, uses.select("phrase", "query_id", "term_no", "negated", "n_words"), ["phrase"],
                       spread_by="doc_id")
    positive = ~F.col("negated")
    return rows.groupBy("query_id", "doc_id").agg(
        F.sum(F.when(positive, F.col("n") * F.col("n_words"))).cast("bigint").alias("score"),
        F.min(F.when(positive, _first_key("term_no", "first_wpos"))).alias("first_key"),
        F.max(F.col("negated").cast("int")).alias("neg"))


def search(index: Index, queries: DataFrame, query_terms: DataFrame | None = None) -> DataFrame:
    """Q11: results(query_id, doc_id, score, location) for a query workload.

    Score and first location come from positive occurrences, any negated
    occurrence removes the document; queries without positive terms get one
    base row per document, which turns into score 1, location 0."""
    if query_terms is None:
        query_terms = explode_query_terms(queries)
    found = _matched(index, query_terms).withColumn("base", F.lit(0))
    ids = _negation_only_ids(queries, query_terms)
    base = every_pair(index.all_docs(), ids, spread_by="doc_id").select(
        "query_id", "doc_id", F.lit(None).cast("bigint").alias("score"),
        F.lit(None).cast("bigint").alias("first_key"), F.lit(0).alias("neg"), F.lit(1).alias("base"))
    agg = found.unionByName(base).groupBy("query_id", "doc_id").agg(
        F.max("score").alias("score"), F.max("first_key").alias("first_key"),
        F.max("neg").alias("neg"), F.max("base").alias("base"))
    hit = F.col("score").isNotNull()
    return agg.filter((F.col("neg") == 0) & (hit | (F.col("base") == 1))).select(
        "query_id", "doc_id",
        F.when(hit, F.col("score")).otherwise(F.lit(1).cast("bigint")).alias("score"),
        F.when(hit, _location("first_key")).otherwise(F.lit(0)).alias("location"))


def search_page(index: Index, queries: DataFrame, page_no: int = 1, size: int = PAGE_SIZE,
                block: int = ID_BLOCK) -> DataFrame:
    """Q9/Q10/Q13: the rows of ``page(search(...))`` without the results that
    no page shows: (query_id, doc_id, score, location, rank)."""
    query_terms = explode_query_terms(queries)
    found = stored(_matched(index, query_terms), "matched")
    hits = found.filter("neg = 0 and score is not null").select(
        "query_id", "doc_id", "score", _location("first_key").alias("location"))
    ids = _negation_only_ids(queries, query_terms)
    excluded = found.filter("neg = 1").join(ids, "query_id", "left_semi").select("query_id", "doc_id")
    others = complement_page(index.all_docs(), ids, excluded, page_no, size, block).select(
        "query_id", "doc_id", F.lit(1).cast("bigint").alias("score"), F.lit(0).alias("location"), "rank")
    return page(hits, page_no, size).unionByName(others)


def complement_page(docs: DataFrame, ids: DataFrame, excluded: DataFrame, page_no: int, size: int,
                    block: int = ID_BLOCK) -> DataFrame:
    """(query_id, doc_id, rank) of one page per query of ``ids`` of the distinct
    documents, by doc_id, that ``excluded`` (query_id, doc_id) does not name.

    The ordered ids are cut into blocks.  A query's first hi + e ids, e being the
    number of its exclusions, hold hi others, so only the blocks below that are
    counted; the running count finds the blocks with the page's ranks, and only
    their ids are listed."""
    lo, hi = (page_no - 1) * size, page_no * size
    ordered = distributed_row_number(docs.select(F.lit(0).alias("_all"), "doc_id"), "_all",
                                     [F.asc("doc_id")], "_place", "bigint").select(
        "doc_id", F.floor((F.col("_place") - 1) / block).alias("block"))
    ordered = stored(ordered, "ordered-ids")
    excluded = stored(excluded.join(ordered, "doc_id"), "exclusions")
    sizes = ordered.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    gone = excluded.groupBy("query_id", "block").agg(F.count(F.lit(1)).alias("gone"))
    reach = (ids.join(gone.groupBy("query_id").agg(F.sum("gone").alias("e")), "query_id", "left")
             .select("query_id", F.floor((F.coalesce("e", F.lit(0)) + F.lit(hi - 1)) / block).alias("last")))
    counted = (reach.select("query_id", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("block"))
               .join(sizes, "block").join(gone, ["query_id", "block"], "left")
               .withColumn("left", F.col("n") - F.coalesce("gone", F.lit(0))))
    before = Window.partitionBy("query_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shown = (counted.withColumn("before", F.coalesce(F.sum("left").over(before), F.lit(0)))
             .filter((F.col("before") < hi) & (F.col("before") + F.col("left") > lo)).select("query_id", "block", "before"))
    rows = shown.join(ordered, "block").join(excluded.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    within = Window.partitionBy("query_id", "block").orderBy("doc_id")
    return (rows.withColumn("rank", (F.col("before") + F.row_number().over(within)).cast("int"))
            .filter((F.col("rank") > lo) & (F.col("rank") <= hi)).select("query_id", "doc_id", "rank"))


def rank(results: DataFrame) -> DataFrame:
    """Q12: rank per query by score desc, then doc_id.  Distributed: a query
    with a huge result list is split over range partitions, not one task."""
    return distributed_row_number(results, "query_id",
                                  [F.desc("score"), F.asc("doc_id")], "rank")


def page(results: DataFrame, page_no: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """Q13: rows of one result page per query.  The rank filter has an upper
    bound, so Spark keeps only the top rows per query in each task before
    the shuffle (window group limit)."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    lo, hi = (page_no - 1) * size, page_no * size
    return (results.withColumn("rank", F.row_number().over(w))
            .filter((F.col("rank") <= hi) & (F.col("rank") > lo)))


def with_snippet(results: DataFrame, docs: DataFrame, line_break: bool = True) -> DataFrame:
    """Q14: add the 21-word snippet at each result's location ('' if the
    document is absent).

    One plan for any number of results: the documents that have a result are
    picked first, with the distinct locations asked of them, so a text is cut
    once per location however many queries found it, and only snippets, not
    texts, go on to the results."""
    asked = (results.groupBy("doc_id").agg(F.collect_set("location").alias("_at")))
    made = (docs.select("doc_id", F.col("text").alias("_text")).join(asked, "doc_id")
            .select("doc_id", split_words(fold_stops("_text")).alias("_words"), "_at")
            .select("doc_id", "_words", F.explode("_at").alias("location"))
            .select("doc_id", "location", snippet_of("_words", "location", line_break).alias("snippet")))
    return results.join(made, ["doc_id", "location"], "left").withColumn(
        "snippet", F.coalesce("snippet", F.lit("")))


def search_report(index: Index, queries: DataFrame, page_no: int = 1,
                  size: int = PAGE_SIZE) -> DataFrame:
    """Q15: one page per query: rank, document, score and snippet."""
    top = search_page(index, queries, page_no, size)
    return with_snippet(top, index.docs).select(
        "query_id", "rank", "doc_id", "score", "location", "snippet")
