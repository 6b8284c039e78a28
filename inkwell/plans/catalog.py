"""Registry of named queries: name -> callable(spark, sf_dir) -> DataFrame.

Every entry reads the given tables (or frames Spark derives from them) and
runs over them whole.  ``__spark_entry__`` only re-exports this registry.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.operators import postings as P
from inkwell.operators import search as S
from inkwell.functions import distance as D
from inkwell.functions import signatures as SG
from inkwell.operators import changes as C
from inkwell.sources import corpus as CO
from inkwell.streaming import changes as CS
from inkwell.streaming import live_index as LS
from inkwell.streaming import suggest as PS
from inkwell.streaming.metrics import Timer
from inkwell.operators import fuzzy as E
from inkwell.operators import live as L
from inkwell.operators.segments import SegmentStore
from inkwell.operators import spelling as SP
from inkwell.operators import similar as W
from inkwell.operators import topk as K
from inkwell.plans.joins import salted_join
from inkwell.session import shuffles_freed, stored, work_dir
from inkwell.operators import stats as A
from inkwell.sources import workloads as WL

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _index(spark: SparkSession, sf_dir: str) -> P.Index:
    return P.build_index(WL.documents(spark, sf_dir))


def _results(spark, sf_dir, queries=None):
    idx = _index(spark, sf_dir)
    q = queries if queries is not None else WL.workload(spark)
    return idx, q, S.search(idx, q)


# --- step 1: index tables -------------------------------------------------
@register("postings")
def q_postings(spark, sf_dir):
    return _index(spark, sf_dir).postings


@register("term_counts")
def q_term_counts(spark, sf_dir):
    return P.counts_of_docs(_index(spark, sf_dir).docs)


@register("packed_postings")
def q_packed_postings(spark, sf_dir):
    return P.packed_of_docs(_index(spark, sf_dir).docs)


@register("term_stats")
def q_term_stats(spark, sf_dir):
    return P.stats_of_docs(_index(spark, sf_dir).docs)


@register("all_docs")
def q_all_docs(spark, sf_dir):
    return _index(spark, sf_dir).all_docs()


@register("doc_length")
def q_doc_length(spark, sf_dir):
    d = WL.documents(spark, sf_dir)
    return d.select("doc_id", T.doc_length("text").alias("doc_length"))


@register("index_size_main")
def q_index_size_main(spark, sf_dir):
    return P.index_size(_index(spark, sf_dir))


# --- step 2/3: search -------------------------------------------------------
@register("query_terms")
def q_query_terms(spark, sf_dir):
    # the fixed workload plus benchmark passages and user turns read from the
    # given tables, so the parsing work grows with them
    return S.explode_query_terms(WL.extended_workload(spark, sf_dir))


@register("term_hits")
def q_term_hits(spark, sf_dir):
    idx = _index(spark, sf_dir)
    return S.term_hits(idx.postings, S.explode_query_terms(WL.workload(spark)))


@register("phrase_hits")
def q_phrase_hits(spark, sf_dir):
    idx = _index(spark, sf_dir)
    return S.phrase_hits(idx.postings, S.explode_query_terms(WL.workload(spark)))


@register("disjunction")
def q_disjunction(spark, sf_dir):
    return S.disjunction(_index(spark, sf_dir), S.explode_query_terms(WL.workload(spark)))


@register("search_score")
def q_search_score(spark, sf_dir):
    return S.search_score(_index(spark, sf_dir), S.explode_query_terms(WL.workload(spark)))


@register("search_location")
def q_search_location(spark, sf_dir):
    return S.search_location(_index(spark, sf_dir), S.explode_query_terms(WL.workload(spark)))


@register("search")
def q_search(spark, sf_dir):
    return _results(spark, sf_dir)[2]


@register("search_benchmark")
def q_search_benchmark(spark, sf_dir):
    """Q11 with long phrases: every benchmark passage searched as a phrase."""
    return _results(spark, sf_dir, WL.benchmark_workload(spark, sf_dir))[2]


@register("search_rank")
def q_search_rank(spark, sf_dir):
    return S.rank(_results(spark, sf_dir)[2])


@register("search_page")
def q_search_page(spark, sf_dir):
    return S.search_page(_index(spark, sf_dir), WL.workload(spark), page_no=2)


@register("search_page_bounded")
def q_search_page_bounded(spark, sf_dir):
    """The same page; only documents that can reach it are scored."""
    return K.bounded_page(_index(spark, sf_dir), WL.workload(spark), page_no=2)


@register("snippets")
def q_snippets(spark, sf_dir):
    idx, _, res = _results(spark, sf_dir)
    return S.with_snippet(res, idx.docs)


@register("search_report")
def q_search_report(spark, sf_dir):
    return S.search_report(_index(spark, sf_dir), WL.workload(spark))


@register("docs_with_any")
def q_docs_with_any(spark, sf_dir):
    return S.docs_with_any(_index(spark, sf_dir), S.explode_query_terms(WL.workload(spark)))


@register("negation_search")
def q_negation_search(spark, sf_dir):
    _, q, res = _results(spark, sf_dir)
    neg_q = S.explode_query_terms(q).filter("negated").select("query_id").distinct()
    return res.join(neg_q, "query_id", "left_semi")


@register("negation_only")
def q_negation_only(spark, sf_dir):
    idx = _index(spark, sf_dir)
    q = WL.workload(spark)
    return S.negation_only(idx, q, S.explode_query_terms(q))


@register("empty_query")
def q_empty_query(spark, sf_dir):
    q = spark.createDataFrame([(0, ""), (1, "   ")], "query_id bigint, query string")
    return _results(spark, sf_dir, q)[2]


# --- step 4: statistics and lookups -----------------------------------------
@register("document_freq")
def q_document_freq(spark, sf_dir):
    return A.document_freq(_index(spark, sf_dir), WL.benchmark_phrases(spark, sf_dir))


@register("index_freq")
def q_index_freq(spark, sf_dir):
    return A.index_freq(_index(spark, sf_dir), WL.benchmark_phrases(spark, sf_dir))


@register("document_term_freq")
def q_document_term_freq(spark, sf_dir):
    return A.document_term_freq(_index(spark, sf_dir), WL.lookup_pairs(spark, sf_dir))


@register("document_text")
def q_document_text(spark, sf_dir):
    ids = WL.read_table(spark, sf_dir, "labels").select("doc_id")
    return A.document_text(WL.documents(spark, sf_dir), ids)


@register("document_title")
def q_document_title(spark, sf_dir):
    ids = WL.read_table(spark, sf_dir, "labels").select("doc_id")
    return A.document_title(WL.documents(spark, sf_dir), ids)


# --- step 7: similar words ---------------------------------------------------
def _sim_inputs(spark, sf_dir):
    docs = WL.documents(spark, sf_dir)
    return docs, WL.similar_words_input(spark)


def _stats(docs):
    return P.stats_of_docs(docs)


@register("first_occurrence")
def q_first_occurrence(spark, sf_dir):
    return W.first_occurrence(WL.documents(spark, sf_dir))


@register("neighbours")
def q_neighbours(spark, sf_dir):
    return W.neighbours(WL.documents(spark, sf_dir))


@register("word_contexts")
def q_word_contexts(spark, sf_dir):
    docs, words = _sim_inputs(spark, sf_dir)
    return W.word_contexts(docs, words)


@register("context_anchors")
def q_context_anchors(spark, sf_dir):
    docs, words = _sim_inputs(spark, sf_dir)
    return W.context_anchors(W.word_contexts(docs, words), _stats(docs))


@register("similar_candidates")
def q_similar_candidates(spark, sf_dir):
    docs, words = _sim_inputs(spark, sf_dir)
    return W.similar_candidates(docs, W.context_anchors(W.word_contexts(docs, words), _stats(docs)))


@register("similar_first")
def q_similar_first(spark, sf_dir):
    docs, words = _sim_inputs(spark, sf_dir)
    return W.similar_words(docs, words, _stats(docs), mode="first")


@register("similar_all")
def q_similar_all(spark, sf_dir):
    docs, words = _sim_inputs(spark, sf_dir)
    return W.similar_words(docs, words, mode="all")


@register("similar_frames")
def q_similar_frames(spark, sf_dir):
    docs = WL.documents(spark, sf_dir)
    path = f"{work_dir(spark, 'frames')}/t"
    W.write_frames(W.frames(docs), path)
    return W.similar_in_frames(spark.read.parquet(path), WL.similar_words_input(spark))


@register("similar_report")
def q_similar_report(spark, sf_dir):
    docs, words = _sim_inputs(spark, sf_dir)
    return W.similar_report(W.similar_words(docs, words, _stats(docs), mode="first"))


# --- step 6: live indexing (batch) -------------------------------------------
def _live_inputs(spark, sf_dir):
    docs = WL.documents(spark, sf_dir)
    return P.build_index(docs), WL.delta_docs(docs)


@register("latest_delta")
def q_latest_delta(spark, sf_dir):
    return L.latest_delta(_live_inputs(spark, sf_dir)[1])


@register("duplicate_delta_docs")
def q_duplicate_delta_docs(spark, sf_dir):
    return L.duplicate_delta_docs(_live_inputs(spark, sf_dir)[1])


@register("index_size_delta")
def q_index_size_delta(spark, sf_dir):
    return P.delta_index_size(L.delta_postings(_live_inputs(spark, sf_dir)[1]))


@register("remove_docs")
def q_remove_docs(spark, sf_dir):
    main, _ = _live_inputs(spark, sf_dir)
    kept = L.remove_docs(main, WL.tombstones(main.docs))
    return P.term_counts(kept.postings).groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf"))


@register("live_search")
def q_live_search(spark, sf_dir):
    main, delta = _live_inputs(spark, sf_dir)
    return L.live_search(main, delta, WL.workload(spark))


@register("needs_merge")
def q_needs_merge(spark, sf_dir):
    return L.needs_merge(_live_inputs(spark, sf_dir)[1])


@register("merged_search")
def q_merged_search(spark, sf_dir):
    main, delta = _live_inputs(spark, sf_dir)
    merged = L.merge_delta(main, delta, work_dir(spark, "merge"), version=2)
    return S.search(merged, WL.workload(spark))


# --- step 8/9: edit distance and spelling suggestions ------------------------
# --- step 6: segmented live index --------------------------------------------
def _segment_store(spark, sf_dir, removed=False, with_frames=False):
    """The corpus as one segment and both delta batches appended to it; with
    ``removed`` also the tombstones deleted and size classes merged."""
    docs = WL.documents(spark, sf_dir)
    delta = WL.delta_docs(docs)
    store = SegmentStore(spark, work_dir(spark, "segments"), with_frames=with_frames)
    store.append(docs, step="build")
    for batch in (1, 2):
        store.append(delta.filter(F.col("index_seq") == batch))
    if removed:
        store.delete(WL.tombstones(docs))
        store.merge()
    return store


@register("live_term_stats")
def q_live_term_stats(spark, sf_dir):
    return _segment_store(spark, sf_dir).term_stats()


@register("live_document_freq")
def q_live_document_freq(spark, sf_dir):
    return _segment_store(spark, sf_dir).document_freq(WL.benchmark_phrases(spark, sf_dir))


@register("live_index_freq")
def q_live_index_freq(spark, sf_dir):
    return _segment_store(spark, sf_dir).index_freq(WL.benchmark_phrases(spark, sf_dir))


@register("live_document_term_freq")
def q_live_document_term_freq(spark, sf_dir):
    return _segment_store(spark, sf_dir).document_term_freq(WL.lookup_pairs(spark, sf_dir))


@register("segment_search")
def q_segment_search(spark, sf_dir):
    return _segment_store(spark, sf_dir, removed=True).search(WL.workload(spark))


@register("segment_term_stats")
def q_segment_term_stats(spark, sf_dir):
    return _segment_store(spark, sf_dir, removed=True).term_stats()


@register("live_similar_all")
def q_live_similar_all(spark, sf_dir):
    store = _segment_store(spark, sf_dir, removed=True, with_frames=True)
    return store.similar_words(WL.similar_words_input(spark))


@register("segment_history")
def q_segment_history(spark, sf_dir):
    """One row per step: documents written, documents that are live after it."""
    return _segment_store(spark, sf_dir, removed=True).steps()


def _log_inputs(spark, sf_dir, make_log=WL.query_log):
    docs = WL.documents(spark, sf_dir)
    stats = stored(P.stats_of_docs(docs), "log-stats")
    log = make_log(WL.read_table(spark, sf_dir, "events"), stats,
                   WL.read_table(spark, sf_dir, "conversations"))
    return log, stats


def _word_pairs(log):
    # Queries of several words are skipped as previous ones too: none is shuffled.
    return SP.previous_query(log.filter(SP.is_single_word("query"))).filter(F.col("prev").isNotNull())


def _pairs(spark, sf_dir):
    log, stats = _log_inputs(spark, sf_dir)
    return _word_pairs(log), stats


@register("previous_query")
def q_previous_query(spark, sf_dir):
    return SP.previous_query(_log_inputs(spark, sf_dir)[0])


@register("dominates")
def q_dominates(spark, sf_dir):
    pairs, stats = _pairs(spark, sf_dir)
    return SP.dominates(pairs, stats)


@register("mine_corrections")
def q_mine_corrections(spark, sf_dir):
    return SP.mine_corrections(*_log_inputs(spark, sf_dir))


@register("latest_corrections")
def q_latest_corrections(spark, sf_dir):
    return SP.latest_corrections(SP.mine_corrections(*_log_inputs(spark, sf_dir)))


@register("suggest")
def q_suggest(spark, sf_dir):
    return SP.suggest(*_log_inputs(spark, sf_dir))


def _edit_distances(pairs):
    return pairs.select("session_id", "ts", "prev", "query",
                        D.edit_distance("prev", "query").alias("distance"))


def _vowel_weight(x, y):
    """A cost function of its own (E4): one vowel for another is half a step."""
    vowels = ["a", "e", "i", "o", "u"]
    return (F.when(x == y, 0).when((x == D.GAP) | (y == D.GAP), 2)
            .when(x.isin(vowels) & y.isin(vowels), 1).otherwise(3))


def _weighted_distances(pairs, costs=(0, 1, 2), **how):
    distinct = pairs.select("prev", "query").distinct()
    scored = distinct.withColumn(
        "distance", D.weighted_edit_distance("prev", "query", costs=costs, **(how or {"hyphen": "gap"})))
    return pairs.select("session_id", "ts", "prev", "query").join(scored, ["prev", "query"])


@register("edit_distance")
def q_edit_distance(spark, sf_dir):
    return _edit_distances(_pairs(spark, sf_dir)[0])


@register("edit_distance_weighted")
def q_edit_distance_weighted(spark, sf_dir):
    return _weighted_distances(_pairs(spark, sf_dir)[0])


@register("edit_distance_custom")
def q_edit_distance_custom(spark, sf_dir):
    """The cost function replaced by one in which vowels are close."""
    return _weighted_distances(_pairs(spark, sf_dir)[0], costs=(0, 2, 3), weight=_vowel_weight)


# The same over the log whose sessions are whole user histories.
for _name, _of in {
        "previous_query": lambda log, stats: SP.previous_query(log),
        "dominates": lambda log, stats: SP.dominates(_word_pairs(log), stats),
        "mine_corrections": SP.mine_corrections,
        "latest_corrections": lambda log, stats: SP.latest_corrections(SP.mine_corrections(log, stats)),
        "suggest": SP.suggest,
        "edit_distance": lambda log, stats: _edit_distances(_word_pairs(log)),
        "edit_distance_weighted": lambda log, stats: _weighted_distances(_word_pairs(log)),
        "suggest_stream": lambda log, stats: _streamed_suggestions(log, stats)}.items():
    register(f"{_name}_by_user")(
        lambda spark, sf_dir, of=_of: of(*_log_inputs(spark, sf_dir, WL.user_query_log)))


def _words_and_vocabulary(spark, sf_dir):
    """The words of the benchmark passages and the whole vocabulary, stored: a
    fuzzy join reads both more than once."""
    bench = WL.read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    words = P.build_postings(bench).select(F.col("term").alias("word")).distinct()
    vocab = P.build_postings(WL.documents(spark, sf_dir)).select("term").distinct()
    return stored(words, "asked-words"), stored(vocab, "vocabulary")


@register("fuzzy_match")
def q_fuzzy_match(spark, sf_dir):
    """The words of the benchmark passages against the whole vocabulary."""
    return E.fuzzy_match(*_words_and_vocabulary(spark, sf_dir), max_distance=2)


@register("fuzzy_match_weighted")
def q_fuzzy_match_weighted(spark, sf_dir):
    """The same by weighted distance, hyphens being gaps: at most one letter
    replaced or two inserted or deleted, hyphens aside."""
    return E.weighted_match(*_words_and_vocabulary(spark, sf_dir), max_cost=2, costs=(0, 1, 2), hyphen="gap")


@register("fuzzy_match_log")
def q_fuzzy_match_log(spark, sf_dir):
    """All distinct words of the query log (events and conversations, misspelt
    ones too) and of the benchmark passages against the whole vocabulary."""
    log, stats = _log_inputs(spark, sf_dir)
    bench = WL.read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    asked = log.select(F.col("session_id").alias("doc_id"), F.col("query").alias("text")).unionByName(bench)
    words = P.build_postings(asked).select(F.col("term").alias("word")).distinct()
    return E.fuzzy_match(stored(words, "log-words"), stats.select("term"), max_distance=2)


# --- step 5: corpus sources and sinks ---------------------------------------
def _xml_records(spark, sf_dir):
    docs = WL.read_table(spark, sf_dir, "documents")
    path = work_dir(spark, "xml")
    CO.write_xml_docs(CO.docs_as_xml_records(docs), path)
    return CO.read_xml_docs(spark, path)


@register("xml_docs")
def q_xml_docs(spark, sf_dir):
    return _xml_records(spark, sf_dir).select(*CO.DOC_FIELDS)


@register("docno_normalize")
def q_docno_normalize(spark, sf_dir):
    return _xml_records(spark, sf_dir).select("DOCNO", T.normalize_docno("DOCNO").alias("doc_id"))


@register("compose_body")
def q_compose_body(spark, sf_dir):
    r = _xml_records(spark, sf_dir)
    return r.select(T.normalize_docno("DOCNO").alias("doc_id"),
                    T.compose_body("TITLE", "TEXT", "AUTHOR").alias("body"))


@register("build_docs")
def q_build_docs(spark, sf_dir):
    return CO.build_docs(_xml_records(spark, sf_dir), ["file_path"])


@register("write_docs")
def q_write_docs(spark, sf_dir):
    path = work_dir(spark, "docstore")
    CO.write_docs(CO.build_docs(_xml_records(spark, sf_dir), ["file_path"]), path)
    return spark.read.parquet(path)


@register("build_index")
def q_build_index(spark, sf_dir):
    path = work_dir(spark, "index")
    P.write_index(_index(spark, sf_dir), path)
    return P.read_index(spark, path).postings.select("doc_id", "pos", "wpos", "term")


@register("index_size_stored")
def q_index_size_stored(spark, sf_dir):
    path = work_dir(spark, "index")
    P.write_index(_index(spark, sf_dir), path)
    return P.stored_bytes(spark, path)


@register("parse_changes")
def q_parse_changes(spark, sf_dir):
    delta = L.latest_delta(WL.delta_docs(WL.documents(spark, sf_dir)))
    records = delta.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("DOCNO"),
        F.concat(F.lit("T "), F.col("doc_id").cast("string")).alias("TITLE"),
        F.lit("").alias("AUTHOR"), F.lit("").alias("BIBLIO"), F.col("text").alias("TEXT"))
    rows = records.select(CO.xml_text(records).alias("content"), F.col("DOCNO").alias("path"))
    return CO.build_docs(CO.parse_xml_column(rows), ["path"])


# --- step 10: change detection -----------------------------------------------
def _files(spark, sf_dir):
    return WL.doc_files(WL.documents(spark, sf_dir))


@register("signatures_md5")
def q_signatures_md5(spark, sf_dir):
    return C.content_signatures(_files(spark, sf_dir), "MD5")


@register("signatures_sha256")
def q_signatures_sha256(spark, sf_dir):
    return C.content_signatures(_files(spark, sf_dir), "SHA-256")


@register("signatures_checksum")
def q_signatures_checksum(spark, sf_dir):
    return C.content_signatures(_files(spark, sf_dir), "checksum")


@register("signatures_sha512")
def q_signatures_sha512(spark, sf_dir):
    return C.content_signatures(_files(spark, sf_dir), "SHA-512")


@register("signatures_mtime")
def q_signatures_mtime(spark, sf_dir):
    """Every file of the given tables, by name, with its modification time."""
    files = C.file_signatures(spark, sf_dir, "mtime", glob="*.parquet")
    return files.withColumn("path", F.regexp_extract("path", "[^/]+$", 0))


@register("watch_set")
def q_watch_set(spark, sf_dir):
    docs = WL.read_table(spark, sf_dir, "documents")
    methods = F.create_map(*[F.lit(x) for pair in WL.LANG_METHODS for x in pair])
    files = docs.select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
                        F.col("text").alias("content"), methods[F.col("lang")].alias("method"))
    return C.content_signatures(C.watch_set(files))


def _snapshots(spark, sf_dir):
    docs = WL.documents(spark, sf_dir)
    old = C.content_signatures(WL.doc_files(docs), "MD5")
    new_files = WL.live_files(docs)
    return old, C.content_signatures(new_files, "MD5"), new_files


@register("signature_diff")
def q_signature_diff(spark, sf_dir):
    old, new, _ = _snapshots(spark, sf_dir)
    return C.diff_signatures(old, new)


def _staged(spark, sf_dir):
    """The watched files signed from scratch, then again after the delta."""
    docs = WL.documents(spark, sf_dir)
    old = stored(C.staged_signatures(WL.doc_files(docs), method="MD5"), "staged-old")
    return old, C.staged_signatures(WL.live_files(docs), old, method="MD5")


@register("staged_signatures")
def q_staged_signatures(spark, sf_dir):
    return _staged(spark, sf_dir)[1].drop("quick")


@register("staged_digests")
def q_staged_digests(spark, sf_dir):
    return C.digests_by_change(*_staged(spark, sf_dir))


@register("change_stream")
def q_change_stream(spark, sf_dir):
    """Three snapshots (the corpus, after the delta, the corpus again), the
    stream stopped after each and started anew."""
    old, new, _ = _snapshots(spark, sf_dir)
    base = work_dir(spark, "changes")
    for n, signatures in enumerate((old, new, old), 1):
        CS.write_snapshot(signatures, f"{base}/log", n)
        out = CS.run_change_stream(spark, f"{base}/log", f"{base}/out", f"{base}/checkpoint")
    return out


@register("commit_baseline")
def q_commit_baseline(spark, sf_dir):
    _, new, _ = _snapshots(spark, sf_dir)
    return C.commit_baseline(new, work_dir(spark, "baseline"), version=2)


@register("signature_scalar")
def q_signature_scalar(spark, sf_dir):
    sigs = C.content_signatures(_files(spark, sf_dir), "MD5")
    s = sigs.withColumn("scalar", SG.to_scalar("method", "path", "signature"))
    m, p, g = SG.from_scalar("scalar")
    return s.select("path", "method", "signature", "scalar", m.alias("back_method"),
                    p.alias("back_path"), g.alias("back_signature"))


@register("publish_changes")
def q_publish_changes(spark, sf_dir):
    old, new, new_files = _snapshots(spark, sf_dir)
    log = work_dir(spark, "changelog")
    C.publish_changes(C.diff_signatures(old, new), new_files, log, batch=1)
    return C.read_change_log(spark, log)


# --- step 11: streaming --------------------------------------------------------
def _change_log_from_delta(spark, docs, log_path):
    """Publish the delta fixture as change-log files: one publisher batch per
    index_seq, several files each; new texts as DOC elements."""
    delta = WL.delta_docs(docs)
    for seq in sorted({r[0] for r in WL.DELTA_RULES}):
        part = delta.filter(F.col("index_seq") == seq)
        xml = part.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("DOCNO"),
                          F.lit("").alias("TITLE"), F.lit("").alias("AUTHOR"), F.lit("").alias("BIBLIO"),
                          F.col("text").alias("TEXT"), "path")
        rows = xml.select("path", F.lit("changed").alias("change"), CO.xml_text(xml).alias("content"),
                          SG.signature("TEXT", "MD5").alias("signature"),
                          F.lit(seq).cast("bigint").alias("batch"))
        with shuffles_freed(spark):
            rows.repartition(3, "path").write.mode("append").option("compression", "zstd").parquet(log_path)


def _publish_removals(docs, log_path):
    """Tombstones as the last publisher batch."""
    gone = WL.tombstones(docs).select(
        F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".xml")).alias("path"),
        F.lit("removed").alias("change"), F.lit(None).cast("string").alias("content"),
        F.lit(None).cast("string").alias("signature"),
        F.lit(1 + max(r[0] for r in WL.DELTA_RULES)).cast("bigint").alias("batch"))
    gone.repartition(2, "path").write.mode("append").parquet(log_path)


def _run_indexer(spark, sf_dir, threshold, removals=False):
    docs = WL.documents(spark, sf_dir)
    base = work_dir(spark, "live")
    log = f"{base}/changelog"
    _change_log_from_delta(spark, docs, log)
    if removals:
        _publish_removals(docs, log)
    indexer = LS.LiveIndexer(spark, base, threshold=threshold)
    indexer.init_main(docs)
    q = LS.run_live_indexer(indexer, log, f"{base}/checkpoint", files_per_batch=4)
    return indexer, q


@register("live_index_stream")
def q_live_index_stream(spark, sf_dir):
    indexer, _ = _run_indexer(spark, sf_dir, threshold=1 << 30)
    # A DOC element's body is title, text and author joined by line ends.
    return indexer.latest().select("doc_id", F.regexp_replace("text", r"\A\n|\n\z", "").alias("text"),
                                   "index_seq", "path")


@register("live_stream_removals")
def q_live_stream_removals(spark, sf_dir):
    """XML changes and removals, streamed; searched without a merge."""
    indexer, _ = _run_indexer(spark, sf_dir, threshold=1 << 30, removals=True)
    return indexer.search(WL.workload(spark))


@register("stream_merge")
def q_stream_merge(spark, sf_dir):
    indexer, _ = _run_indexer(spark, sf_dir, threshold=L.DEFAULT_MERGE_THRESHOLD)
    return indexer.search(WL.workload(spark))


@register("metrics")
def q_metrics(spark, sf_dir):
    indexer, _ = _run_indexer(spark, sf_dir, threshold=L.DEFAULT_MERGE_THRESHOLD)
    return indexer.timings()


def timed_queries(docs, queries, words, base):
    """A timer with one step for the build, one for each kind of query in
    the workload and one for each kind of similar-words look-up."""
    timer = Timer()
    terms = S.explode_query_terms(queries)
    began = time.monotonic()
    # Texts are tokenized once, for the steps that follow too.  The asked words are stored, so
    # that the planner sees how few they are and does not shuffle the postings by them.
    docs = stored(T.with_terms(docs, "doc_id"), "terms")
    words_asked = stored(terms.select(F.col("word").alias("term")).distinct(), "asked-terms")
    asked = salted_join(P.build_postings(docs), words_asked, ["term"], "doc_id").select("doc_id", "pos", "wpos", "term")
    index = P.Index(docs, timer.run("build", asked, f"{base}/postings", began))
    kinds = stored(S.query_kinds(queries, terms), "query-kinds")
    for kind in S.QUERY_KINDS:
        of_kind = queries.join(kinds.filter(F.col("kind") == kind), "query_id", "left_semi")
        timer.run(kind, S.search(index, of_kind))
    stats = stored(_stats(docs), "stats")
    timer.run("similar first", W.similar_words(docs, words, stats, mode="first"))
    timer.run("similar all", W.similar_words(docs, words, mode="all"))
    return timer


@register("query_metrics")
def q_query_metrics(spark, sf_dir):
    """Timings differ from run to run, so only the rows of each step and that it
    was timed are returned."""
    docs = WL.documents(spark, sf_dir)
    timer = timed_queries(docs, WL.workload(spark), WL.similar_words_input(spark), work_dir(spark, "timed"))
    return timer.frame(spark).select("name", F.col("input_rows").alias("n_rows"),
                                     (F.col("duration_ms") >= 0).alias("timed"))


def _streamed_suggestions(log, stats):
    """Two arrivals of many files each, in the order of ts (rows without one
    come first); the stream is stopped and started anew between them."""
    spark = log.sparkSession
    base = work_dir(spark, "suggest")
    stats_path = f"{base}/stats"
    stats.select("term", "cf").write.parquet(stats_path)
    log = stored(log, "query-log")
    mid = log.agg(F.percentile_approx("ts", 0.5).alias("m")).first()["m"]
    second = F.coalesce(F.col("ts") >= mid, F.lit(False))
    for cond in (~second, second):
        log.filter(cond).write.mode("append").parquet(f"{base}/log")
        out = PS.run_suggest_stream(spark, f"{base}/log", spark.read.parquet(stats_path),
                                    f"{base}/suggestions", f"{base}/checkpoint")
    return out


@register("suggest_stream")
def q_suggest_stream(spark, sf_dir):
    return _streamed_suggestions(*_log_inputs(spark, sf_dir))
