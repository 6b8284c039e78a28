"""Plans that must not gather or shuffle what grows, and the rows they give."""

import io
import random
from collections import Counter
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.functions.text import snippet, with_terms
from inkwell.operators import fuzzy as E
from inkwell.operators import live as L
from inkwell.operators import postings as P
from inkwell.operators import search as S
from inkwell.operators import similar as W
from inkwell.operators import stats as A
from inkwell.plans import catalog
from inkwell.plans.joins import salted_join, with_ids, without_ids
from inkwell.session import stored, work_dir
from inkwell.sources import workloads as WL

ODD = ["", None, "  a  b ", "--a--b-- . x .y", "A-B 'c' (D)! é́ ß", "…", "b a b . a b", "\n\na\tb\r\nc"]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def odd_docs(spark):
    docs = list(enumerate(ODD)) + [(None, "n a"), (None, "a a n"), (0, "b b"), (2, "a b c b")]
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)


def test_counts_and_positions_from_rows_equal_grouped_postings(spark):
    docs = odd_docs(spark)
    postings = P.build_postings(docs)
    columns = ["term", "doc_id", "tf"]
    assert rows(P.counts_of_docs(docs).select(columns)) == rows(P.term_counts(postings).select(columns))
    packed = lambda df: Counter((r.term, r.doc_id, r.tf, tuple(r.positions)) for r in df.collect())
    assert packed(P.packed_of_docs(docs)) == packed(P.packed_postings(postings))
    assert rows(P.stats_of_docs(docs).select("term", "df", "cf", "idf")) == \
        rows(P.term_stats(postings, docs).select("term", "df", "cf", "idf"))


def test_counts_of_single_documents_are_not_shuffled(spark):
    docs = odd_docs(spark).filter("doc_id > 2")
    for made in (P.counts_of_docs(docs), P.packed_of_docs(docs)):
        assert "hashpartitioning(doc_id" not in plan(made)


def test_text_is_split_once_per_row(spark):
    docs = stored(odd_docs(spark), "t-docs")
    for made in (P.build_postings(docs), W.neighbours(docs), P.counts_of_docs(docs.filter("doc_id > 2"))):
        assert plan(made).count("split(") == 1
    assert with_terms(docs, "doc_id").columns == ["doc_id", "_t", "_w"]


def test_stored_counts_equal_postings(spark):
    path = work_dir(spark, "t-index")
    docs = odd_docs(spark)
    P.write_index(P.build_index(docs), path, buckets=3)
    index = P.read_index(spark, path)
    columns = ["doc_id", "term", "tf"]
    assert rows(index.counts.select(columns)) == rows(P.term_counts(index.postings).select(columns))


def test_long_phrases_by_their_rarest_word(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("the the the of of to a b c d".split()) for _ in range(n))
    texts = [text(rng.randrange(0, 60)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    asked = [t[i:i + n] for t in (x.split() for x in texts) for i, n in ((0, 3), (2, 5), (4, 9), (1, 2)) if len(t) > 14][:80]
    asked += [["the", "the", "the"], ["the", "zz", "of"], ["of", "the", "of", "the"], ["a"]]
    phrases = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(asked)], "phrase_id bigint, phrase string")
    count = lambda t, p: sum(t[i:i + len(p)] == p for i in range(len(t) - len(p) + 1))
    found = {i: [(d, count(t.split(), p)) for d, t in enumerate(texts) if count(t.split(), p)] for i, p in enumerate(asked)}
    path = work_dir(spark, "t-index")
    P.write_index(P.build_index(docs), path, buckets=3)
    for index in (P.build_index(docs), P.read_index(spark, path)):
        assert {r.phrase_id: r.df for r in A.document_freq(index, phrases).collect()} == {i: len(f) for i, f in found.items()}
        assert {r.phrase_id: r.cf for r in A.index_freq(index, phrases).collect()} == \
            {i: sum(n for _, n in f) for i, f in found.items()}
        queries = phrases.select(F.col("phrase_id").alias("query_id"), F.concat(F.lit('"'), "phrase", F.lit('"')).alias("query"))
        got = {(r.query_id, r.doc_id): r.score for r in S.search(index, queries).collect()}
        assert got == {(i, d): n * len(asked[i]) for i, f in found.items() for d, n in f}


def test_frequent_words_of_a_passage_do_not_meet_all_their_postings(spark):
    docs = spark.createDataFrame([(i, "the of " * 50 + ("rare the of" if i == 3 else "")) for i in range(20)],
                                 "doc_id bigint, text string")
    terms = spark.createDataFrame([(1, "the of rare the of")], "query_id int, query string")
    terms = S.explode_query_terms(terms.withColumn("query", F.concat(F.lit('"'), "query", F.lit('"'))))
    short, long = S.split_long(terms)
    assert short.count() == 0 and long.count() == 5
    hits = S.phrase_hits(P.build_postings(docs), terms).collect()
    assert [(r.doc_id, r.start) for r in hits] == [(3, 98)]


def test_a_phrase_given_twice_under_one_id_is_matched_by_division(spark):
    phrases = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b c")], "phrase_id bigint, phrase string")
    docs = spark.createDataFrame([(1, "x a b c")], "doc_id bigint, text string")
    short, long = S.split_long(A.phrase_terms(phrases))
    assert {r.query_id for r in short.collect()} == {1} and {r.query_id for r in long.collect()} == {2}
    assert rows(A.document_freq(P.build_index(docs), phrases).select("phrase_id", "df")) == Counter({(1, 0): 2, (2, 1): 1})


def test_keys_that_grow_are_not_broadcast(spark):
    strings = spark.createDataFrame([("abcde",), ("abcdefghijklmnop",), ("abxde",)], "word string")
    words, vocab = stored(strings, "t-words"), stored(strings.withColumnRenamed("word", "term"), "t-vocab")
    assert "BroadcastHashJoin" not in plan(E.fuzzy_match(words, vocab, 2))
    frames = stored(spark.createDataFrame([("a", "b", "w", 1), ("a", "b", "x", 2)], "pre string, post string, word string, n bigint"),
                    "t-frames")
    similar = W.similar_in_frames(frames, words.limit(1).select(F.lit("w").alias("word")))
    assert "Broadcast" not in plan(similar) and rows(similar) == Counter({("w", "x", 2): 1})
    joined = salted_join(vocab, words.withColumnRenamed("word", "term"), ["term"], spread_by="term", shuffled=True)
    assert "BroadcastHashJoin" not in plan(joined) and joined.count() == 3


def test_delta_shuffles_only_texts_that_a_rule_takes(spark):
    docs = stored(spark.createDataFrame([(i, f"t{i}") for i in range(-60, 200)], "doc_id bigint, text string"), "t-delta")
    texts = {i: f"t{i}" for i in range(-60, 200)}
    want = Counter((i + new, texts[i + shift], seq) for seq, mod, rem, shift, new in WL.DELTA_RULES
                   for i in texts if i % mod == rem and i + shift in texts)
    delta = WL.delta_docs(docs)
    assert rows(delta.select("doc_id", "text", "index_seq")) == want
    assert plan(delta).count("pmod(") >= 2 * len(WL.DELTA_RULES)
    main = P.build_index(docs)
    live = L.live_index(main, delta)
    assert "SortMergeJoin" not in plan(live.postings)
    assert rows(live.postings) == rows(P.build_postings(live.docs))


def test_snippets_split_a_text_once_for_all_its_locations(spark):
    docs = stored(odd_docs(spark).filter("doc_id > 2"), "t-snip")
    results = spark.createDataFrame([(q, d, at) for q in (1, 2) for d in (3, 4, 6, 9) for at in (0, 2, 14)],
                                    "query_id bigint, doc_id bigint, location int")
    got = S.with_snippet(results, docs)
    want = results.join(docs, "doc_id", "left").select("query_id", "doc_id", "location", F.coalesce(
        snippet("text", "location"), F.lit("")).alias("snippet"))
    assert rows(got.select("query_id", "doc_id", "location", "snippet")) == rows(want)
    assert plan(got).count("split(") <= 2


def test_neighbours_of_joined_terms_split_texts_once(spark):
    docs = stored(odd_docs(spark), "t-docs")
    terms = stored(spark.createDataFrame([("a",)], "term string"), "t-terms")
    assert plan(W.neighbours(docs).join(terms, "term").dropna(subset=["prev1", "next1"])).count("split(") == 1


def test_word_edges_as_by_the_plain_pattern(spark):
    odd = ["a", "Z9", ".", "-", "é", "ß", "\u0663", "\U0001F600", "\U00010400", " ", "  ", "\t", "\n\r", "\u00a0", "_", ""]
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, "".join(rng.choices(odd, k=12))) for i in range(600)], "doc_id int, text string")
    spaced = F.regexp_replace(T.fold_stops("text"), r"\s{2,}|[\t\n\x0B\f\r]", " ")
    other = r"[^ a-z0-9\p{L}\p{N}]"
    plain = F.split(F.regexp_replace(F.lower(spaced), rf"(?<![^ ]){other}++|{other}++(?![^ ])", ""), " ")
    assert docs.filter(T.term_array("text") != plain).isEmpty()


def test_packed_terms_with_a_filter_split_texts_once(spark):
    docs = stored(odd_docs(spark).filter("doc_id > 2"), "t-docs")
    assert plan(P.packed_of_docs(docs).filter("term > 'b'")).count("split(") == 1


def test_contexts_of_few_words_meet_them_where_they_occur(spark):
    docs = stored(odd_docs(spark), "t-docs")
    words = spark.createDataFrame([("a",), ("a",), (None,)], "word string")
    for mode in ("first", "all"):
        made = plan(W.word_contexts(docs, words, mode))
        assert made.count("split(") == 1
        assert "hashpartitioning(term" not in made


def test_first_occurrences_without_a_function_per_term(spark):
    docs = stored(odd_docs(spark), "t-docs")
    made = plan(W.first_occurrence(docs))
    assert made.count("split(") == 1
    assert made.count("lambdafunction") == 1  # the offsets


def test_statistics_without_a_function_per_term(spark):
    made = plan(P.stats_of_docs(stored(odd_docs(spark), "t-docs").filter("doc_id > 2")))
    assert "lambdafunction" not in made


def test_word_pairs_shuffle_single_words_only(spark):
    log = spark.createDataFrame([(1, 1, "a"), (1, 2, "b c"), (1, 3, "!d"), (1, 4, None), (1, 5, "e"), (None, 6, "f"), (None, 7, "g")],
                                "session_id bigint, ts bigint, query string")
    pairs = catalog._word_pairs(stored(log, "t-log"))
    assert rows(pairs.select("session_id", "ts", "query", "prev")) == {(1, 5, "e", "a"): 1, (None, 7, "g", "f"): 1}
    assert "StringContains" in plan(pairs)


def test_places_and_masks_shuffle_no_postings(spark):
    """Also when the ids are too many for the planner to broadcast them."""
    docs = odd_docs(spark)
    main, delta = stored(docs, "t-docs"), spark.createDataFrame(
        [(i, f"new a{i} . b", 1, "p") for i in (1, 4, 70, None)], "doc_id bigint, text string, index_seq int, path string")
    path = work_dir(spark, "t-index")
    P.write_index(P.build_index(main), path, buckets=3)
    index = P.read_index(spark, path)
    assert rows(index.postings.drop("term_bucket").select("doc_id", "pos", "wpos", "term")) == rows(P.build_postings(docs))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        live = L.live_index(index, delta)
        ids = delta.select("doc_id")
        for made in (P.places_in_rows(main), L.remove_docs(index, ids).packed, L.remove_docs(index, ids).docs):
            assert "SortMergeJoin" not in plan(made) and "hashpartitioning(doc_id" not in plan(made)
        merged = L.merge_delta(index, delta, work_dir(spark, "t-merge"), version=2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    columns = ["doc_id", "pos", "wpos", "term"]
    assert rows(merged.postings.select(columns)) == rows(P.build_postings(live.docs)) == rows(live.postings.select(columns))
    counts = ["doc_id", "term", "tf"]
    assert rows(merged.counts.select(counts)) == rows(P.term_counts(merged.postings).select(counts))
    assert rows(merged.stats.select("term", "df", "cf")) == rows(P.term_stats(merged.postings, merged.docs).select("term", "df", "cf"))


def test_rows_by_id_masks(spark):
    rng = random.Random(4)
    ids = [rng.choice([-1, 1]) * rng.randrange(1 << rng.choice([3, 8, 62])) for _ in range(300)] + [None, 0, 63, 64, -64, -(1 << 63)]
    all_rows = spark.createDataFrame([(i, n) for n, i in enumerate(ids + ids[:20])], "doc_id bigint, n int")
    asked = spark.createDataFrame([(i,) for i in ids[::3] + ids[-3:] + [None]], "doc_id bigint")
    assert rows(with_ids(all_rows, asked)) == rows(all_rows.join(asked, "doc_id", "left_semi"))
    assert rows(without_ids(all_rows, asked)) == rows(all_rows.join(asked, "doc_id", "left_anti"))


def test_frames_are_stored_without_a_shuffle_and_looked_up_by_bucket(spark, monkeypatch):
    docs = stored(odd_docs(spark), "t-docs")
    assert "Exchange" not in plan(W.frames(docs)) and plan(W.frames(docs)).count("split(") == 1
    path = f"{work_dir(spark, 't-frames')}/t"
    W.write_frames(W.frames(docs), path)
    kept = spark.read.parquet(path)
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    seen = []
    one = W._similar_in_frames
    monkeypatch.setattr(W, "_similar_in_frames", lambda rows, asked: seen.append(rows.count()) or one(rows, asked))
    columns = ["word", "candidate", "n"]
    assert rows(W.similar_in_frames(kept, words).select(columns)) == \
        rows(W.similar_words(docs, words, mode="all").select(columns)) != Counter()
    assert len(seen) == W.FRAME_BUCKETS and sum(seen) == kept.count()
