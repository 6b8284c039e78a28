from pyspark.sql import functions as F

from inkwell.operators import search as S
from inkwell.operators.postings import build_index
from inkwell.plans.ranking import distributed_row_number


def _q(spark, rows):
    return spark.createDataFrame(rows, "query_id bigint, query string")


def test_query_terms(spark):
    qt = S.explode_query_terms(_q(spark, [(1, '!"a b" c "d e" f! '), (2, "")]))
    rows = sorted(tuple(r) for r in qt.collect())
    assert rows == [(1, 0, True, 2, 0, "a"), (1, 0, True, 2, 1, "b"), (1, 1, False, 2, 0, "d"),
                    (1, 1, False, 2, 1, "e"), (1, 3, False, 1, 0, "c"), (1, 4, True, 1, 0, "f")]


def test_phrase_overlap_and_repeats(spark, docs_df):
    idx = build_index(docs_df([(1, "the the the cat"), (2, "cat the")]))
    res = {(r.query_id, r.doc_id): (r.score, r.location) for r in S.search(
        idx, _q(spark, [(1, '"the the"'), (2, "the the"), (3, "cat")])).collect()}
    assert res[(1, 1)] == (4, 1)          # two overlapping occurrences x 2 words
    assert res[(2, 1)] == (6, 1) and res[(2, 2)] == (2, 2)
    assert res[(3, 1)] == (1, 4)
    assert (1, 2) not in res


def test_negation_partitions_documents(spark, docs_df):
    idx = build_index(docs_df([(1, "a b"), (2, "b c"), (3, "c d"), (4, "")]))
    res = S.search(idx, _q(spark, [(1, "b"), (2, "!b"), (3, ""), (4, "!b !zz")]))
    got = {q: {r.doc_id for r in res.filter(F.col("query_id") == q).collect()} for q in (1, 2, 3, 4)}
    assert got[1] | got[2] == {1, 2, 3, 4} and not (got[1] & got[2])
    assert got[3] == {1, 2, 3, 4} and got[4] == got[2]


def test_distributed_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") % 97).alias("s"),
                                     F.col("id").alias("k"))
    got = distributed_row_number(df.repartition(7), "g", [F.desc("s"), F.asc("k")], "r")
    from pyspark.sql import Window
    w = Window.partitionBy("g").orderBy(F.desc("s"), F.asc("k"))
    exp = df.withColumn("r", F.row_number().over(w))
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    assert got.count() == 5000


def test_stored_index_with_another_bucket_count(spark, docs_df):
    from inkwell.operators.postings import build_index, read_index, write_index
    from inkwell.operators.search import search
    from inkwell.session import work_dir
    docs = docs_df([(i, f"word{i} common term{i % 7}") for i in range(40)])
    path = work_dir(spark, "t-buckets")
    write_index(build_index(docs), path, buckets=13)
    idx = read_index(spark, path)
    assert idx.buckets == 13
    queries = spark.createDataFrame([(f"q{i}", f"word{i}") for i in range(40)], "query_id string, query string")
    got = sorted((r["query_id"], r["doc_id"]) for r in search(idx, queries).collect())
    assert got == sorted((f"q{i}", i) for i in range(40))
    assert idx.stats.filter("term = 'common'").first()["df"] == 40
    assert idx.counts.count() == 120


def test_empty_query_with_text_ids(spark, docs_df):
    from inkwell.operators.postings import build_index
    from inkwell.operators.search import search
    idx = build_index(docs_df([(1, "a b"), (2, "b c")]))
    queries = spark.createDataFrame([("x", ""), ("y", "!a")], "query_id string, query string")
    assert sorted((r["query_id"], r["doc_id"]) for r in search(idx, queries).collect()) == [("x", 1), ("x", 2), ("y", 2)]


def test_rank_keeps_null_groups(spark):
    from pyspark.sql import functions as F

    from inkwell.plans.ranking import distributed_row_number
    rows = spark.createDataFrame([(None, 3), (None, 5), (1, 4)], "g bigint, x bigint")
    got = distributed_row_number(rows, "g", [F.asc("x")]).collect()
    assert sorted((r["g"] is None, r["x"], r["rank"]) for r in got) == [(False, 4, 1), (True, 3, 1), (True, 5, 2)]


def test_pages_without_positive_terms_are_cut_from_the_ids(spark, docs_df):
    """Pages of negation-only and empty queries equal those of the whole
    results, at and beyond block borders, with long runs of exclusions."""
    docs = docs_df([(i * 3, f"{'low' if i < 70 else 'high'} word{i % 4} {'rare' if i in (1, 71, 99) else ''}") for i in range(100)])
    idx = build_index(docs)
    queries = spark.createDataFrame(
        [(1, "!low"), (2, "!rare"), (3, ""), (4, None), (5, "!low !high"), (6, "word1 !low"), (7, "!word0 !word1"), (8, "!none"),
         (9, '!"low word2"'), (10, "absent")], "query_id bigint, query string")
    whole = S.search(idx, queries)
    for page_no, size, block in ((1, 10, 8), (2, 10, 8), (4, 10, 8), (11, 10, 8), (1, 100, 16), (2, 7, 1), (1, 10, 1024)):
        want = S.page(whole, page_no, size).select("query_id", "doc_id", "score", "location", "rank")
        got = S.search_page(idx, queries, page_no, size, block)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), (page_no, size, block)


def test_equal_phrases_of_many_queries_are_matched_once(spark, docs_df):
    idx = build_index(docs_df([(i, f"a b a b c{i % 3} a") for i in range(12)]))
    one = [(1, '"a b" c1 !c2')]
    same = S.search(idx, spark.createDataFrame(one, "query_id bigint, query string"))
    many = S.search(idx, spark.createDataFrame([(i, one[0][1]) for i in range(50)], "query_id bigint, query string"))
    want = sorted(tuple(r)[1:] for r in same.collect())
    got = {}
    for r in many.collect():
        got.setdefault(r["query_id"], []).append(tuple(r)[1:])
    assert len(got) == 50 and all(sorted(v) == want for v in got.values())
