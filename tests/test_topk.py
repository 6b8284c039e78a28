"""Pages by bounds against pages of the full ranking."""
import random

import pytest
from pyspark.sql import functions as F

from inkwell.operators.postings import build_index, read_index, write_index
from inkwell.operators.search import search, search_page
from inkwell.operators.topk import bounded_page, page_work, phrase_caps, _uses
from inkwell.operators.search import explode_query_terms
from inkwell.session import work_dir

QUERIES = ["a", '"a b"', 'a "b c"', '"a a a"', '!"a b" c', "!d a b", '!"c c" "a b"', "!a", "", "zzz", "a a b",
           '"a b c d"', '!"a zzz" a', None]


def _docs(spark, n=60):
    """Short and long texts, ties, repeated texts, an empty one and a null."""
    r = random.Random(7)
    texts = [" ".join(r.choices("abcde", weights=[8, 4, 2, 1, 1], k=r.choice([1, 3, 10, 60]))) for _ in range(n)]
    texts += [texts[0]] * 5 + ["", None, "a a a a"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("is_stored", [False, True])
def test_pages_equal_the_full_ranking(spark, is_stored):
    index = build_index(_docs(spark))
    if is_stored:
        path = f"{work_dir(spark, 't-topk')}/i"
        write_index(index, path, buckets=5)
        index = read_index(spark, path)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id bigint, query string")
    for number, size in ((1, 3), (2, 4)):
        want = {tuple(r) for r in search_page(index, queries, number, size).collect()}
        got = [tuple(r) for r in bounded_page(index, queries, number, size).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert bounded_page(index, queries.limit(0)).count() == 0


def test_less_is_scored(spark):
    """Documents below the floor are not scored; with one giant among many
    small ones, nearly none are."""
    rows = [(i, "a b " * (1 + i % 3)) for i in range(200)] + [(1000 + i, "a b " * 50) for i in range(3)]
    index = build_index(spark.createDataFrame(rows, "doc_id bigint, text string"))
    queries = spark.createDataFrame([(0, "a"), (1, '"a b"'), (2, '"b a" !c')], "query_id bigint, query string")
    work = {r.query_id: (r.n_possible, r.n_scored) for r in page_work(index, queries, 1, 3).collect()}
    assert work == {0: (203, 3), 1: (203, 3), 2: (203, 3)}
    assert search(index, queries).count() > 400


def test_caps_bound_the_occurrences(spark):
    index = build_index(_docs(spark))
    terms = explode_query_terms(spark.createDataFrame([(0, '"a a a" "a b" a')], "query_id bigint, query string"))
    uses = _uses(terms)
    caps = {(r.phrase, r.doc_id): r.cap for r in phrase_caps(
        index.postings.groupBy("doc_id", "term").agg(F.count("*").alias("tf")), uses).collect()}
    for r in index.docs.filter("text is not null").collect():
        words = r.text.split()
        for phrase in ("a a a", "a b", "a"):
            p = phrase.split()
            n = sum(words[i:i + len(p)] == p for i in range(len(words)))
            cap = caps.get((phrase, r.doc_id), 0)
            assert n <= cap and (len(p) > 1 or n == cap)
