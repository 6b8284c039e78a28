"""Segmented live index against an index that is built anew."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkwell.operators import search as S
from inkwell.operators import stats as A
from inkwell.operators.postings import build_index, build_postings, term_counts, term_stats
from inkwell.operators.segments import SegmentStore, term_frequencies
from inkwell.session import work_dir

QUERIES = [(1, "w1 w2"), (2, '"w1 w2"'), (3, "w3 !w4"), (4, "!w1"), (5, ""), (6, "nothing"), (7, '!"w2 w3" w5')]


def text(rng):
    return " ".join(f"w{int(rng.expovariate(0.2))}" for _ in range(rng.randrange(0, 30)))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, docs):
    return spark.createDataFrame(sorted(docs.items()), "doc_id bigint, text string").repartition(3)


def same_as_rebuilt(spark, store, live, brief=False):
    """Search, term statistics and (unless brief) lookups."""
    rebuilt = build_index(frame(spark, live))
    queries = spark.createDataFrame(QUERIES, "query_id bigint, query string")
    assert rows(store.search(queries)) == rows(S.search(rebuilt, queries).select("query_id", "doc_id", "score", "location"))
    columns = ["term", "df", "cf", "idf"]
    assert rows(store.term_stats().select(*columns)) == rows(term_stats(rebuilt.postings, rebuilt.docs).select(*columns))
    assert store.live_count() == len(live)
    if brief:
        return
    phrases = spark.createDataFrame([(i, q) for i, q in enumerate(["w1", "w1 w2", "W3,", "no such", "", "w2 w2", "w0 w1 w2"])],
                                    "phrase_id bigint, phrase string")
    for name in ("document_freq", "index_freq"):
        assert rows(getattr(store, name)(phrases)) == rows(getattr(A, name)(rebuilt, phrases))
    pairs = spark.createDataFrame([(100 * i + d, d, q) for i, q in enumerate(["w1", "w1 w2", "none"]) for d in range(0, 90, 4)],
                                  "pair_id bigint, doc_id bigint, phrase string")
    assert rows(store.document_term_freq(pairs)) == rows(A.document_term_freq(rebuilt, pairs))


@pytest.fixture(scope="module")
def history(spark):
    """A store after a build, two appends, a deletion; the live documents."""
    rng = random.Random(3)
    live = {i: text(rng) for i in range(64)} | {63: None}
    base = work_dir(spark, "t-segments")
    store = SegmentStore(spark, base, buckets=5)
    store.append(frame(spark, live), step="build")
    for ids in (range(10, 22), range(16, 30, 2)):
        batch = {i: text(rng) for i in [*ids, 100 + ids[0]]}
        store.append(frame(spark, batch))
        live |= batch
    gone = [1, 17, 18, 110, 999]
    store.delete(spark.createDataFrame([(i,) for i in gone], "doc_id bigint"))
    return base, {i: t for i, t in live.items() if i not in gone}


def test_appends_and_deletes_equal_a_rebuilt_index(spark, history):
    base, live = history
    store = SegmentStore(spark, base, buckets=5)  # resumes from the pointer
    assert [p.docs for p in store.segments()] == [64, 13, 8]
    same_as_rebuilt(spark, store, live)


def files(spark, path):
    return {r["path"]: r["modificationTime"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(path).select("path", "modificationTime").collect()}


def test_merge_rewrites_no_other_segment_and_vacuum_drops_the_old(spark, history):
    base, live = history
    store = SegmentStore(spark, base, buckets=5)
    before = files(spark, f"{base}/segments/s=1")
    assert store.merge() == 13 + 8 - 3 - 3  # of 4 to 15 documents each; three were replaced, three removed
    assert [p.id for p in store.segments()] == [1, 4]
    assert files(spark, f"{base}/segments/s=1") == before
    same_as_rebuilt(spark, store, live, brief=True)
    assert store.merge() == 0
    gone = store.vacuum()
    assert {"segments/s=2", "segments/s=3"} <= set(gone) and "segments/s=1" not in gone
    again = SegmentStore(spark, base, buckets=5)
    assert again.version == store.version
    same_as_rebuilt(spark, again, live, brief=True)
    # After a merge documents go on being replaced and removed.
    again.append(frame(spark, {20: "w1 w2 w1 w2", 200: "w3"}), spark.createDataFrame([(24,)], "doc_id bigint"))
    live = {i: t for i, t in live.items() if i != 24} | {20: "w1 w2 w1 w2", 200: "w3"}
    same_as_rebuilt(spark, again, live, brief=True)


def test_a_step_that_dies_leaves_the_state_before_it(spark, monkeypatch):
    base = work_dir(spark, "t-segments-crash")
    store = SegmentStore(spark, base, buckets=3)
    live = {i: f"w{i % 7} w{i % 5} end" for i in range(40)}
    store.append(frame(spark, live))
    batch = {i: "w1 changed" for i in range(5)} | {70: "w1 w2"}
    with monkeypatch.context() as m:
        m.setattr(SegmentStore, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.append(frame(spark, batch))
    again = SegmentStore(spark, base, buckets=3)
    same_as_rebuilt(spark, again, live, brief=True)
    for _ in range(2):  # run again, and replayed once more
        again.append(frame(spark, batch))
        same_as_rebuilt(spark, again, live | batch, brief=True)
    with monkeypatch.context() as m:
        m.setattr(SegmentStore, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            again.merge()
    same_as_rebuilt(spark, SegmentStore(spark, base, buckets=3), live | batch, brief=True)


def test_empty_store_and_empty_batches(spark):
    store = SegmentStore(spark, work_dir(spark, "t-segments-empty"), buckets=3)
    same_as_rebuilt(spark, store, {}, brief=True)
    none = frame(spark, {1: "x"}).limit(0)
    store.append(none)
    store.delete(none.select("doc_id"))
    same_as_rebuilt(spark, store, {}, brief=True)
    store.append(frame(spark, {1: "w1 w2", 2: ""}))
    same_as_rebuilt(spark, store, {1: "w1 w2", 2: ""}, brief=True)
    store.merge()
    same_as_rebuilt(spark, store, {1: "w1 w2", 2: ""}, brief=True)


def test_deleting_writes_no_postings(spark, history):
    base, _ = history
    store = SegmentStore(spark, base, buckets=5)
    before = files(spark, f"{base}/segments")
    store.delete(spark.createDataFrame([(5,), (6,)], "doc_id bigint"))
    assert files(spark, f"{base}/segments") == before


def test_term_frequencies_equal_counted_postings(spark):
    rng = random.Random(9)
    docs = frame(spark, {i: text(rng) for i in range(50)} | {60: "", 61: None, 62: "a", 63: "B b, (b) a . . a"})
    mine = docs.select("doc_id", F.explode(term_frequencies("text")).alias("t")).select("doc_id", "t.term", "t.tf")
    assert rows(mine) == rows(term_counts(build_postings(docs)))
