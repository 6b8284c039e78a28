from collections import Counter

from inkwell.operators import similar as W


def test_similar_all_brute_force(spark, docs_df):
    texts = ["a x b a y b a x b", "c x d a z b", "a x b c y d x"]
    docs = docs_df([(i, t) for i, t in enumerate(texts)])
    words = spark.createDataFrame([("x",), ("y",)], "word string")
    got = {(r.word, r.candidate): r.n for r in W.similar_words(docs, words, mode="all").collect()}
    exp = Counter()
    toks = [t.split() for t in texts]
    for w in ("x", "y"):
        ctx = {(t[i - 1], t[i + 1]) for t in toks for i in range(1, len(t) - 1) if t[i] == w}
        for t in toks:
            for i in range(1, len(t) - 1):
                if (t[i - 1], t[i + 1]) in ctx and t[i] != w:
                    exp[(w, t[i])] += 1
    assert got == dict(exp)


def test_first_occurrence(docs_df):
    docs = docs_df([(1, "b a b c a"), (2, "")])
    got = sorted((r.term, r.pos) for r in W.first_occurrence(docs).collect())
    assert got == [("a", 1), ("b", 0), ("c", 3)]


def test_frames_equal_texts_and_follow_a_segment_store(spark):
    import random

    from inkwell.operators import similar as W
    from inkwell.operators.segments import SegmentStore
    from inkwell.session import work_dir
    rng = random.Random(5)
    made = lambda: " ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 25)))
    frame = lambda live: spark.createDataFrame(sorted(live.items()), "doc_id bigint, text string")
    words = spark.createDataFrame([("a",), ("b",), ("zz",), ("a",)], "word string")
    live = {i: made() for i in range(30)} | {30: None, 31: "a b", 32: "a"}
    want = lambda: sorted(map(tuple, W.similar_words(frame(live), words, mode="all").select("word", "candidate", "n").collect()))
    got = lambda df: sorted(map(tuple, df.select("word", "candidate", "n").collect()))
    assert got(W.similar_in_frames(W.frames(frame(live)), words)) == want() != []
    store = SegmentStore(spark, work_dir(spark, "t-frames"), buckets=3, with_frames=True)
    store.append(frame(live))
    for ids in (range(4, 9), range(7, 12)):
        batch = {i: made() for i in ids}
        store.append(frame(batch))
        live |= batch
    store.delete(frame({1: "", 8: ""}).select("doc_id"))
    live = {i: t for i, t in live.items() if i not in (1, 8)}
    assert got(store.similar_words(words)) == want()
    assert store.merge() > 0
    assert got(store.similar_words(words)) == want()
