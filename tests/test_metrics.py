"""Timed steps: rows observed by the job itself, one step per kind of query."""
from inkwell.operators.search import QUERY_KINDS, explode_query_terms, query_kinds
from inkwell.plans.catalog import timed_queries
from inkwell.session import work_dir
from inkwell.sources import workloads as WL
from inkwell.streaming.metrics import METRICS_SCHEMA, Timer


def test_kinds_of_queries(spark):
    asked = ["", "  ", None, "!a", '!"a b" !c', 'a !b', '"a b"', 'a "b c"', "a b", "a a", "a", "b!"]
    q = spark.createDataFrame(list(enumerate(asked)), "query_id bigint, query string")
    got = {r.query_id: r.kind for r in query_kinds(q, explode_query_terms(q)).collect()}
    assert [got[i] for i in range(len(asked))] == [
        "empty", "empty", "empty", "negated", "negated", "mixed", "phrase", "phrase", "words", "words", "word", "negated"]


def test_rows_are_observed(spark):
    timer = Timer()
    base = work_dir(spark, "t-timer")
    assert timer.run("stored", spark.range(7), f"{base}/t").count() == 7
    timer.run("ran", spark.range(5))
    timer.run("none", spark.range(0))
    timer.run("none left", spark.range(9).filter("id < 0"))
    rows = timer.frame(spark).collect()
    assert [(r.name, r.batch_id, r.input_rows) for r in rows] == [
        ("stored", 0, 7), ("ran", 1, 5), ("none", 2, 0), ("none left", 3, 0)]
    assert all(r.duration_ms >= 0 for r in rows)
    assert Timer().frame(spark).columns == [c.split()[0] for c in METRICS_SCHEMA.split(", ")]


def test_one_step_per_kind(spark):
    docs = spark.createDataFrame([(1, "was it the end of the road"), (2, "it was in the end"), (3, None), (4, "")],
                                 "doc_id bigint, text string")
    timer = timed_queries(docs, WL.workload(spark), WL.similar_words_input(spark), work_dir(spark, "t-timed"))
    names = [r.name for r in timer.frame(spark).collect()]
    assert names == ["build", *QUERY_KINDS, "similar first", "similar all"]
    rows = {r.name: r.input_rows for r in timer.frame(spark).collect()}
    assert rows["empty"] == 4 and rows["words"] == 2


def test_texts_are_tokenized_once_and_postings_not_shuffled(spark, monkeypatch):
    import io
    from contextlib import redirect_stdout
    plans = {}
    run = Timer.run

    def noted(self, name, df, *rest):
        with redirect_stdout(io.StringIO()) as out:
            df.explain()
        plans[name] = out.getvalue()
        return run(self, name, df, *rest)

    monkeypatch.setattr(Timer, "run", noted)
    docs = spark.createDataFrame([(1, "was it the end of the road"), (1, "it was"), (None, "in the end"), (3, None)],
                                 "doc_id bigint, text string")
    timer = timed_queries(docs, WL.workload(spark), WL.similar_words_input(spark), work_dir(spark, "t-timed"))
    assert "Exchange hashpartitioning(term" not in plans["build"] and "SortMergeJoin" not in plans["build"]
    assert not any("split(" in plans[name] for name in ("similar first", "similar all"))
    assert {r.name: r.input_rows for r in timer.frame(spark).collect()}["build"] == 7
