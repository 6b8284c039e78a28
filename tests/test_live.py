from pyspark.sql import functions as F

from inkwell.operators import live as L
from inkwell.operators import search as S
from inkwell.operators.postings import build_index, read_index
from inkwell.session import work_dir
from inkwell.sources import workloads as WL

SF = "/root/testdata/sf0.001"


def test_live_equals_rebuild_and_merge(spark):
    docs = WL.documents(spark, SF)
    delta = WL.delta_docs(docs)
    q = WL.workload(spark)
    main = build_index(docs)
    live = L.live_search(main, delta, q)
    rebuilt = build_index(L.live_index(main, delta).docs)
    direct = S.search(rebuilt, q)
    assert live.exceptAll(direct).count() == 0 and direct.exceptAll(live).count() == 0
    merged = L.merge_delta(main, delta, work_dir(spark, "t-merge"), version=2)
    after = S.search(merged, q)
    assert after.exceptAll(live).count() == 0 and live.count() == after.count()


def test_remove_docs_drops_vocabulary(spark, docs_df):
    idx = build_index(docs_df([(1, "alpha beta"), (2, "beta gamma")]))
    kept = L.remove_docs(idx, spark.createDataFrame([(2,)], "doc_id bigint"))
    assert {r.term for r in kept.postings.select("term").distinct().collect()} == {"alpha", "beta"}


def test_replayed_delta_batch_is_idempotent(spark):
    from inkwell.sources.corpus import write_delta_docs
    path = work_dir(spark, "t-delta")
    rows = spark.createDataFrame([(1, "x", "p1", "changed", 1)],
                                 "doc_id bigint, text string, path string, change string, index_seq int")
    write_delta_docs(rows, path)
    write_delta_docs(rows, path)
    assert spark.read.parquet(path).count() == 1
