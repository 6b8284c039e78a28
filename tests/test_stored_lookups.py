def test_lookups_on_a_stored_index_with_another_bucket_count(spark, docs_df):
    from inkwell.operators import stats as A
    from inkwell.operators.postings import build_index, read_index, write_index
    from inkwell.session import work_dir
    docs = docs_df([(i, f"word{i} common term{i % 7} common") for i in range(40)])
    path = work_dir(spark, "t-lookup-buckets")
    write_index(build_index(docs), path, buckets=13)
    idx = read_index(spark, path)
    phrases = spark.createDataFrame([(i, f"word{i} common") for i in range(40)] + [(40, "common")], "phrase_id bigint, phrase string")
    want_df = {i: 1 for i in range(40)} | {40: 40}
    assert {r["phrase_id"]: r["df"] for r in A.document_freq(idx, phrases).collect()} == want_df
    assert {r["phrase_id"]: r["cf"] for r in A.index_freq(idx, phrases).collect()} == want_df | {40: 80}
    pairs = spark.createDataFrame([(i, i, "common") for i in range(40)], "pair_id bigint, doc_id bigint, phrase string")
    assert {r["pair_id"]: r["tf"] for r in A.document_term_freq(idx, pairs).collect()} == {i: 2 for i in range(40)}
