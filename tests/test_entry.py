import __spark_entry__ as E


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"query_id", "rank", "doc_id", "score", "location", "snippet"}
    assert set(E.oracle_sql()) <= set(E.queries())
