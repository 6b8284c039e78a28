from pyspark.sql import functions as F

from inkwell.operators import spelling as SP
from inkwell.plans.asof import last_value_before


def _stats(spark, pairs):
    return spark.createDataFrame(pairs, "term string, cf bigint")


def test_suggestions_hand_made(spark):
    stats = _stats(spark, [("recieve", 2), ("receive", 10), ("teh", 1), ("the", 100),
                           ("ratio", 5), ("ration", 10)])
    log = spark.createDataFrame([
        (1, 1, "recieve"), (1, 2, "big query"), (1, 3, "receive"),   # multi-word skipped over
        (1, 4, "recieve"),                                           # suggestion
        (1, 5, "!teh"), (1, 6, "teh"), (1, 7, "the"), (1, 8, "teh"),  # '!' query is not a word
        (1, 9, "ratio"), (1, 10, "ration"), (1, 11, "ratio"),         # ratio exactly 0.5 counts
        (2, 1, "recieve"),                                            # other session: nothing
        (2, 2, "xyzzy"), (2, 3, "receive"),                           # distance > 3
        (2, 4, "xyzzy"),
    ], "session_id bigint, ts bigint, query string")
    got = sorted(tuple(r) for r in SP.suggest(log, stats).collect())
    assert got == [(1, 4, "recieve", "receive"), (1, 8, "teh", "the"), (1, 11, "ratio", "ration")]


def test_bucketed_asof_equals_plain(spark):
    df = spark.range(0, 3000).select((F.col("id") % 4).alias("k"), F.col("id").alias("ts"),
                                     F.lit(0).alias("seq"),
                                     F.when(F.col("id") % 7 == 0, F.col("id").cast("string")).alias("v"))
    a = last_value_before(df, ["k"], "ts", "seq", "v", "out", bucket_width=50)
    b = last_value_before(df, ["k"], "ts", "seq", "v", "out", bucket_width=1 << 40)
    assert a.exceptAll(b).count() == 0 and a.count() == 3000


def test_null_keys_and_times_stay(spark):
    rows = [(1, 10, "a"), (1, None, "b"), (None, 5, "c"), (None, 7, "d")]
    log = spark.createDataFrame(rows, "session_id bigint, ts bigint, query string")
    got = {(r["session_id"], r["ts"], r["query"], r["prev"]) for r in SP.previous_query(log).collect()}
    assert got == {(1, None, "b", None), (1, 10, "a", "b"), (None, 5, "c", None), (None, 7, "d", "c")}
