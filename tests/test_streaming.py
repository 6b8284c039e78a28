import random

from pyspark.sql import functions as F

from inkwell.operators import spelling as SP
from inkwell.session import work_dir
from inkwell.streaming.suggest import run_suggest_stream


def arrivals(spark, log, stats, cuts, files_per_batch=None):
    """Suggestions of a log that arrives in parts, the stream started anew for each."""
    base = work_dir(spark, "t-stream")
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = (F.lit(True) if lo is None else F.coalesce(F.col("ts") > lo, F.lit(False))) & \
            (F.lit(True) if hi is None else F.coalesce(F.col("ts") <= hi, F.lit(True)))
        log.filter(part).repartition(4, "ts").write.mode("append").parquet(f"{base}/log")
        out = run_suggest_stream(spark, f"{base}/log", stats, f"{base}/state", f"{base}/ckpt", files_per_batch)
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_suggest_stream_equals_batch(spark):
    stats = spark.createDataFrame([("recieve", 2), ("receive", 10), ("teh", 1), ("the", 100)],
                                  "term string, cf bigint")
    rows = [(1, 1, "recieve"), (1, 2, "receive"), (2, 3, "teh"), (1, 4, "recieve"),
            (2, 5, "the"), (2, 6, "two words"), (2, 7, "teh"), (1, 8, "recieve")]
    log = spark.createDataFrame(rows, "session_id bigint, ts bigint, query string")
    batch = sorted(tuple(r) for r in SP.suggest(log, stats).collect())
    assert batch == [(1, 4, "recieve", "receive"), (1, 8, "recieve", "receive"), (2, 7, "teh", "the")]
    assert arrivals(spark, log, stats, [4]) == batch


def test_suggest_stream_with_nulls_a_long_session_and_restarts(spark):
    rng = random.Random(2)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}xyz" for i in range(30)]
    stats = spark.createDataFrame([(w, 10 + i) for i, w in enumerate(words)], "term string, cf bigint")
    rows = [(i, None, words[0][0] + words[0][2:]) for i in (1, 2)] + [(None, None, "lost"), (3, 0, None)]
    for ts in range(1, 600):
        session = 1 if ts % 3 == 0 else rng.choice([None, 2, 3, 4, 5])
        w = rng.choice(words[:8])
        rows.append((session, ts, rng.choice([w, w[0] + w[2:], f"{w} more", None])))
    log = spark.createDataFrame(rows, "session_id bigint, ts bigint, query string")
    want = sorted((tuple(r) for r in SP.suggest(log, stats).collect()), key=str)
    assert len(want) > 50 and {r[0] for r in want} >= {None, 1, 2}
    assert sorted(arrivals(spark, log, stats, [150, 151, 400]), key=str) == want


def test_live_indexer_resumes_after_restart(spark):
    from pyspark.sql import functions as F

    from inkwell.operators import search as S
    from inkwell.streaming.live_index import LiveIndexer, run_live_indexer

    docs = spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma"), (3, "gamma delta")],
                                 "doc_id bigint, text string")
    changes = [
        ("docs/2.xml", "changed", "beta beta omega", 1),
        ("docs/4.xml", "changed", "omega alpha", 1),
        ("docs/3.xml", "removed", None, 2),
        ("docs/4.xml", "changed", "omega", 2),
    ]
    schema = "path string, change string, content string, signature string, batch bigint"
    rows = [(p, c, t, None, b) for p, c, t, b in changes]
    queries = spark.createDataFrame([(0, "omega"), (1, "beta"), (2, "gamma"), (3, "")],
                                    "query_id bigint, query string")

    def run(base, batches, restart):
        log, ckpt = f"{base}/log", f"{base}/ckpt"
        idx = LiveIndexer(spark, base, threshold=2)
        idx.init_main(docs)
        for b in batches:
            for r in (r for r in rows if r[4] == b):  # a publisher's batch in several files
                spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(log)
            if restart:
                idx = LiveIndexer(spark, base, threshold=2)   # a new driver reads the pointer
                run_live_indexer(idx, log, ckpt)
        if not restart:
            run_live_indexer(idx, log, ckpt)
        return sorted(tuple(r) for r in S.search(idx.live(), queries).collect()), idx

    staged, idx = run(work_dir(spark, "t-live-a"), [1, 2], restart=True)
    at_once, _ = run(work_dir(spark, "t-live-b"), [1, 2], restart=False)
    assert staged == at_once
    assert idx.main_version >= 2          # the threshold was crossed and a merge happened
    got = {q: {d for qq, d, *_ in staged if qq == q} for q in range(4)}
    assert got[0] == {2, 4} and got[1] == {1, 2}
    assert got[2] == set()                 # doc 2 was rewritten, doc 3 removed
    assert got[3] == {1, 2, 4}             # empty query: every live document


CHANGES = "path string, change string, content string, signature string, batch bigint"


def _indexer(spark, name, docs=((1, "alpha beta"), (2, "beta gamma"))):
    from inkwell.streaming.live_index import LiveIndexer
    idx = LiveIndexer(spark, work_dir(spark, name), threshold=1000)
    idx.init_main(spark.createDataFrame(list(docs), "doc_id bigint, text string"))
    return idx


def test_split_batch_keeps_all_rows_and_replay_changes_nothing(spark):
    idx = _indexer(spark, "t-split")
    parts = [spark.createDataFrame([(f"docs/{10 * k + i}.xml", "changed", f"word{k}{i}", None, 1) for i in range(4)],
                                   CHANGES) for k in range(5)]
    for batch_id, part in enumerate(parts):
        idx.process(part, batch_id)
    idx.process(parts[-1], 4)  # the last micro-batch again
    assert idx.delta().count() == 20 and idx.latest().count() == 20
    steps = {(r["name"], r["batch_id"]): r["input_rows"] for r in idx.timings().collect()}
    assert steps == {("build", 0): 2, **{("delta", b): 4 for b in range(5)}}


def test_unreadable_delta_is_an_error(spark):
    import glob

    import pytest
    idx = _indexer(spark, "t-damaged")
    assert idx.delta().count() == 0  # none yet
    idx.process(spark.createDataFrame([("docs/9.xml", "changed", "omega", None, 1)], CHANGES), 0)
    for f in glob.glob(idx.delta_path().replace("file:", "") + "/**/*.parquet", recursive=True):
        with open(f, "wb") as out:
            out.write(b"not parquet at all")
    spark.catalog.clearCache()
    with pytest.raises(Exception, match="FAILED_READ_FILE|Checksum|not a Parquet"):
        idx.search(spark.createDataFrame([(0, "omega")], "query_id bigint, query string")).collect()


def test_xml_changes_use_the_number_in_the_document(spark):
    idx = _indexer(spark, "t-xml")
    xml = "<DOC><DOCNO>doc-7</DOCNO><TITLE>t</TITLE><AUTHOR></AUTHOR><BIBLIO></BIBLIO><TEXT>omega &amp; more</TEXT></DOC>"
    idx.process(spark.createDataFrame([("docs/5.xml", "changed", xml, None, 1), ("docs/2.xml", "removed", None, None, 1)],
                                      CHANGES), 0)
    queries = spark.createDataFrame([(0, "omega"), (1, "gamma"), (2, "")], "query_id bigint, query string")
    got = sorted((r["query_id"], r["doc_id"]) for r in idx.search(queries).collect())
    assert got == [(0, 7), (2, 1), (2, 7)]
    assert idx.latest().filter("doc_id = 7").first()["text"] == "t\nomega & more\n"


def test_pointer_survives_an_incomplete_switch(spark):
    import os

    from inkwell.streaming.live_index import LiveIndexer
    idx = _indexer(spark, "t-pointer")
    idx.process(spark.createDataFrame([("docs/9.xml", "changed", "omega", None, 1)], CHANGES), 0)
    idx.merge()
    os.makedirs(f"{idx.base.replace('file:', '')}/pointer/v=99/_temporary")  # a writer that died
    again = LiveIndexer(spark, idx.base)
    assert (again.main_version, again.delta_version) == (2, 2)
    assert {r["doc_id"] for r in again.search(spark.createDataFrame([(0, "omega")], "query_id bigint, query string")).collect()} == {9}


def test_merges_leave_one_main_version_and_what_the_pointer_lists(spark):
    import glob
    idx = _indexer(spark, "t-versions")
    for batch_id, text in enumerate(["omega", "omega psi"]):
        idx.process(spark.createDataFrame([("docs/9.xml", "changed", text, None, batch_id + 1)], CHANGES), batch_id)
        idx.merge(batch_id)
    base = idx.base.replace("file:", "")
    assert [p.rsplit("/", 1)[1] for p in glob.glob(f"{base}/main/v=*")] == ["v=3"]
    assert glob.glob(f"{base}/delta/d=*") == []
    queries = spark.createDataFrame([(0, "psi"), (1, "beta"), (2, "")], "query_id bigint, query string")
    got = sorted((r["query_id"], r["doc_id"]) for r in idx.search(queries).collect())
    assert got == [(0, 9), (1, 1), (1, 2), (2, 1), (2, 2), (2, 9)]
