"""Headline timings at one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is forced to completion with the ``noop`` sink (full execution,
nothing collected to the driver).  Timings are wall-clock seconds in a warm
session, the median of BENCH_REPEATS runs (default 3); the index is built
and stored, then searched from storage.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from inkwell.operators import live as L  # noqa: E402
from inkwell.operators import postings as P  # noqa: E402
from inkwell.operators import search as S  # noqa: E402
from inkwell.operators import similar as W  # noqa: E402
from inkwell.operators import spelling as SP  # noqa: E402
from inkwell.session import local_session, work_dir  # noqa: E402
from inkwell.sources import workloads as WL  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="inkwell-bench")
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    times: dict[str, float] = {}
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    def timed(name, fn):
        runs = []
        for i in range(repeats):
            t0 = time.time()
            fn(i)
            runs.append(time.time() - t0)
        times[name] = round(statistics.median(runs), 3)

    # warm-up: JVM start, first scan and code generation
    run(WL.documents(spark, sf_dir).select(F.length("text")))

    base = work_dir(spark, "bench")
    # The test table is one file with one row group, i.e. one read task; the
    # bench spreads it over files once, as a large table is stored anyway.
    WL.documents(spark, sf_dir).repartition(2 * int(cpus)).write.parquet(f"{base}/documents")
    docs = spark.read.parquet(f"{base}/documents")
    idx_path = f"{base}/main/v=1"

    def build(_):
        P.write_index(P.build_index(docs), idx_path)

    timed("index_build", build)
    main_idx = P.read_index(spark, idx_path)
    stats = main_idx.stats
    queries = WL.workload(spark)
    for n in (1, 100):
        some = spark.range(n).select(F.col("id").alias("query_id"), F.lit('"in the" is').alias("query"))
        timed(f"search_{n}_queries", lambda _, q=some: run(S.search(main_idx, q)))
    timed("search", lambda _: run(S.search(main_idx, queries)))
    timed("search_report", lambda _: run(S.search_report(main_idx, queries)))
    delta = WL.delta_docs(docs)
    timed("live_search", lambda _: run(L.live_search(main_idx, delta, queries)))
    words = WL.similar_words_input(spark)
    timed("similar_first", lambda _: run(W.similar_words(docs, words, stats, "first")))
    timed("similar_all", lambda _: run(W.similar_words(docs, words, stats, "all")))
    log = WL.query_log(WL.read_table(spark, sf_dir, "events"), stats,
                       WL.read_table(spark, sf_dir, "conversations"))
    timed("suggest", lambda _: run(SP.suggest(log, stats)))
    timed("merge", lambda i: L.merge_delta(main_idx, delta, base, version=2 + i))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "repeats": repeats}))


if __name__ == "__main__":
    main()
