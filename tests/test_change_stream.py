"""The change stream against diff_signatures of every two consecutive snapshots."""
import pytest
from pyspark.sql import functions as F

from inkwell.operators.changes import diff_signatures
from inkwell.session import work_dir
from inkwell.streaming import changes as CS

SCHEMA = "path string, signature string"
SNAPSHOTS = [
    [("a", "1"), ("b", "2"), ("n", None), ("r", "9"), (None, "0")],
    [("a", "1"), ("b", "3"), ("n", None), ("c", "4")],
    [],
    [("a", "1"), ("n", "5"), ("r", "9")],
    [("a", None), ("n", "5"), ("r", "9")],
]


def _expected(spark, snapshots):
    frames = [spark.createDataFrame([r for r in rows if r[0] is not None], SCHEMA) for rows in [[], *snapshots]]
    out = set()
    for n, (old, new) in enumerate(zip(frames, frames[1:]), 1):
        out |= {(n, r.path, r.change, r.signature) for r in diff_signatures(old, new).collect()}
    return out


def _rows(df):
    rows = [(r.snapshot, r.path, r.change, r.signature) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("restarts", [False, True])
def test_stream_equals_the_diffs(spark, restarts):
    """All snapshots in one run, file by file, or the stream restarted after each."""
    base = work_dir(spark, "t-changes")
    run = lambda: CS.run_change_stream(
        spark, f"{base}/log", f"{base}/out", f"{base}/checkpoint", files_per_batch=None if restarts else 2)
    for n, rows in enumerate(SNAPSHOTS, 1):
        CS.write_snapshot(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"{base}/log", n)
        if restarts:
            assert _rows(run()) == _expected(spark, SNAPSHOTS[:n])
    assert _rows(run()) == _expected(spark, SNAPSHOTS)
    assert _rows(run()) == _expected(spark, SNAPSHOTS)  # nothing new: nothing twice


def test_a_snapshot_published_twice_and_one_left_open(spark):
    """A publisher that died before the mark: its snapshot is complete when the
    next begins; one that publishes again adds nothing."""
    base = work_dir(spark, "t-changes")
    log = f"{base}/log"
    run = lambda: CS.run_change_stream(spark, log, f"{base}/out", f"{base}/checkpoint")
    frames = [spark.createDataFrame(rows, SCHEMA).coalesce(1) for rows in SNAPSHOTS[:2]]
    frames[0].filter(F.col("path").isNotNull()).select(
        F.lit(1).cast("bigint").alias("snapshot"), "path", "signature", F.lit(False).alias("closed")
    ).write.mode("append").parquet(log)
    assert _rows(run()) == set()
    CS.write_snapshot(frames[0], log, 1)
    assert _rows(run()) == _expected(spark, SNAPSHOTS[:1])
    CS.write_snapshot(frames[1], log, 2)
    assert _rows(run()) == _expected(spark, SNAPSHOTS[:2])
