"""C6/C9 as a stream: snapshots of signatures come in, changes go out.

A snapshot (all watched paths with their signatures) is appended to a log as it
is taken, closed by a mark of its own.  Every row waits for the next snapshot's
row of its path: the log, shifted by one snapshot, meets itself in a full outer
stream-stream join on (path, snapshot).  A row without a predecessor is an added
file, one without a successor a removed file, a pair with another signature a
changed one.  State is kept per path by Spark's own join operator and ends with
the watermark, which the mark moves past its snapshot, so that it never holds
more than two snapshots; a restarted stream goes on from its checkpoint.

Snapshots are numbered without gaps and closed in order; one that was not closed
(its publisher died) is complete when the next one begins.  The first snapshot's
files are all added.  A publisher that died may publish its snapshot again: of a
path's rows in one snapshot the first counts.  Rows without a path are not
watched; null signatures compare null-safely, as in ``diff_signatures``; other
columns are left out.  An empty snapshot is its mark alone: every file is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_SCHEMA = "snapshot bigint, path string, signature string, closed boolean"
CHANGES_SCHEMA = "snapshot bigint, path string, change string, signature string"
# A snapshot is one second of event time.  The watermark trails its rows by half
# a second, so they end its predecessor; its mark comes late enough to end it.
DELAY, MARK_AT = "500 milliseconds", 0.75


def write_snapshot(signatures: DataFrame, log_path: str, snapshot: int) -> None:
    """Append snapshot number ``snapshot`` and close it."""
    number = F.lit(snapshot).cast("bigint").alias("snapshot")
    signatures.filter(F.col("path").isNotNull()).select(
        number, "path", "signature", F.lit(False).alias("closed")).write.mode("append").parquet(log_path)
    signatures.sparkSession.range(1).select(
        number, F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("signature"),
        F.lit(True).alias("closed")).write.mode("append").parquet(log_path)


def _side(spark: SparkSession, log_path: str, shift: int, files_per_batch: int | None) -> DataFrame:
    r = spark.readStream.schema(SNAPSHOT_SCHEMA)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    at = F.timestamp_seconds(F.col("snapshot") + shift + F.when(F.col("closed"), MARK_AT).otherwise(0.0))
    return r.parquet(log_path).select("path", "signature", at.alias("at")) \
        .withWatermark("at", DELAY).dropDuplicatesWithinWatermark(["path", "at"])


def change_stream(spark: SparkSession, log_path: str, files_per_batch: int | None = None) -> DataFrame:
    """The unbounded frame of (snapshot, path, change, signature)."""
    new = _side(spark, log_path, 0, files_per_batch).alias("n")
    old = _side(spark, log_path, 1, files_per_batch).alias("o")
    met = new.join(old, (F.col("n.path") == F.col("o.path")) & (F.col("n.at") == F.col("o.at")), "full_outer")
    change = (F.when(F.col("o.at").isNull(), "added").when(F.col("n.at").isNull(), "removed")
              .when(~F.col("o.signature").eqNullSafe(F.col("n.signature")), "changed"))
    return met.select(
        F.unix_seconds(F.coalesce("n.at", "o.at")).alias("snapshot"),
        F.coalesce("n.path", "o.path").alias("path"), change.alias("change"),
        F.col("n.signature").alias("signature"),
    ).filter(F.col("path").isNotNull() & F.col("change").isNotNull())


def run_change_stream(spark: SparkSession, log_path: str, out_path: str, checkpoint: str,
                      files_per_batch: int | None = None, available_now: bool = True):
    """Write the changes as Parquet, each exactly once.  With ``available_now``
    the stream takes what the log holds and stops, and all changes so far are
    returned; else the running query is."""
    w = change_stream(spark, log_path, files_per_batch).writeStream.format("parquet") \
        .option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="3 seconds")
    q = w.start()
    if not available_now:
        return q
    q.awaitTermination()
    return spark.read.schema(CHANGES_SCHEMA).parquet(out_path)
