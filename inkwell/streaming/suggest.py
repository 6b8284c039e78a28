"""Spelling suggestions over an unbounded query log.

A micro-batch is handled by the batch operator's as-of lookups, which spread a
session over tasks however long it is; what earlier micro-batches have learnt
joins them as rows that precede every row of the batch:

* ``state/last``: the latest single-word query per session,
* ``state/corrections``: the latest correction per (session, word).

Each micro-batch writes its suggestions and the keys it changed into folders of
its own number, so a replayed one rewrites its own rows, and reads the newest
row per key of the folders before it, for the sessions that it holds.  State is
unbounded per session (the source system never forgets).

Rows of a session must arrive in the order of ts; rows without a ts count as
the earliest of their micro-batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators.spelling import is_single_word, latest_corrections, suggest_with
from inkwell.session import stored

LOG_SCHEMA = "session_id bigint, ts bigint, query string"
OUT_SCHEMA = "session_id bigint, ts bigint, query string, suggestion string"
LAST_SCHEMA = "session_id bigint, prev string"
CORRECTIONS_SCHEMA = "session_id bigint, word string, correction string"


class SuggestionState:
    """Suggestions and state below ``base``, one folder per micro-batch."""

    def __init__(self, spark: SparkSession, base: str, stats: DataFrame):
        self.spark, self.base, self.stats = spark, base.rstrip("/"), stats

    def _before(self, table: str, schema: str, keys: list[str], batch_id: int, sessions: DataFrame) -> DataFrame:
        """The newest row per key of earlier micro-batches, for these sessions."""
        try:
            rows = self.spark.read.schema(f"{schema}, batch bigint").parquet(f"{self.base}/state/{table}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        value = rows.columns[len(keys)]
        rows = rows.filter(F.col("batch") < batch_id)
        rows = rows.join(sessions, rows["session_id"].eqNullSafe(sessions["_session"]), "left_semi")
        return rows.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: suggestions, then the state that it changed."""
        log = stored(batch.select("session_id", "ts", "query"), "suggest-batch")
        sessions = log.select(F.col("session_id").alias("_session")).distinct()
        last = self._before("last", LAST_SCHEMA, ["session_id"], batch_id, sessions)
        known = self._before("corrections", CORRECTIONS_SCHEMA, ["session_id", "word"], batch_id, sessions)
        found, mined = suggest_with(log, self.stats, last, known)
        self._write(found, "out", batch_id)
        self._write(latest_corrections(mined).select("session_id", "word", "correction"), "state/corrections", batch_id)
        singles = log.filter(is_single_word("query")).groupBy("session_id").agg(
            F.max(F.struct("ts", "query")).alias("m"))
        self._write(singles.select("session_id", F.col("m.query").alias("prev")), "state/last", batch_id)

    def _write(self, rows: DataFrame, table: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.base}/{table}/batch={batch_id}")

    def suggestions(self) -> DataFrame:
        return self.spark.read.schema(f"{OUT_SCHEMA}, batch bigint").parquet(f"{self.base}/out").drop("batch")


def run_suggest_stream(spark: SparkSession, log_path: str, stats: DataFrame, base: str, checkpoint: str,
                       files_per_batch: int | None = None) -> DataFrame:
    """Take in what has arrived below ``log_path`` since the checkpoint; all
    suggestions so far."""
    state = SuggestionState(spark, base, stats)
    r = spark.readStream.schema(LOG_SCHEMA)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    q = (r.parquet(log_path).writeStream.foreachBatch(state.process)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return state.suggestions()
