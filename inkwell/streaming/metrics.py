"""Timings of batch jobs as a DataFrame; micro-batches write theirs in the
same schema (``LiveIndexer.timings``).

The rows of a step are counted by the job itself (``observe``): the executors'
accumulators bring the number, so that nothing is counted in a second pass."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkwell.session import shuffles_freed

METRICS_SCHEMA = "name string, batch_id bigint, input_rows bigint, duration_ms bigint"


class Timer:
    """Wall-clock timings of named batch steps (build, query, merge, ...)."""

    def __init__(self):
        self.rows: list[tuple] = []

    @contextmanager
    def step(self, name: str, rows: int = 0):
        t0 = time.time()
        yield
        self.rows.append((name, len(self.rows), rows, int((time.time() - t0) * 1000)))

    def run(self, name: str, df: DataFrame, path: str | None = None, began: float | None = None) -> DataFrame:
        """Run ``df`` once, into a Parquet folder (read back) or into nothing,
        and note its time (from ``began``, if work went before) and the rows it gave."""
        seen = Observation()
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        t0 = time.monotonic() if began is None else began
        with shuffles_freed(df.sparkSession):
            if path:
                watched.parquet(path)
            else:
                watched.format("noop").save()
        ms = int((time.monotonic() - t0) * 1000)
        # A plan that is found empty before it runs observes nothing.
        self.rows.append((name, len(self.rows), int(seen.get.get("rows", 0)), ms))
        return df.sparkSession.read.schema(df.schema).parquet(path) if path else df

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, METRICS_SCHEMA)


def progress_rows(query) -> list[tuple]:
    """The micro-batches that a streaming query remembers, in the same schema."""
    return [("micro-batch", p.batchId, p.numInputRows, p.durationMs["triggerExecution"])
            for p in query.recentProgress]
