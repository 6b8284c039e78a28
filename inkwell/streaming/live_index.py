"""Live indexer as a Structured Streaming job over the change log.

* L1: the change log (Parquet, appended by the change detector) is read as a
  stream; each change row carries the publisher's batch number, which is its
  ``index_seq`` (arrival order, independent of how files group into
  micro-batches).
* S3-S6: a change whose content is a DOC element is parsed; its number and
  body come from the element.  Other contents are plain text, with the number
  in the file name.  A removal has no content and is known by its file name.
* L2/S9: ``foreachBatch`` writes the batch into the delta store partitioned
  by (index_seq, micro-batch) with dynamic partition overwrite: a replayed
  micro-batch rewrites its own rows, and a publisher's batch that spans
  several files, hence several micro-batches, keeps all of its rows.
* L9: every micro-batch and merge leaves its timing in the ``timings`` table.
* L7/L8: when more distinct files than the threshold sit in the delta, the
  live view is written as the next main version, then a fresh delta folder
  is started; pointer ``v=N`` records both in a folder of its own, and a
  restarted job resumes from the highest one that is complete.  What the
  pointer no longer lists is dropped, so two main versions are stored at most.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import normalize_docno
from inkwell.operators.changes import CHANGE_LOG_SCHEMA
from inkwell.operators.live import latest_delta, live_index, live_search, needs_merge
from inkwell.operators.postings import Index, build_postings, read_index, write_index
from inkwell.sources.corpus import build_docs, parse_xml_column, write_delta_docs
from inkwell.streaming.metrics import METRICS_SCHEMA

DELTA_SCHEMA = "doc_id bigint, text string, path string, change string, index_seq int, stream_batch bigint"
POINTER_SCHEMA = "main_version int, delta_version int"


def read_change_stream(spark: SparkSession, log_path: str, files_per_batch: int | None = None) -> DataFrame:
    """L1: the change log as an unbounded stream of change rows."""
    r = spark.readStream.schema(CHANGE_LOG_SCHEMA)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(log_path)


def doc_id_of_path(path_col: str = "path"):
    return normalize_docno(F.regexp_extract(F.col(path_col), r"([^/]*)$", 1))


def _if_there(read, otherwise):
    """``read()``, or ``otherwise()`` if its path does not exist (yet); any
    other error, such as a damaged file, is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return otherwise()


def delta_rows(changes: DataFrame) -> DataFrame:
    """(doc_id, text, path, change, index_seq) of change rows."""
    rows = changes.select("path", "change", "content", F.col("batch").cast("int").alias("index_seq"))
    is_doc = F.coalesce(F.ltrim("content").startswith("<DOC"), F.lit(False))
    xml = parse_xml_column(rows.filter(is_doc))
    parsed = build_docs(xml, keep_cols=["path", "change", "index_seq"])
    plain = rows.filter(~is_doc).select(doc_id_of_path("path").alias("doc_id"), F.col("content").alias("text"),
                                        "path", "change", "index_seq")
    return plain.unionByName(parsed.select("doc_id", "text", "path", "change", "index_seq"))


class LiveIndexer:
    """State of the live index under ``base``: main versions and delta folders."""

    def __init__(self, spark: SparkSession, base: str, threshold: int = 10):
        self.spark = spark
        self.base = base.rstrip("/")
        self.threshold = threshold
        self.merges = 0
        ptr = self._read_pointer()
        self.main_version, self.delta_version = ptr if ptr else (1, 1)

    # -- storage layout ---------------------------------------------------
    def main_path(self, v: int | None = None) -> str:
        return f"{self.base}/main/v={v or self.main_version}"

    def delta_path(self) -> str:
        return f"{self.base}/delta/d={self.delta_version}"

    def _read_pointer(self):
        path = f"{self.base}/pointer"
        rows = _if_there(lambda: self.spark.read.schema(f"{POINTER_SCHEMA}, v int").json(path), lambda: None)
        row = rows.filter("main_version is not null").orderBy(F.desc("v")).first() if rows is not None else None
        return (row["main_version"], row["delta_version"]) if row else None

    def _write_pointer(self) -> None:
        # Versions only grow, so their sum numbers the pointers.
        v = self.main_version + self.delta_version
        self.spark.createDataFrame([(self.main_version, self.delta_version)], POINTER_SCHEMA) \
            .coalesce(1).write.mode("overwrite").json(f"{self.base}/pointer/v={v}")

    def _note(self, name: str, batch_id: int, rows: int, began: float) -> None:
        """One timing row in a folder of its own (a replay rewrites it)."""
        ms = int((time.time() - began) * 1000)
        self.spark.createDataFrame([(name, batch_id, rows, ms)], METRICS_SCHEMA) \
            .coalesce(1).write.mode("overwrite").parquet(f"{self.base}/timings/step={name}-{batch_id}")

    def timings(self) -> DataFrame:
        """(name, batch_id, input_rows, duration_ms) of all steps so far."""
        return self.spark.read.schema(METRICS_SCHEMA).parquet(f"{self.base}/timings").select(
            "name", "batch_id", "input_rows", "duration_ms")

    def init_main(self, docs: DataFrame) -> None:
        began = time.time()
        write_index(Index(docs=docs.select("doc_id", "text"),
                          postings=build_postings(docs.select("doc_id", "text"))),
                    self.main_path())
        self._note("build", 0, self.main().docs.count(), began)
        self._write_pointer()

    # -- per micro-batch -----------------------------------------------------
    def main(self) -> Index:
        return read_index(self.spark, self.main_path())

    def delta(self) -> DataFrame:
        return _if_there(lambda: self.spark.read.schema(DELTA_SCHEMA).parquet(self.delta_path()),
                         lambda: self.spark.createDataFrame([], DELTA_SCHEMA))

    def latest(self) -> DataFrame:
        return latest_delta(self.delta())

    def process(self, batch: DataFrame, batch_id: int) -> None:
        began = time.time()
        rows = delta_rows(batch).withColumn("stream_batch", F.lit(batch_id).cast("bigint"))
        write_delta_docs(rows, self.delta_path())
        self._note("delta", batch_id, self.delta().filter(F.col("stream_batch") == batch_id).count(), began)
        if needs_merge(self.delta(), self.threshold).first()["needs_merge"]:
            self.merge(batch_id)

    def merge(self, batch_id: int = 0) -> None:
        began = time.time()
        write_index(self.live(), self.main_path(self.main_version + 1))
        self._note("merge", batch_id, self.delta().count(), began)
        self.main_version += 1
        self.delta_version += 1
        self.merges += 1
        self._write_pointer()
        self.vacuum()

    def vacuum(self) -> list[str]:
        """Drop the main versions and deltas before those of the pointer: a merge
        writes a whole main version, so the disk would grow by the corpus with each.
        (Frames planned before a merge are to be planned again after it.)"""
        jvm, gone = self.spark._jvm, []
        for folder, keep in (("main/v", self.main_version), ("delta/d", self.delta_version)):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{folder.split('/')[0]}")
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in (fs.listStatus(path) if fs.exists(path) else []):
                name, _, number = status.getPath().getName().partition("=")
                if name == folder[-1] and number.isdigit() and int(number) < keep:
                    fs.delete(status.getPath(), True)
                    gone.append(f"{folder}={number}")
        return sorted(gone)

    def live(self) -> Index:
        """The current main version plus the current delta as one index."""
        return live_index(self.main(), self.delta())

    def search(self, queries: DataFrame) -> DataFrame:
        """Main and delta are searched each on its own and main's results
        are masked, so main's postings keep their bucket pruning."""
        return live_search(self.main(), self.delta(), queries)


def run_live_indexer(indexer: LiveIndexer, log_path: str, checkpoint: str,
                     files_per_batch: int | None = 1, available_now: bool = True):
    """Start the stream; with ``available_now`` it processes the log and stops."""
    stream = read_change_stream(indexer.spark, log_path, files_per_batch)
    w = stream.writeStream.foreachBatch(indexer.process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="3 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
