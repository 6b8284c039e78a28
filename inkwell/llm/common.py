"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.session import ensure_checkpoint_dir, ship_package, table_path, work_dir

# ASCII white space that separates words: blank and \t \n \v \f \r.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_GAP_CHARS = " \t\n\x0b\x0c\r"

# Arrow batches to Python workers end at whichever bound comes first, so a
# batch of very long texts stays small.
ARROW_ROWS, ARROW_BYTES = 4096, 16 << 20


def prepare(spark: SparkSession, arrow_bytes: int = ARROW_BYTES) -> None:
    """Shared folder, package on the workers, bounded Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(arrow_bytes))


_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]):
    """What a Python worker keeps from one of its tasks to the next: one thing
    at a time, so that a stage does not hold what an earlier one has kept."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release(forget: bool = False) -> None:
    """Give a worker's free memory back to the machine at a task's end; with
    ``forget`` also what it kept."""
    if forget:
        _KEPT.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the
    lineage, survives lost executors, and later readers see fixed rows."""
    spark = df.sparkSession
    path = f"{work_dir(spark, name)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow string column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def frame(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of one
    string column at most (a single longer text stays whole)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.array(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        group = np.cumsum(sizes) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_or_empty(col="text"):
    return F.coalesce(F.col(col), F.lit(""))


# Unicode white space; str.split() also splits at the four separators 1C-1F.
_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
_SEPARATORS = re.compile("[\\x1c-\\x1f]")


def chunks(text: str) -> list[str]:
    """Runs of characters other than Unicode white space."""
    if _SEPARATORS.search(text):
        return [c for c in _SPACE.split(text) if c]
    return text.split()
