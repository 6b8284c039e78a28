"""Session and shared-storage helpers.

Jobs that write (index builds, merges, change logs, streaming checkpoints)
put their output under the shared folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests,
the bench) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "inkwell") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state."
                "RocksDBStateStoreProvider")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``inkwell`` importable in Python workers (pandas UDFs, grouped
    state functions are pickled by module reference): zip the package's
    Python files once per application and add the zip with ``addPyFile``."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="inkwell-pyfiles-"), "inkwell.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    root = checkpoint_root(spark)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="inkwell-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for one job's output."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/inkwell/{name}-{uuid.uuid4().hex[:12]}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# ZSTD level of stored texts.
TEXT_LEVEL = 9


@contextmanager
def shuffles_freed(spark: SparkSession):
    """What is written in this block drops its shuffle files as it ends: the rows are
    stored then, and files would stay until the driver happens to collect garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before) if before is not None else spark.conf.unset(_FREE_SHUFFLES)


def write_parquet(df: DataFrame, path: str, mode: str = "error", partition_by: str | None = None,
                  plain: tuple[str, ...] = (), level: int = 3) -> None:
    """Write ``df`` small: ZSTD (of a level), and the encodings of Parquet's second version, which
    store differences of sorted numbers and strings (``plain`` columns without a
    dictionary, so that they do)."""
    writer = (df.write.mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level))
              .option("parquet.writer.version", "v2"))
    for name in plain:
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with shuffles_freed(df.sparkSession):
        writer.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: the planner
    knows its size, later readers see fixed rows, and lost executors cost no
    more than a read."""
    path = f"{work_dir(df.sparkSession, name)}/t"
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"
