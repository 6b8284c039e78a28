"""Change detection by comparing content signatures of two snapshots.

A snapshot is ``signatures(path, method, signature)``; the diff is a full
outer join on path (null-safe comparison), labelled added / changed /
removed.  Changed and added files are appended, with their content, to a
Parquet change log that the live indexer reads as a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.signatures import signature
from inkwell.session import stored

CHANGE_LOG_SCHEMA = "path string, change string, content string, signature string, batch bigint"


def file_signatures(spark: SparkSession, path: str, method: str = "MD5",
                    glob: str | None = None) -> DataFrame:
    """C1-C4 over files: one row per file below ``path`` (binaryFile source)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    return files.select(F.col("path"), F.lit(method).alias("method"),
                        signature("content", method, "modificationTime").alias("signature"))


def content_signatures(df: DataFrame, method: str | None = None, path_col: str = "path",
                       content_col: str = "content", method_col: str = "method") -> DataFrame:
    """C1/C2/C4/C5 over (path, content) rows; ``method`` fixed or per row."""
    m = F.lit(method) if method else F.col(method_col)
    return df.select(F.col(path_col).alias("path"), m.alias("method"),
                     signature(content_col, m).alias("signature"))


def watch_set(files: DataFrame, default_method: str = "MD5") -> DataFrame:
    """(path, method) rows; a missing method falls back to the default.  A
    ``content`` column is carried along, so signing needs no second read."""
    return files.select("path", F.coalesce(F.col("method"), F.lit(default_method)).alias("method"),
                        *[c for c in files.columns if c == "content"])


def diff_signatures(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, change) for files added, changed or removed between two
    snapshots (null signatures compare null-safely)."""
    o = old.select("path", F.col("signature").alias("old_sig"), F.lit(True).alias("in_old"))
    n = new.select("path", F.col("signature").alias("new_sig"), F.lit(True).alias("in_new"))
    j = o.join(n, "path", "full_outer")
    change = (F.when(F.col("in_old").isNull(), F.lit("added"))
              .when(F.col("in_new").isNull(), F.lit("removed"))
              .when(~F.col("old_sig").eqNullSafe(F.col("new_sig")), F.lit("changed")))
    return j.select("path", change.alias("change"), "new_sig").filter(
        F.col("change").isNotNull()).withColumnRenamed("new_sig", "signature")


def staged_signatures(files: DataFrame, baseline: DataFrame | None = None, method: str | None = None) -> DataFrame:
    """C1/C5 in stages: (path, method, n_bytes, quick, signature, digested).

    A first pass takes each content's length and a 64-bit hash of it, both cheap
    and narrow.  Files that have both, and their method, from ``baseline`` (an
    earlier result) keep its signature; only the contents of the others are read
    again and digested.  A path occurs once in a snapshot.  Without a baseline
    all files are digested.  A null content has null length and signature; it
    differs from an empty one.  Modification times are no content (``method``
    "mtime" gives null).
    """
    content = F.col("content").cast("binary")
    named = files.select("path", (F.lit(method) if method else F.col("method")).alias("method"), "content",
                         F.octet_length(content).cast("bigint").alias("n_bytes"), F.xxhash64(content).alias("quick"))
    marks = named.drop("content")
    if baseline is None:
        baseline = marks.withColumn("signature", F.lit(None).cast("string")).limit(0)
    old = baseline.select("path", *[F.col(c).alias(f"old_{c}") for c in ("method", "n_bytes", "quick", "signature")])
    equal = F.col("old_quick").isNotNull()
    for c in ("method", "n_bytes", "quick"):
        equal &= F.col(c).eqNullSafe(F.col(f"old_{c}"))
    judged = stored(marks.join(old, "path", "left").select(
        *marks.columns, equal.alias("equal"), "old_signature"), "staged")
    kept = judged.filter("equal").select(*marks.columns, F.col("old_signature").alias("signature"),
                                         F.lit(False).alias("digested"))
    # The suspicious paths are few or many by their stored size: the planner
    # broadcasts them to the contents, or reduces the contents by a filter.
    fresh = named.join(judged.filter(~F.col("equal")).select("path"), "path", "left_semi").select(
        *marks.columns, signature("content", F.col("method")).alias("signature"), F.lit(True).alias("digested"))
    return kept.unionByName(fresh)


def digests_by_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """(change, n_files, n_digested) of a staged snapshot against its baseline:
    how many signatures were computed, by what became of the files."""
    diff = diff_signatures(old, new).select("path", "change")
    files = new.select("path", "digested").join(diff, "path", "full_outer")
    return files.groupBy(F.coalesce("change", F.lit("unchanged")).alias("change")).agg(
        F.count("*").alias("n_files"), F.count_if(F.coalesce("digested", F.lit(False))).alias("n_digested"))


def commit_baseline(new: DataFrame, base_path: str, version: int) -> DataFrame:
    """Store ``new`` as the baseline version (a new folder; earlier
    versions stay readable) and return it read back."""
    path = f"{base_path.rstrip('/')}/signatures/v={version}"
    new.write.mode("overwrite").parquet(path)
    return new.sparkSession.read.parquet(path)


def publish_changes(diff: DataFrame, contents: DataFrame, log_path: str, batch: int) -> None:
    """Append (path, change, content, signature, batch) rows to the change
    log; removed files carry no content (a tombstone)."""
    rows = diff.join(contents.select("path", "content"), "path", "left").select(
        "path", "change",
        F.when(F.col("change") == "removed", F.lit(None).cast("string")).otherwise(
            F.col("content")).alias("content"),
        "signature", F.lit(batch).cast("bigint").alias("batch"))
    rows.write.mode("append").parquet(log_path)


def read_change_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(CHANGE_LOG_SCHEMA).parquet(log_path)
