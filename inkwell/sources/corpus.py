"""Document sources and sinks: XML documents, metadata, document store.

Source format: one ``<DOC>`` element per document with DOCNO, TITLE, AUTHOR,
BIBLIO and TEXT children, read with Spark's built-in XML source (a fixed
schema, no inference).  Many DOC elements per file and many files per folder
are both fine; change rows carrying XML text are parsed with ``from_xml``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from inkwell.functions.text import compose_body, doc_length, normalize_docno

DOC_FIELDS = ["DOCNO", "TITLE", "AUTHOR", "BIBLIO", "TEXT"]
DOC_SCHEMA = StructType([StructField(f, StringType(), True) for f in DOC_FIELDS])
ROW_TAG = "DOC"
ROOT_TAG = "DOCS"


def _blank_to_empty(df: DataFrame) -> DataFrame:
    """Empty or missing elements read as null; they are '' (D15)."""
    return df.select(*[F.coalesce(F.col(f), F.lit("")).alias(f) for f in DOC_FIELDS],
                     *[c for c in df.columns if c not in DOC_FIELDS])


def read_xml_docs(spark: SparkSession, path: str) -> DataFrame:
    """Every DOC element below ``path`` (a file, folder or glob),
    with the file it came from and that file's modification time."""
    df = (spark.read.schema(DOC_SCHEMA).option("rowTag", ROW_TAG).xml(path)
          .select(*DOC_FIELDS, F.col("_metadata.file_path").alias("file_path"),
                  F.col("_metadata.file_modification_time").alias("file_mtime")))
    return _blank_to_empty(df)


def docs_as_xml_records(documents: DataFrame) -> DataFrame:
    """The corpus in the source record shape: DOCNO 'doc-<id>', TITLE
    'T <id>', AUTHOR = source, empty BIBLIO, TEXT = text."""
    return documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("DOCNO"),
        F.concat(F.lit("T "), F.col("doc_id").cast("string")).alias("TITLE"),
        F.coalesce(F.col("source"), F.lit("")).alias("AUTHOR"),
        F.lit("").alias("BIBLIO"), F.col("text").alias("TEXT"))


def write_xml_docs(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").option("rowTag", ROW_TAG).option("rootTag", ROOT_TAG).xml(path)


def xml_text(records: DataFrame) -> F.Column:
    """One DOC element as XML text (for change rows carrying content)."""
    return F.to_xml(F.struct(*DOC_FIELDS), {"rowTag": ROW_TAG})


def parse_xml_column(df: DataFrame, content_col: str = "content") -> DataFrame:
    """S3: parse change rows whose content is one DOC element (no file listing
    on the driver: the content travels with the row)."""
    parsed = df.withColumn("_doc", F.from_xml(F.col(content_col), DOC_SCHEMA, {"rowTag": ROW_TAG}))
    out = parsed.select(*[F.col(f"_doc.{f}").alias(f) for f in DOC_FIELDS],
                        *[c for c in df.columns if c != content_col])
    return _blank_to_empty(out)


def build_docs(records: DataFrame, order_cols: list[str] | None = None,
               keep_cols: list[str] | None = None) -> DataFrame:
    """docs(doc_id, title, author, text, doc_length) from DOC records;
    with several records for one DOCNO the last (by ``order_cols``, e.g. the
    file path) wins.  Records without a number in their DOCNO are different
    documents without an id: all of them stay.  ``keep_cols`` (without an
    order) are carried along."""
    d = records.select(
        normalize_docno("DOCNO").alias("doc_id"),
        F.col("TITLE").alias("title"), F.col("AUTHOR").alias("author"),
        compose_body("TITLE", "TEXT", "AUTHOR").alias("text"),
        *[F.col(c) for c in (order_cols or keep_cols or [])])
    if order_cols:
        newest = d.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
            F.max(F.struct(*order_cols, "title", "author", "text")).alias("m"))
        d = newest.select("doc_id", "m.title", "m.author", "m.text").unionByName(
            d.filter(F.col("doc_id").isNull()).select("doc_id", "title", "author", "text"))
    return d.select("doc_id", "title", "author", "text", doc_length("text").alias("doc_length"),
                    *([] if order_cols else keep_cols or []))


def write_docs(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The document store (full overwrite)."""
    docs.write.mode(mode).parquet(path)


def write_delta_docs(delta: DataFrame, path: str) -> None:
    """Upsert a delta into the store partitioned by (index_seq,
    stream_batch): the publisher's batch and the micro-batch that brought the
    rows.  Dynamic partition overwrite replaces only the partitions present,
    so a replayed micro-batch rewrites its own rows, and a publisher's batch
    that arrives in several micro-batches keeps all of them."""
    if "stream_batch" not in delta.columns:
        delta = delta.withColumn("stream_batch", F.lit(0).cast("bigint"))
    (delta.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("index_seq", "stream_batch").parquet(path))
