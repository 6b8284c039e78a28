"""Corpus pipeline: documents -> toxicity -> quality rules -> SimHash
near-dedup -> suffix-array dedup -> best-fit packing.

Every stage takes (spark, docs, sf_dir), works on all that the stage before
kept, and returns the columns of documents, the last one the packed pieces.
``run`` writes each stage's rows as Parquet below the shared folder and reads
them back as the next one's docs, so a lost executor costs one stage at most.

* toxicity: rejects documents predicted toxic (score of 0.5 or more).
* quality: rejects documents that fail the base rules or the decision list.
* near_dedup: of each component the row with the smallest doc_id stays (ties:
  the smallest text), rows without a doc_id only if there is no other.
* repeats: repeated spans are cut out of the texts.  Bytes of a character that
  was cut in half go too; n_chars is counted anew; a text that is cut empty
  stays as an empty text, a null text stays null.
* packing: pieces of token sequences.

No ORACLE_SQL: SQL can express neither the learned stages nor SimHash.  The
tests compare the stages with brute force on a small table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import packing, quality, simhash, suffix, toxicity
from inkwell.llm.common import prepare, read, stored
from inkwell.llm.queries import tokenizer_path

# Five stages share an executor's memory: smaller batches to Python workers, and
# fewer tokens kept there, than the single queries have.
ARROW_BYTES, KEPT_BYTES = 4 << 20, 16 << 20
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, ARROW_BYTES)
    crf = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, crf, COLUMNS).filter("predicted = 0").select(*COLUMNS)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, ARROW_BYTES)
    rules = quality.learn(quality.labelled_sample(docs, read(spark, sf_dir, "labels")))
    return quality.annotate(docs.select(*COLUMNS), rules).filter("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component.  The rows to keep are found on ids, text
    hashes and fingerprints; texts take part in one join."""
    prepare(spark, ARROW_BYTES)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark"))
    keep = simhash.grouped(docs).groupBy("root").agg(least.alias("one")).select("one.doc_id", "one.mark")
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rows = docs.select(*COLUMNS, key.alias("_key"), F.xxhash64("text").alias("_mark"))
    keep = keep.select(key.alias("_key"), F.col("mark").alias("_mark"))
    # A repeated row stays once.
    return rows.join(keep, ["_key", "_mark"], "left_semi").dropDuplicates(["_key", "_mark"]).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, ARROW_BYTES)
    at = COLUMNS.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if old is None else kept.decode("utf-8", errors="ignore") for old, kept in zip(
                batch.column(at).to_pylist(), batch.column(len(COLUMNS)).to_pylist())]
            cols = [batch.column(i) for i in range(len(COLUMNS))]
            cols[at] = pa.array(texts, pa.string())
            cols[COLUMNS.index("n_chars")] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names=COLUMNS)

    cut = suffix.remove_repeats(docs.select(*COLUMNS))
    untouched = cut.filter("n_removed = 0").select(*COLUMNS)
    schema = docs.select(*COLUMNS).schema
    changed = cut.filter("n_removed > 0").select(*COLUMNS, "kept").mapInArrow(run, schema)
    return untouched.unionByName(changed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, ARROW_BYTES)
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), kept_bytes=KEPT_BYTES)


STAGES = [("toxicity", drop_toxic), ("quality", drop_low_quality), ("near_dedup", drop_near_duplicates),
          ("repeats", cut_repeats), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark, ARROW_BYTES)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
