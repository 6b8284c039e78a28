"""Positional inverted index as DataFrames (tokenise, counts, statistics).

The index is two DataFrames: ``docs(doc_id, text, ...)`` and
``postings(doc_id, pos, wpos, term)``.  Postings are generated per document
row (``posexplode`` of an array built with built-in functions), so building
them is a narrow, shuffle-free map over the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import begins_run, exploded, offset_of, placed_terms, run_starts, with_terms
from inkwell.session import TEXT_LEVEL, stored, write_parquet

# Number of hash buckets a stored index is partitioned by (term_bucket).
DEFAULT_TERM_BUCKETS = 64
# Columns of stored places, one row per term and document; ``gap`` is what wpos is ahead
# of pos at each place (null: nothing).
PACKED = ["term", "doc_id", "pos", "gap"]


@dataclass
class Index:
    """A searchable index: documents and their postings."""

    docs: DataFrame
    postings: DataFrame
    # Buckets of a stored index (None: postings are not bucketed).
    buckets: int | None = None
    counts: DataFrame | None = None  # stored term counts (doc_id, term, tf)
    stats: DataFrame | None = None  # stored term statistics (term, df, cf, idf)
    packed: DataFrame | None = None  # stored places (PACKED); postings and counts are views of it

    def all_docs(self) -> DataFrame:
        return all_docs(self.docs)


def build_postings(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per term occurrence: doc_id, pos (dense), wpos, term."""
    return (exploded(with_terms(docs, "doc_id", text_col=text_col), "doc_id", "_w")
            .select("doc_id", "pos", offset_of().alias("wpos"), "term"))


def by_repetition(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Documents whose id (null too) stands in one row, and the others (None if
    there are none).  What is grouped by document is known inside the rows of
    the first; only the others need a shuffle."""
    again = stored(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select(F.col("doc_id").alias("_id")), "repeated-ids")
    if again.isEmpty():
        return docs, None
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    return docs.join(again, same, "left_anti"), docs.join(again, same, "left_semi")


def counts_in_rows(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """(keep, term, tf) of every row: runs of equal terms in its sorted terms."""
    d = with_terms(docs, *keep, text_col=text_col).select(*keep, F.sort_array("_t").alias("_s"))
    d = d.select("*", run_starts("_s", lambda t: t).alias("_starts"))
    d = exploded(d, *keep, "_s", "_starts", array="_starts", pos="_k", value="_at")
    end = F.coalesce(F.get("_starts", F.col("_k") + 1), F.size("_s"))
    return d.select(*keep, F.get("_s", F.col("_at")).alias("term"), (end - F.col("_at")).cast("bigint").alias("tf"))


def counts_of_docs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """I2 from the texts: counted inside the documents' rows, without a shuffle
    of postings; documents of several rows are counted together."""
    docs = docs.select("doc_id", F.col(text_col).alias("text"))
    single, several = by_repetition(docs)
    counts = counts_in_rows(single, "doc_id")
    if several is None:
        return counts
    return counts.unionByName(counts_in_rows(several, "doc_id").groupBy("doc_id", "term").agg(F.sum("tf").alias("tf")))


def packed_of_docs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """I3 from the texts, likewise."""
    docs = docs.select("doc_id", F.col(text_col).alias("text"))
    single, several = by_repetition(docs)
    d = with_terms(single, "doc_id").select("doc_id", placed_terms().alias("_s"))
    d = d.select("*", run_starts("_s", lambda x: x["term"]).alias("_starts"),
                 F.transform("_s", lambda x: x["pos"]).alias("_pos"))
    d = exploded(d, "doc_id", "_s", "_pos", "_starts", array="_starts", pos="_k", value="_at")
    tf = F.coalesce(F.get("_starts", F.col("_k") + 1), F.size("_s")) - F.col("_at")
    packed = d.select(F.get("_s", F.col("_at"))["term"].alias("term"), "doc_id", tf.cast("bigint").alias("tf"),
                      F.slice("_pos", F.col("_at") + 1, tf).alias("positions"))
    if several is None:
        return packed
    return packed.unionByName(packed_postings(build_postings(several)))


def build_index(docs: DataFrame, text_col: str = "text") -> Index:
    return Index(docs=docs, postings=build_postings(docs, text_col))


def term_counts(postings: DataFrame) -> DataFrame:
    """Occurrences of each term in each document."""
    return postings.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def packed_postings(postings: DataFrame) -> DataFrame:
    """Term, doc_id, tf, sorted positions (bounded by one document's length)."""
    return postings.groupBy("term", "doc_id").agg(
        F.count("*").alias("tf"),
        F.array_sort(F.collect_list("pos")).alias("positions"))


def all_docs(docs: DataFrame) -> DataFrame:
    """The distinct document ids of an index."""
    return docs.select("doc_id").distinct()


def term_stats(postings: DataFrame, docs: DataFrame) -> DataFrame:
    """I4: document frequency, collection frequency and idf = ln(N / df).

    Two-level aggregation (per document, then per term) instead of a
    distinct count; both levels combine map-side, so stop words do not
    concentrate raw postings in one task.  N is a scalar subquery.
    """
    return stats_of_counts(term_counts(postings), docs)


def stats_of_counts(counts: DataFrame, docs: DataFrame) -> DataFrame:
    """I4 from term counts."""
    return _with_idf(counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")), docs)


def _with_idf(stats: DataFrame, docs: DataFrame) -> DataFrame:
    n_docs = all_docs(docs).agg(F.count("*")).scalar()
    return stats.withColumn("idf", F.round(F.log(n_docs / F.col("df")), 6))


def stats_of_docs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """I4 from the texts: one aggregation by term that combines before its
    shuffle; postings and counts per document are not shuffled.  A row's sorted
    terms count for df where a run of equal ones begins, each for cf."""
    texts = docs if {"_t", "_w"} <= set(docs.columns) else docs.select("doc_id", F.col(text_col).alias("text"))
    single, several = by_repetition(texts)
    d = exploded(with_terms(single).select(F.sort_array("_t").alias("_s")), "_s", array="_s")
    parts = d.select("term", begins_run("_s", "pos", lambda t: t).cast("bigint").alias("df"),
                     F.lit(1).cast("bigint").alias("cf"))
    if several is not None:
        parts = parts.unionByName(counts_in_rows(several, "doc_id").groupBy("doc_id", "term").agg(
            F.sum("tf").alias("cf")).select("term", F.lit(1).cast("bigint").alias("df"), "cf"))
    return _with_idf(parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")), docs)


def term_bucket(term, buckets: int = DEFAULT_TERM_BUCKETS):
    col = F.col(term) if isinstance(term, str) else term
    return F.pmod(F.crc32(F.encode(col, "UTF-8")), F.lit(buckets)).cast("int")


def places_in_rows(docs: DataFrame) -> DataFrame:
    """(term, doc_id, pos, gap): the places of each term in each row's text."""
    d = with_terms(docs, "doc_id").select("doc_id", "_w", placed_terms().alias("_s"))
    d = d.select("*", run_starts("_s", lambda x: x["term"]).alias("_starts"),
                 F.transform("_s", lambda x: x["pos"]).alias("_pos"))
    # In the order of the sorted terms, so that both are cut at the same places.
    d = d.withColumn("_gap", F.when(F.col("_w").isNotNull(), F.transform("_pos", lambda p: F.get("_w", p) - p)))
    d = exploded(d, "doc_id", "_s", "_pos", "_gap", "_starts", array="_starts", pos="_k", value="_at")
    tf = F.coalesce(F.get("_starts", F.col("_k") + 1), F.size("_s")) - F.col("_at")
    return d.select(F.get("_s", F.col("_at"))["term"].alias("term"), "doc_id",
                    *[F.slice(f"_{c}", F.col("_at") + 1, tf).alias(c) for c in ("pos", "gap")])


def packed_places(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, doc_id, pos, gap): all places of a term in a document, from the texts.
    A narrow map: nothing is shuffled but what documents of several rows hold."""
    single, several = by_repetition(docs.select("doc_id", F.col(text_col).alias("text")))
    packed = places_in_rows(single)
    return packed if several is None else packed.unionByName(pack(build_postings(several)))


def pack(postings: DataFrame) -> DataFrame:
    """(term, doc_id, pos, gap) of postings, grouped by a shuffle."""
    places = F.array_sort(F.collect_list(F.struct("pos", (F.col("wpos") - F.col("pos")).alias("gap"))))
    return postings.groupBy("term", "doc_id").agg(places.alias("_p")).select(
        "term", "doc_id", F.col("_p.pos").alias("pos"), F.col("_p.gap").alias("gap"))


def unpacked(packed: DataFrame) -> DataFrame:
    """(doc_id, pos, wpos, term, term_bucket): the postings of stored places."""
    rows = packed.select("doc_id", "term", "term_bucket", "gap", F.posexplode("pos").alias("_k", "_pos"))
    ahead = F.coalesce(F.get("gap", F.col("_k")), F.lit(0))
    return rows.select("doc_id", F.col("_pos").alias("pos"), (F.col("_pos") + ahead).alias("wpos"), "term", "term_bucket")


def packed_counts(packed: DataFrame) -> DataFrame:
    """I2 from stored places: they hold one row per document and term."""
    return packed.select("doc_id", "term", F.size("pos").cast("bigint").alias("tf"))


def write_packed(packed: DataFrame, path: str, buckets: int, mode: str = "overwrite", doc: str = "doc_id") -> None:
    """Store places by term bucket.  Each task sorts its own rows and writes them to a
    file per bucket, so no posting is shuffled, whatever the size of the corpus, and
    a common term is spread over the files of its bucket.  Sorted by term and
    document, terms and document numbers are stored as differences."""
    rows = packed.withColumn("term_bucket", term_bucket("term", buckets)).sortWithinPartitions("term_bucket", "term", doc)
    write_parquet(rows, path, mode, "term_bucket", plain=("term", doc, "pos.list.element"))


def write_index(index: Index, path: str, buckets: int = DEFAULT_TERM_BUCKETS,
                mode: str = "overwrite") -> None:
    """Store docs, the places of each term in each document, term statistics
    and the number of buckets.

    Places are partitioned by term bucket (search prunes buckets) and sorted by
    term inside a file, so row-group statistics prune term lookups.  Postings
    and term counts are views of them (``read_index``).  They come from the
    documents' texts, or from stored places if the index holds some; the
    statistics from what is stored, so the text is tokenised once."""
    spark = index.docs.sparkSession
    write_parquet(index.docs, f"{path}/docs", mode, level=TEXT_LEVEL)
    docs = spark.read.schema(index.docs.schema).parquet(f"{path}/docs")
    packed = index.packed if index.packed is not None else packed_places(docs)
    write_packed(packed.select(*PACKED), f"{path}/postings", buckets, mode)
    counts = packed_counts(_read_packed(spark, f"{path}/postings", docs))
    write_parquet(stats_of_counts(counts, docs), f"{path}/term_stats", mode)
    # Written last: a folder without it is not a complete index.
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode(mode).json(f"{path}/meta")


def _read_packed(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return spark.read.schema(f"term string, doc_id {kind}, pos array<int>, gap array<int>, term_bucket int").parquet(path)


def read_index(spark: SparkSession, path: str) -> Index:
    buckets = spark.read.schema("buckets int").json(f"{path}/meta").first()["buckets"]
    docs = spark.read.parquet(f"{path}/docs")
    packed = _read_packed(spark, f"{path}/postings", docs)
    return Index(docs=docs, postings=unpacked(packed), buckets=buckets, counts=packed_counts(packed),
                 stats=spark.read.parquet(f"{path}/term_stats"), packed=packed)


def index_size(index: Index) -> DataFrame:
    """Postings, distinct terms, documents and logical bytes of an index.

    Logical bytes count a posting as its term's UTF-8 bytes plus 16 bytes
    for doc_id, pos and wpos.
    """
    return _size_of(index.postings)


def _size_of(p: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sizes via two-level aggregations (per term, per document) instead of
    distinct counts, which would expand every posting once per distinct."""
    keys = keys or []
    per_term = p.groupBy(*keys, "term").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("term") + 16).alias("b"))
    terms = per_term.groupBy(*keys).agg(
        F.sum("n").alias("n_postings"), F.count("*").alias("n_terms"),
        F.sum("b").cast("bigint").alias("logical_bytes"))
    if not keys:
        n_docs = p.select("doc_id").distinct().agg(F.count("*")).scalar()
        return terms.select("n_postings", "n_terms", n_docs.alias("n_docs"), "logical_bytes")
    docs = p.select(*keys, "doc_id").distinct().groupBy(*keys).agg(F.count("*").alias("n_docs"))
    return terms.join(docs, keys, "inner").select(
        *keys, "n_postings", "n_terms", "n_docs", "logical_bytes")


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """I6 (stored form): bytes of the files below an index folder."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(path)
            .agg(F.count("*").alias("n_files"),
                 F.sum("length").cast("bigint").alias("stored_bytes")))


def delta_index_size(delta_postings: DataFrame) -> DataFrame:
    """Size per delta (index_seq) plus the total over all deltas (rollup)."""
    per_seq = _size_of(delta_postings, ["index_seq"])
    total = _size_of(delta_postings).select(F.lit(None).cast(
        delta_postings.schema["index_seq"].dataType).alias("index_seq"), "*")
    return per_seq.unionByName(total)
