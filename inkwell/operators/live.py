"""Live (incremental) indexing: deltas, supersede, delete, live search, merge.

A delta is a set of changed documents tagged with ``index_seq`` (arrival
order).  A document lives in the newest delta that holds it; the live view
is the main index minus every document held by a delta, plus the deltas.

Live search runs the workload on main and on the delta separately and masks
main's *results* (not its postings) with the delta's document ids: scores are
per document, so this equals searching the rebuilt live corpus while the
large main postings are never joined against the delta.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import exploded, offset_of, with_terms
from inkwell.operators.postings import PACKED, Index, build_postings, pack, packed_places, read_index, unpacked, write_index
from inkwell.operators.search import search
from inkwell.plans.joins import without_ids
from inkwell.session import stored

# Fixed value: merge once more distinct files than this have changed.
DEFAULT_MERGE_THRESHOLD = 10


def latest_delta(delta_docs: DataFrame) -> DataFrame:
    """L3: the newest version of each document across deltas (an aggregation
    with map-side combine, not a window over each document).  Newest by
    index_seq, then by the micro-batch that brought it, if there is one; with
    a ``change`` column, a removal is a version like any other."""
    order = ["index_seq", *(c for c in ("stream_batch",) if c in delta_docs.columns)]
    values = ["text", "path", *(c for c in ("change",) if c in delta_docs.columns)]
    newest = delta_docs.groupBy("doc_id").agg(F.max(F.struct(*order, *values)).alias("m"))
    return newest.select("doc_id", "m.text", "m.index_seq", *[f"m.{c}" for c in values[1:]])


def alive(newest: DataFrame) -> DataFrame:
    """Newest versions that are no removals (a removal only masks main)."""
    if "change" not in newest.columns:
        return newest
    return newest.filter(F.coalesce(F.col("change") != "removed", F.lit(True)))


def duplicate_delta_docs(delta_docs: DataFrame) -> DataFrame:
    """Documents present in more than one delta (before supersede)."""
    return delta_docs.groupBy("doc_id").agg(
        F.countDistinct("index_seq").alias("n_deltas")).filter(F.col("n_deltas") > 1)


def delta_index(delta_docs: DataFrame) -> Index:
    """L2/L3: the delta as an index over its newest document versions."""
    return Index(docs=alive(latest_delta(delta_docs)), postings=delta_postings(delta_docs))


def delta_postings(delta_docs: DataFrame) -> DataFrame:
    """Postings of the newest versions, tagged with their index_seq (narrow:
    index_seq rides along the document row through the tokenizer)."""
    docs = alive(latest_delta(delta_docs))
    return (exploded(with_terms(docs, "doc_id", "index_seq"), "doc_id", "index_seq", "_w")
            .select("doc_id", "pos", offset_of().alias("wpos"), "term", "index_seq"))


def remove_docs(index: Index, ids: DataFrame) -> Index:
    """L4: drop documents (and their postings) by id; neither is shuffled."""
    packed = None if index.packed is None else without_ids(index.packed, ids)
    postings = without_ids(index.postings, ids) if packed is None else unpacked(packed)
    return Index(docs=without_ids(index.docs, ids), postings=postings, buckets=index.buckets, packed=packed)


def _newest(delta_docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The newest versions and their ids, stored: both are read several times, and
    the planner sees that the ids are few, so that main is not shuffled by them."""
    newest = stored(latest_delta(delta_docs), "newest")
    return newest, stored(newest.select("doc_id"), "newest-ids")


def live_index(main: Index, delta_docs: DataFrame) -> Index:
    """L5 as a view: main minus delta documents, plus the newest delta versions."""
    newest, ids = _newest(delta_docs)
    masked = remove_docs(main, ids)
    fresh = alive(newest)
    docs = masked.docs.select("doc_id", "text").unionByName(fresh.select("doc_id", "text"))
    postings = masked.postings.select("doc_id", "pos", "wpos", "term").unionByName(build_postings(fresh))
    if masked.packed is None:
        return Index(docs=docs, postings=postings)
    packed = masked.packed.select(*PACKED).unionByName(packed_places(fresh))
    # Ids of both sides differ, but for null, which masks nothing: such documents' places meet here.
    unnamed = [p.select("doc_id").filter("doc_id is null") for p in (masked.docs, fresh)]
    if not any(ids.isEmpty() for ids in unnamed):
        packed = packed.filter("doc_id is not null").unionByName(pack(postings.filter("doc_id is null")))
    return Index(docs=docs, postings=postings, packed=packed)


def live_search(main: Index, delta_docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Search main and delta, mask main results held by a delta (also as a
    removal), union."""
    newest, ids = _newest(delta_docs)
    delta = Index(docs=alive(newest).select("doc_id", "text"), postings=build_postings(alive(newest)))
    main_res = search(main, queries).join(ids, "doc_id", "left_anti")
    return main_res.unionByName(search(delta, queries)).select(
        "query_id", "doc_id", "score", "location")


def needs_merge(delta_docs: DataFrame, threshold: int = DEFAULT_MERGE_THRESHOLD) -> DataFrame:
    """Distinct changed files since the last merge against a strict threshold."""
    return delta_docs.agg(F.countDistinct("path").alias("n_files")).select(
        "n_files", F.lit(threshold).alias("threshold"),
        (F.col("n_files") > threshold).alias("needs_merge"))


def merge_delta(main: Index, delta_docs: DataFrame, base_path: str, version: int) -> Index:
    """Write the live view as main version ``version`` (a new folder, so
    readers of the previous version are never disturbed) and return it read
    back from storage, with its counts and statistics.  Clearing the delta is the caller's pointer switch."""
    live = live_index(main, delta_docs)
    path = f"{base_path.rstrip('/')}/main/v={version}"
    write_index(live, path)
    spark: SparkSession = main.docs.sparkSession
    return read_index(spark, path)
