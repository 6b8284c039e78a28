"""Segmented live index: a family of stored segments, delete sets, tiered merges.

A store is a folder of immutable parts and a pointer that lists the ones in use:

* ``segments/s=N``: documents, postings (by term bucket, packed by term and document),
  term statistics of one batch of documents.  Postings know a document by its number
  in the segment.
* ``removals/g=N``: for documents that were replaced or deleted, one bitmap per
  (segment, 32,768 document numbers), and the statistics of their terms, counted
  once from their texts.  No postings are read or written to remove documents.
* ``pointer/v=N``: one file per state.  A step writes its parts first and its
  pointer last, so a step that dies leaves the state before it, and running it
  again is safe; parts that no pointer lists are dropped by ``vacuum``.

Search joins the query words to each segment's own buckets, matches once over
all of them and masks *results* by the bitmaps.  Statistics are subtractive: the
segments' stored ones minus the removals' ones, which reads tables as large as
the vocabulary and no postings.  Merging takes segments of one size class
(powers of ``TIER`` in documents) into one: document numbers are shifted, not
looked up, removed documents are masked out, statistics follow from the stored
ones, and every other segment stays as it is.

Document numbers come from ``monotonically_increasing_id`` of the stored
documents: dense within a write task, so a task's documents share bitmaps.
Documents without an id (null) cannot be replaced or removed; two documents with
one id in a batch are both kept (see ``latest_delta`` for the newest of each).
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import term_array
from inkwell.operators.postings import (DEFAULT_TERM_BUCKETS, Index, build_postings, counts_in_rows, places_in_rows,
                                        unpacked, write_packed)
from inkwell.operators.search import explode_query_terms, phrase_hits, search, term_hits
from inkwell.operators.similar import frames, similar_in_frames, write_frames
from inkwell.operators.stats import phrase_terms
from inkwell.plans.joins import with_ids
from inkwell.session import stored as stored_ids
from inkwell.session import TEXT_LEVEL, write_parquet

# Segments of TIER^k to TIER^(k+1) - 1 documents are one size class; a class
# with FAN segments or more is merged.
TIER, FAN = 4, 2
# A document's key: its segment's place in the pointer above its number.
_NUMBER_BITS, _MOST_SEGMENTS = 53, 512
_BITMAP = 32768  # Spark's bitmap functions: documents per bitmap

DOCS = "doc_no bigint, doc_id bigint, text string"
POSTINGS = "doc_no bigint, pos array<int>, gap array<int>, term string, term_bucket int"
STATS = "term string, df bigint, cf bigint"
FRAMES = "pre string, post string, word string, n bigint, frame_bucket int"
POINTER = "step string, kind string, id int, docs bigint, numbers bigint, removed map<int,bigint>"


@dataclass
class Part:
    """A segment (``docs`` documents, numbers below ``numbers``) or a removal
    (documents removed by segment)."""

    kind: str
    id: int
    docs: int = 0
    numbers: int = 0
    removed: dict[int, int] | None = None


def term_frequencies(text: str | Column = "text") -> Column:
    """array<struct<term, tf>> of a text, inside its row: runs of equal terms in
    the sorted array of terms.  (Arrays of one element bind the sorted array and
    the runs' starts, so that they are evaluated once per text.)"""
    terms = F.sort_array(F.array_remove(term_array(text), ""))

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0))),
                          lambda i: (F.size(s) > 0) & ((i == 0) | (F.get(s, i) != F.get(s, i - 1))))
        return F.element_at(F.transform(F.array(starts), lambda st: F.transform(
            st, lambda x, k: F.struct(F.get(s, x).alias("term"),
                                      (F.coalesce(F.get(st, k + 1), F.size(s)) - x).cast("bigint").alias("tf")))), 1)

    return F.element_at(F.transform(F.array(terms), runs), 1)


def statistics(docs: DataFrame, *keys: str) -> DataFrame:
    """(keys, term, df, cf) of documents: counted inside each row, then one
    aggregation that combines before its shuffle."""
    return counts_in_rows(docs, *keys).groupBy(*keys, "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def _bucket(number: str) -> Column:
    return F.bitmap_bucket_number(F.col(number) + 1)


def _is_set(bits: str, number: str) -> Column:
    at = F.bitmap_bit_position(F.col(number) + 1)
    byte = F.conv(F.hex(F.substr(F.col(bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


class SegmentStore:
    """The segments below ``base`` and the steps that change them."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = DEFAULT_TERM_BUCKETS, with_frames: bool = False):
        self.spark, self.base, self.buckets, self.with_frames = spark, base.rstrip("/"), buckets, with_frames
        self.version, self.parts = 0, []
        state = self.history()
        for row in state if state else []:
            if row["v"] == state[0]["v"] and row["kind"] != "step":
                self.parts.append(Part(row["kind"], row["id"], row["docs"], row["numbers"], row["removed"]))
            self.version = max(self.version, row["v"])

    # -- pointer ---------------------------------------------------------------
    def history(self) -> list:
        """Rows of all pointers, the newest first (a few per step)."""
        try:
            rows = self.spark.read.schema(f"{POINTER}, v int").parquet(f"{self.base}/pointer")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return rows.orderBy(F.desc("v"), "kind", "id").collect()

    def _commit(self, step: str, parts: list[Part], written: int) -> None:
        rows = [(step, "step", 0, written, 0, None)] + [
            (step, p.kind, p.id, p.docs, p.numbers, p.removed) for p in parts]
        self.version += 1
        self.spark.createDataFrame(rows, POINTER).coalesce(1).write.mode("overwrite").parquet(
            f"{self.base}/pointer/v={self.version}")
        self.parts = parts

    def _next(self, kind: str) -> int:
        """A number that no pointer has used for a part of this kind."""
        used = [r["id"] for r in self.history() if r["kind"] == kind]
        return max(used, default=0) + 1

    def steps(self) -> DataFrame:
        """(version, step, n_segments, written_docs, live_docs) of every pointer."""
        rows = self.spark.read.schema(f"{POINTER}, v int").parquet(f"{self.base}/pointer")
        segments = rows.filter("kind = 'segment'").select("v", F.col("id").alias("seg"), "docs")
        gone = (rows.filter("kind = 'removal'").select("v", F.explode("removed").alias("seg", "n"))
                .groupBy("v", "seg").agg(F.sum("n").alias("n")))
        live = (segments.join(gone, ["v", "seg"], "left").groupBy("v")
                .agg(F.count(F.lit(1)).alias("n_segments"),
                     F.sum(F.col("docs") - F.coalesce("n", F.lit(0))).alias("live_docs")))
        return rows.filter("kind = 'step'").join(live, "v", "left").select(
            F.col("v").alias("version"), "step", F.coalesce("n_segments", F.lit(0)).alias("n_segments"),
            F.col("docs").alias("written_docs"), F.coalesce("live_docs", F.lit(0)).alias("live_docs"))

    def segments(self) -> list[Part]:
        return [p for p in self.parts if p.kind == "segment"]

    def removals(self) -> list[Part]:
        return [p for p in self.parts if p.kind == "removal"]

    def removed_docs(self) -> dict[int, int]:
        """Documents removed so far, by segment."""
        out: dict[int, int] = defaultdict(int)
        for p in self.removals():
            for s, n in (p.removed or {}).items():
                out[s] += n
        return out

    def live_count(self) -> int:
        gone = self.removed_docs()
        return sum(p.docs - gone[p.id] for p in self.segments())

    # -- stored parts ------------------------------------------------------------
    def _read(self, schema: str, kind: str, ident: int, table: str) -> DataFrame:
        folder = {"segment": "segments/s", "removal": "removals/g"}[kind]
        return self.spark.read.schema(schema).parquet(f"{self.base}/{folder}={ident}/{table}")

    def _empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _union(self, frames: list[DataFrame], schema: str) -> DataFrame:
        out = None
        for f in frames:
            out = f if out is None else out.unionByName(f)
        return self._empty(schema) if out is None else out

    def docs(self) -> DataFrame:
        """(seg, doc_no, doc_id, text) of all segments, removed ones too."""
        return self._union([self._read(DOCS, "segment", p.id, "docs").withColumn("seg", F.lit(p.id))
                            for p in self.segments()], f"{DOCS}, seg int")

    def bitmaps(self) -> DataFrame:
        """(seg, bucket, bits): removed documents of the segments in use."""
        live = [p.id for p in self.segments()]
        bits = self._union([self._read("seg int, bucket bigint, bits binary", "removal", p.id, "bits")
                            for p in self.removals()], "seg int, bucket bigint, bits binary")
        return bits.filter(F.col("seg").isin(live)).groupBy("seg", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def unremoved(self, rows: DataFrame) -> DataFrame:
        """Rows with (seg, doc_no) of documents that are not removed."""
        if not self.removals():
            return rows
        # One bit per document, sent to where the rows are.
        masks = F.broadcast(self.bitmaps().withColumnRenamed("bits", "_bits"))
        return (rows.withColumn("bucket", _bucket("doc_no")).join(masks, ["seg", "bucket"], "left")
                .filter(~_is_set("_bits", "doc_no")).drop("bucket", "_bits"))

    # -- steps ---------------------------------------------------------------------
    def _write_segment(self, docs: DataFrame) -> Part:
        ident = self._next("segment")
        path = f"{self.base}/segments/s={ident}"
        write_parquet(docs.select("doc_id", "text").withColumn("doc_no", F.monotonically_increasing_id()),
                      f"{path}/docs", "overwrite", level=TEXT_LEVEL)
        stored = self._read(DOCS, "segment", ident, "docs")
        places = places_in_rows(stored.select(F.col("doc_no").alias("doc_id"), "text"))
        self._write_postings(places.withColumnRenamed("doc_id", "doc_no"), path)
        write_parquet(statistics(stored), f"{path}/term_stats", "overwrite")
        if self.with_frames:
            write_frames(frames(stored), f"{path}/frames")
        return self._part(ident, stored)

    def _part(self, ident: int, docs: DataFrame) -> Part:
        size = docs.agg(F.count(F.lit(1)).alias("n"), F.max("doc_no").alias("top")).first()
        return Part("segment", ident, size["n"], (size["top"] if size["n"] else -1) + 1)

    def _write_postings(self, places: DataFrame, path: str) -> None:
        write_packed(places, f"{path}/postings", self.buckets, doc="doc_no")

    def _remove(self, ids: DataFrame, ident: int) -> Part | None:
        """Write the removal of the documents with these ids from all segments."""
        # Stored, as they are read once per segment; met where the texts are.
        ids = stored_ids(ids.select("doc_id").distinct(), "removed-ids")
        gone = self.unremoved(with_ids(self.docs(), ids))
        path = f"{self.base}/removals/g={ident}"
        # The documents' numbers and texts are written once; bitmaps and statistics follow from them.
        write_parquet(gone.select("seg", "doc_no", "text"), f"{path}/docs", "overwrite", level=TEXT_LEVEL)
        stored = self._read("seg int, doc_no bigint, text string", "removal", ident, "docs")
        counts = {r["seg"]: r["n"] for r in stored.groupBy("seg").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not counts:
            return None
        bits = (stored.groupBy("seg", _bucket("doc_no").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("doc_no") + 1)).alias("bits")))
        write_parquet(bits, f"{path}/bits", "overwrite")
        write_parquet(statistics(stored, "seg"), f"{path}/term_stats", "overwrite")
        if self.with_frames:
            write_frames(frames(stored, "seg"), f"{path}/frames")
        return Part("removal", ident, sum(counts.values()), 0, counts)

    def append(self, docs: DataFrame, removed: DataFrame | None = None, step: str = "append") -> None:
        """New and changed documents (doc_id, text) as one more segment; earlier
        versions of them, and the ids in ``removed``, are masked."""
        docs = docs.select("doc_id", "text")
        parts = list(self.parts)
        if self.segments():
            ids = docs.select("doc_id")
            ids = ids if removed is None else ids.unionByName(removed.select("doc_id"))
            gone = self._remove(ids, self._next("removal"))
            parts += [gone] if gone else []
        segment = self._write_segment(docs)
        self._commit(step, [*parts, segment], segment.docs)

    def delete(self, ids: DataFrame) -> None:
        """Remove documents by id: bitmaps and statistics, no postings."""
        gone = self._remove(ids, self._next("removal"))
        self._commit("delete", [*self.parts, *([gone] if gone else [])], 0)

    def merge(self, tier: int = TIER, fan: int = FAN) -> int:
        """Merge size classes until none has ``fan`` segments; documents written."""
        written = 0
        while True:
            classes: dict[int, list[Part]] = defaultdict(list)
            for p in self.segments():
                level, n = 0, max(p.docs, 1)
                while n >= tier:
                    level, n = level + 1, n // tier
                classes[level].append(p)
            full = [c for c in sorted(classes) if len(classes[c]) >= fan]
            if not full:
                return written
            written += self._merge(classes[full[0]])

    def _merge(self, sources: list[Part]) -> int:
        ident = self._next("segment")
        path = f"{self.base}/segments/s={ident}"
        docs, postings, start = [], [], 0
        for p in sources:
            here = [F.lit(p.id).alias("seg"), F.lit(start).cast("bigint").alias("_start")]
            docs.append(self._read(DOCS, "segment", p.id, "docs").select("*", *here))
            postings.append(self._read(POSTINGS, "segment", p.id, "postings").drop("term_bucket").select("*", *here))
            start += -(-p.numbers // _BITMAP) * _BITMAP  # bitmaps of the sources stay apart
        if start >= 1 << _NUMBER_BITS:
            raise ValueError("document numbers are used up: write the live documents to a new store")

        def shifted(frames: list[DataFrame]) -> DataFrame:
            rows = self.unremoved(self._union(frames, ""))
            return rows.withColumn("doc_no", F.col("doc_no") + F.col("_start")).drop("seg", "_start")

        write_parquet(shifted(docs), f"{path}/docs", "overwrite", level=TEXT_LEVEL)
        self._write_postings(shifted(postings), path)
        write_parquet(self._subtracted({p.id for p in sources}), f"{path}/term_stats", "overwrite")
        if self.with_frames:
            write_frames(frames(self._read(DOCS, "segment", ident, "docs")), f"{path}/frames")
        merged = self._part(ident, self._read(DOCS, "segment", ident, "docs"))
        merged.numbers = max(merged.numbers, start)
        old = {p.id for p in sources}
        parts = [p for p in self.parts if p.kind != "segment" or p.id not in old]
        parts = [p for p in parts if p.kind != "removal" or set(p.removed or {}) - old]
        for i, p in enumerate(parts):
            if p.kind == "removal":
                parts[i] = Part("removal", p.id, p.docs, 0, {s: n for s, n in p.removed.items() if s not in old})
        self._commit("merge", [*parts, merged], merged.docs)
        return merged.docs

    def vacuum(self, keep: int = 1) -> list[str]:
        """Drop all parts that the newest ``keep`` pointers do not list, and the
        older pointers; the folders that went."""
        newest = sorted({r["v"] for r in self.history()})[-keep:]
        listed = {("segments/s" if r["kind"] == "segment" else "removals/g") + f"={r['id']}"
                  for r in self.history() if r["v"] in newest and r["kind"] != "step"}
        listed |= {f"pointer/v={v}" for v in newest}
        jvm, gone = self.spark._jvm, []
        for folder in ("segments", "removals", "pointer"):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{folder}")
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in (fs.listStatus(path) if fs.exists(path) else []):
                name = f"{folder}/{status.getPath().getName()}"
                if status.isDirectory() and name not in listed:
                    fs.delete(status.getPath(), True)
                    gone.append(name)
        return sorted(gone)

    # -- search ---------------------------------------------------------------------
    def _key(self, place: int) -> Column:
        return F.lit(place << _NUMBER_BITS).cast("bigint") + F.col("doc_no")

    def _places(self) -> list[tuple[int, Part]]:
        if len(self.segments()) > _MOST_SEGMENTS:
            raise ValueError(f"more than {_MOST_SEGMENTS} segments: merge them")
        return list(enumerate(self.segments()))

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """(seg, doc_no) of rows whose doc_id is a key."""
        places = F.create_map(*[F.lit(x) for at, p in self._places() for x in (at, p.id)]) if self.segments() \
            else F.create_map().cast("map<int,int>")
        return (rows.withColumn("seg", places[F.shiftright("doc_id", _NUMBER_BITS).cast("int")])
                .withColumn("doc_no", F.col("doc_id").bitwiseAND(F.lit((1 << _NUMBER_BITS) - 1))))

    def parts_by_key(self) -> Index:
        """The segments as one index whose documents are keys (removed ones too)."""
        docs = self._union([self._read(DOCS, "segment", p.id, "docs").select(self._key(at).alias("doc_id"))
                            for at, p in self._places()], "doc_id bigint")
        postings = [unpacked(self._read(POSTINGS, "segment", p.id, "postings").withColumn("doc_id", self._key(at)))
                    for at, p in self._places()]
        return Index(docs=docs, postings=postings or [build_postings(self._empty("doc_id bigint, text string"))],
                     buckets=self.buckets)

    def _named(self, rows: DataFrame) -> DataFrame:
        """Rows by key, without removed documents, with the documents' own ids."""
        names = self.docs().select("seg", "doc_no", F.col("doc_id").alias("_id"))
        return (self.unremoved(self._keyed(rows)).join(names, ["seg", "doc_no"])
                .withColumn("doc_id", F.col("_id")).drop("seg", "doc_no", "_id"))

    def search(self, queries: DataFrame) -> DataFrame:
        """results(query_id, doc_id, score, location) over the live documents."""
        return self._named(search(self.parts_by_key(), queries, explode_query_terms(queries))).select(
            "query_id", "doc_id", "score", "location")

    # -- statistics -------------------------------------------------------------------
    def _signed(self, segments: set[int], table: str, schema: str, values: list[str]) -> DataFrame:
        """A stored table of some segments, and what was removed from them with
        negative values."""
        rows = [self._read(schema, "segment", s, table) for s in sorted(segments)]
        for p in self.removals():
            gone = self._read(f"seg int, {schema}", "removal", p.id, table).filter(F.col("seg").isin(segments))
            rows.append(gone.drop("seg").withColumns({v: -F.col(v) for v in values}))
        return self._union(rows, schema)

    def _subtracted(self, segments: set[int]) -> DataFrame:
        """(term, df, cf) of the live documents of some segments: what is stored
        minus what was removed."""
        return (self._signed(segments, "term_stats", STATS, ["df", "cf"]).groupBy("term")
                .agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0"))

    def similar_words(self, words: DataFrame) -> DataFrame:
        """W7 over the live documents, from the stored frames (a store that is
        kept with ``with_frames``)."""
        if not self.with_frames:
            raise ValueError("this store is kept without frames")
        return similar_in_frames(self._signed({p.id for p in self.segments()}, "frames", FRAMES, ["n"]), words)

    def term_stats(self) -> DataFrame:
        """(term, df, cf, idf) of the live documents, from stored statistics."""
        n = self.live_count()
        return self._subtracted({p.id for p in self.segments()}).withColumn(
            "idf", F.round(F.log(F.lit(n) / F.col("df")), 6))

    def _phrase_counts(self, phrases: DataFrame, id_col: str, phrase_col: str) -> DataFrame:
        """(query_id, df, cf) of the phrases that occur: words from the
        statistics, longer ones matched, counted per document and masked."""
        terms = phrase_terms(phrases, id_col, phrase_col)
        words = terms.filter("n_words = 1").select("query_id", F.col("word").alias("term")).join(
            self.term_stats(), "term").select("query_id", "df", "cf")
        index = self.parts_by_key()
        found = phrase_hits(index.postings, terms.filter("n_words > 1"), index.buckets)
        per_doc = found.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("tf"))
        longer = self.unremoved(self._keyed(per_doc)).groupBy("query_id").agg(
            F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
        return words.unionByName(longer)

    def _looked_up(self, phrases: DataFrame, value: str, id_col: str, phrase_col: str) -> DataFrame:
        counts = self._phrase_counts(phrases, id_col, phrase_col).select(F.col("query_id").alias(id_col), value)
        return phrases.select(id_col, phrase_col).join(counts, id_col, "left").select(
            id_col, phrase_col, F.coalesce(value, F.lit(0)).cast("bigint").alias(value))

    def document_freq(self, phrases: DataFrame, id_col: str = "phrase_id", phrase_col: str = "phrase") -> DataFrame:
        """A1 over the live documents."""
        return self._looked_up(phrases, "df", id_col, phrase_col)

    def index_freq(self, phrases: DataFrame, id_col: str = "phrase_id", phrase_col: str = "phrase") -> DataFrame:
        """A2 over the live documents."""
        return self._looked_up(phrases, "cf", id_col, phrase_col)

    def document_term_freq(self, pairs: DataFrame) -> DataFrame:
        """A3 over the live documents, for (pair_id, doc_id, phrase) rows: the
        asked documents are looked up first, and only their hits are matched."""
        names = [self._read(DOCS, "segment", p.id, "docs").select(
            F.lit(p.id).alias("seg"), "doc_no", "doc_id", self._key(at).alias("key")) for at, p in self._places()]
        names = self._union(names, "seg int, doc_no bigint, doc_id bigint, key bigint")
        asked = self.unremoved(names.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi"))
        index, terms = self.parts_by_key(), phrase_terms(pairs.select("phrase").distinct(), "phrase", "phrase")
        hits = term_hits(index.postings, terms, index.buckets).join(
            asked.select(F.col("key").alias("doc_id")), "doc_id", "left_semi")
        tf = phrase_hits(None, terms, hits=hits).groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("tf"))
        tf = tf.join(asked.select(F.col("key"), F.col("doc_id").alias("_id")), F.col("doc_id") == F.col("key")).groupBy(
            F.col("query_id").alias("phrase"), F.col("_id").alias("doc_id")).agg(F.sum("tf").alias("tf"))
        return pairs.join(tf, ["phrase", "doc_id"], "left").select(
            "pair_id", "doc_id", "phrase", F.coalesce("tf", F.lit(0)).cast("bigint").alias("tf"))
