"""Inputs derived from the given tables: query workload, live-update delta,
query log, tombstones.  Every frame here is computed by Spark from the
corpus (except the ten workload query strings, which are parameters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.plans.ranking import distributed_row_number
from inkwell.session import table_path

# The query workload (query_id, query) used by tests and bench.
WORKLOAD = [
    (0, '"of the"'),
    (1, '!"of the" the'),
    (2, "!the"),
    (3, '"in the" is'),
    (4, '"the the"'),
    (5, ""),
    (6, '!"of the" !was'),
    (7, "zzzunknown"),
    (8, "the the"),
    (9, "was!"),
]

# The delta rule.  (index_seq, modulus, remainder, shift, new_id_offset)
#   seq 1: doc_id % 10 = 3 takes the text of doc_id + 1
#   seq 2: doc_id % 20 = 3 takes the text of doc_id + 2 (supersedes seq 1)
#   seq 2: doc_id % 50 = 7 is copied as a new document doc_id + 1,000,000
DELTA_RULES = [
    (1, 10, 3, 1, 0),
    (2, 20, 3, 2, 0),
    (2, 50, 7, 0, 1_000_000),
]
TOMBSTONE_MOD, TOMBSTONE_REM = 100, 9

# Query-log rule.  All terms are ranked by frequency desc, then
# term.  Events 4j to 4j + 3 ask for the term at rank (j * 31) mod (number of
# terms): the even ones without its second character, the odd ones as it is.
# Eight events in a row are a session.
LOG_MULT, LOG_REPEAT, LOG_SESSION = 31, 4, 8
# Conversations are sessions numbered from here on; every turn is a query.
LOG_CONVERSATIONS = 1_000_000_000_000


# Query log with a session per user.  A user's events by event_id
# are numbered k = 0, 1, ...; events k = 4j to 4j + 3 ask for the user's word
# number j mod LOG_USER_WORDS, of the term at rank ((user_id * LOG_USER_WORDS +
# number) * LOG_MULT) mod (number of terms): the even ones without its second
# character, so each misspelling is followed by the right word in its session.
LOG_USER_WORDS = 8


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as it is stored: everything per document runs on the input
    splits, and texts are never shuffled."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def workload(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WORKLOAD, "query_id bigint, query string")


# Phrases looked up per labelled document (pair_id = doc_id * 10 + k).
LOOKUP_PHRASES = ["the", "of the", "was"]


# Words whose similar-context words are reported.
SIMILAR_WORDS = ["was", "the", "it"]


def similar_words_input(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in SIMILAR_WORDS], "word string")


def benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(phrase_id, phrase): benchmark passages, each looked up as a phrase."""
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("phrase_id"), F.col("text").alias("phrase"))


def benchmark_workload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as one-line quoted phrase queries (query_id =
    item_id); whitespace runs become single spaces, since a quoted phrase
    does not span a line break."""
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.concat(F.lit('"'), F.regexp_replace("text", r"\s+", " "), F.lit('"')).alias("query"))


def extended_workload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed workload plus benchmark passages in quotes (kept with their
    line breaks, so multi-line ones exercise the unpaired-quote path of the
    parser) and all turns of conversations as free-text queries."""
    bench = read_table(spark, sf_dir, "benchmark").select(
        (F.lit(1_000_000) + F.col("item_id")).alias("query_id"),
        F.concat(F.lit('"'), F.col("text"), F.lit('"')).alias("query"))
    conv = read_table(spark, sf_dir, "conversations").select(
        (F.lit(2_000_000) + F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
        F.col("text").alias("query"))
    return workload(spark).unionByName(bench).unionByName(conv)


def lookup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair_id, doc_id, phrase): every labelled document with each lookup phrase."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id")
    phrases = F.array(*[F.lit(p) for p in LOOKUP_PHRASES])
    return labels.select("doc_id", F.posexplode(phrases).alias("k", "phrase")).select(
        (F.col("doc_id") * 10 + F.col("k")).alias("pair_id"), "doc_id", "phrase")


def delta_docs(docs: DataFrame) -> DataFrame:
    """delta_docs(doc_id, text, index_seq, path) derived from the corpus by
    the fixed rules above (equi-joins on shifted ids, no driver work)."""
    src = docs.select(F.col("doc_id").alias("src_id"), F.col("text").alias("src_text"))
    parts = []
    for seq, mod, rem, shift, new_off in DELTA_RULES:
        sel = docs.select("doc_id").filter(F.pmod("doc_id", F.lit(mod)) == rem)
        # The rule holds for the joined id too, so only such rows' texts are shuffled.
        taken = src.filter(F.pmod(F.col("src_id") - shift, F.lit(mod)) == rem)
        part = sel.join(taken, sel["doc_id"] + shift == taken["src_id"]).select(
            (F.col("doc_id") + new_off).alias("doc_id"),
            F.col("src_text").alias("text"), F.lit(seq).alias("index_seq"))
        parts.append(part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("path", F.concat(F.lit("docs/"), F.col("doc_id").cast("string"),
                                           F.lit(".xml")))


def tombstones(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id").filter(F.pmod("doc_id", F.lit(TOMBSTONE_MOD)) == TOMBSTONE_REM)


def log_vocabulary(stats: DataFrame) -> DataFrame:
    """(rank, word): all terms, ranked by frequency desc then term from 0."""
    ranked = distributed_row_number(stats.select(F.lit(0).alias("all"), "term", "cf"), "all",
                                    [F.desc("cf"), F.asc("term")], "rn")
    return ranked.select((F.col("rn") - 1).cast("bigint").alias("rank"), F.col("term").alias("word"))


def query_log(events: DataFrame, stats: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """query_log(session_id, ts, query) from events and the term statistics,
    and from all turns of conversations."""
    n_terms = stats.agg(F.count(F.lit(1))).scalar()
    vocab = log_vocabulary(stats)
    ev = events.select(F.floor(F.col("event_id") / LOG_SESSION).cast("bigint").alias("session_id"),
                       F.col("event_id").alias("ts"),
                       F.pmod(F.floor(F.col("event_id") / LOG_REPEAT) * LOG_MULT, n_terms).cast("bigint").alias("rank"))
    misspelt = F.concat(F.substring("word", 1, 1), F.substr("word", F.lit(3)))
    log = ev.join(vocab, "rank").select(
        "session_id", "ts", F.when(F.pmod("ts", F.lit(2)) == 0, misspelt).otherwise(F.col("word")).alias("query"))
    if conversations is None:
        return log
    return log.unionByName(conversations.select(
        (F.col("conv_id") + LOG_CONVERSATIONS).alias("session_id"), F.col("turn").alias("ts"),
        F.col("text").alias("query")))


def user_query_log(events: DataFrame, stats: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """query_log(session_id, ts, query) with session_id = user_id and ts =
    event_id: sessions as long as a user's history, a hot user's too (events are
    numbered by range partitions, not by one task per user)."""
    n_terms = stats.agg(F.count(F.lit(1))).scalar()
    numbered = distributed_row_number(events.select("user_id", "event_id"), "user_id", [F.asc("event_id")], "rn")
    k = F.col("rn") - 1
    word_no = F.pmod(F.floor(k / LOG_REPEAT), F.lit(LOG_USER_WORDS))
    ev = numbered.select(
        F.col("user_id").alias("session_id"), F.col("event_id").alias("ts"), F.pmod(k, F.lit(2)).alias("odd"),
        F.pmod((F.coalesce("user_id", F.lit(0)) * LOG_USER_WORDS + word_no) * LOG_MULT, n_terms).cast("bigint").alias("rank"))
    misspelt = F.concat(F.substring("word", 1, 1), F.substr("word", F.lit(3)))
    log = ev.join(log_vocabulary(stats), "rank").select(
        "session_id", "ts", F.when(F.col("odd") == 0, misspelt).otherwise(F.col("word")).alias("query"))
    if conversations is None:
        return log
    return log.unionByName(conversations.select(
        (F.col("conv_id") + LOG_CONVERSATIONS).alias("session_id"), F.col("turn").alias("ts"),
        F.col("text").alias("query")))


# Per-file signature method by document language (watch set);
# other languages take the default.
LANG_METHODS = [("fr", "SHA-256"), ("de", "SHA-1"), ("es", "checksum")]


def doc_files(docs: DataFrame) -> DataFrame:
    """The corpus as watched files: (path, content)."""
    return docs.select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string"),
                                F.lit(".txt")).alias("path"), F.col("text").alias("content"))


def live_files(docs: DataFrame) -> DataFrame:
    """The watched files after the delta: changed and new documents, and
    without the tombstoned ones."""
    delta = delta_docs(docs)
    newest = delta.groupBy("doc_id").agg(F.max(F.struct("index_seq", "text")).alias("m")).select(
        "doc_id", F.col("m.text").alias("text"))
    live = docs.select("doc_id", "text").join(newest.select("doc_id"), "doc_id", "left_anti") \
        .unionByName(newest)
    return doc_files(live.join(tombstones(docs), "doc_id", "left_anti"))
