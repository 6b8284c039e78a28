"""Phrase statistics over the main index and document lookups.

A phrase table is turned into the same term rows a search query produces
(one term per phrase), so phrase matching reuses the search plan: a salted
join of the phrase words to postings, then relational division keyed by
start position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import document_title as title_expr
from inkwell.functions.text import normalize_term
from inkwell.operators.postings import Index
from inkwell.operators.search import phrase_hits


def phrase_terms(phrases: DataFrame, id_col: str = "phrase_id",
                 phrase_col: str = "phrase") -> DataFrame:
    """(query_id, term_no, negated, n_words, offset, word) for whole phrases."""
    words = F.filter(F.transform(F.split(F.coalesce(F.col(phrase_col), F.lit("")), r"\s+"),
                                 lambda w: normalize_term(w)), lambda w: w != "")
    t = phrases.select(F.col(id_col).alias("query_id"), words.alias("words")).filter(
        F.size("words") > 0)
    return t.select("query_id", F.lit(0).alias("term_no"), F.lit(False).alias("negated"),
                    F.size("words").cast("int").alias("n_words"),
                    F.posexplode("words").alias("offset", "word")).select(
        "query_id", "term_no", "negated", "n_words",
        F.col("offset").cast("int").alias("offset"), "word")


def _occurrences(index: Index, phrases: DataFrame, id_col: str, phrase_col: str) -> DataFrame:
    return phrase_hits(index.postings, phrase_terms(phrases, id_col, phrase_col), index.buckets)


def document_freq(index: Index, phrases: DataFrame, id_col: str = "phrase_id",
                  phrase_col: str = "phrase") -> DataFrame:
    """A1: number of documents containing each phrase (0 when absent)."""
    occ = _occurrences(index, phrases, id_col, phrase_col)
    per_doc = occ.select("query_id", "doc_id").distinct()
    counts = per_doc.groupBy("query_id").agg(F.count("*").alias("df"))
    return phrases.select(id_col, phrase_col).join(
        counts.withColumnRenamed("query_id", id_col), id_col, "left").select(
        id_col, phrase_col, F.coalesce("df", F.lit(0)).cast("bigint").alias("df"))


def index_freq(index: Index, phrases: DataFrame, id_col: str = "phrase_id",
               phrase_col: str = "phrase") -> DataFrame:
    """A2: occurrences of each phrase in the whole index (0 when absent)."""
    occ = _occurrences(index, phrases, id_col, phrase_col)
    counts = occ.groupBy("query_id").agg(F.count("*").alias("cf"))
    return phrases.select(id_col, phrase_col).join(
        counts.withColumnRenamed("query_id", id_col), id_col, "left").select(
        id_col, phrase_col, F.coalesce("cf", F.lit(0)).cast("bigint").alias("cf"))


def document_term_freq(index: Index, pairs: DataFrame) -> DataFrame:
    """A3: occurrences of a phrase in one document, for (pair_id, doc_id, phrase)
    rows; 0 when the phrase or the document is absent."""
    phrases = pairs.select("phrase").distinct()
    occ = _occurrences(index, phrases, "phrase", "phrase")
    counts = occ.groupBy("query_id", "doc_id").agg(F.count("*").alias("tf")).withColumnRenamed(
        "query_id", "phrase")
    return pairs.join(counts, ["phrase", "doc_id"], "left").select(
        "pair_id", "doc_id", "phrase", F.coalesce("tf", F.lit(0)).cast("bigint").alias("tf"))


def document_text(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored text by id; '' when the document is absent."""
    d = docs.select("doc_id", "text")
    return ids.select("doc_id").join(d, "doc_id", "left").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))


def document_title(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """First four lines of the stored text; '' when absent."""
    d = docs.select("doc_id", title_expr("text").alias("title"))
    return ids.select("doc_id").join(d, "doc_id", "left").select(
        "doc_id", F.coalesce("title", F.lit("")).alias("title"))
