"""Registered queries of the training-data operators: each applies its
operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (bpe, centroids, licences, lz_fingerprint, manifest, multi_index, packing, quality,
                         simhash, suffix, toxicity, unigram, url_rules)
from inkwell.llm.common import prepare, read
from inkwell.llm.oracle import ORACLES  # noqa: F401  (re-exported)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register
def op1_lz_fingerprint(spark, sf_dir):
    return lz_fingerprint.edited_fingerprints(read(spark, sf_dir, "documents"))


@register
def op2_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.learn(quality.labelled_sample(docs, read(spark, sf_dir, "labels")))
    return quality.annotate(docs, rules).drop("text")


@register
def op3_bpe_encode(spark, sf_dir):
    return bpe.encode_digests(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


# The rules of the query (host, path, action).
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@register
def op4_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    return url_rules.apply_rules(read(spark, sf_dir, "pages").select("page_id", "url"), rules)


@register
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@register
def op6_suffix_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op7_token_counts(spark, sf_dir):
    vocabulary = unigram.ranked_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return unigram.count_tokens(read(spark, sf_dir, "documents"), vocabulary)


@register
def op8_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    crf = toxicity.train(docs, read(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return (toxicity.score_documents(docs, crf, ["doc_id"])
            .withColumn("held_out", F.coalesce(held, F.lit(False))))


@register
def op9_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@register
def op10_license_scans(spark, sf_dir):
    return licences.scan(read(spark, sf_dir, "documents"))


@register
def op11_centroids(spark, sf_dir):
    return centroids.clustered(read(spark, sf_dir, "embeddings"))


@register
def op12_manifest(spark, sf_dir):
    return manifest.manifest(read(spark, sf_dir, "documents"))


@register
def op13_multi_index(spark, sf_dir):
    return multi_index.near_duplicates(read(spark, sf_dir, "embeddings"))
