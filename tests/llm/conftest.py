"""A small set of tables with the awkward cases: nulls, empty and long texts,
copies, near copies, repeated rows, shared passages, clashing column names."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from inkwell.llm.common import prepare

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_rows import awkward_rows  # noqa: E402
from llm_vectors import awkward_vectors  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, t bigint, kept string"


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    prepare(spark)
    path = str(tmp_path_factory.mktemp("tables"))
    rows = awkward_rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 0 if "***" in (r[1] or "") else 1, int("zork" in (r[1] or ""))) for r in rows
              if r[0] is not None] + [(None, 1, 1), (9999, 0, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    urls = ["http://a.b.example.net/en/x?q#f", "HTTPS://Example.NET/en/", "http://example.net", "http://example.net/",
            "http://net/", "http://notnet/", "x.net/en/", None, "", "ftp://u.example.com/de/y", "http://example.com/DE/",
            "http://fr.org/fr/z", "http://org/fr", "http://a..net/q", "http://b.net./q", "http://c.net/a://b", "://net/x",
            "http://a.b.example.net/en/x?q#f"]
    pages = [(i, u, "<p>") for i, u in enumerate(urls)] + [(None, "http://k.net/", None), (0, urls[0], "<p>")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{path}/pages.parquet")
    vectors = spark.createDataFrame(awkward_vectors(), "vec_id bigint, embedding array<float>, label int")
    vectors.selectExpr("*", "1 AS cluster", "2 AS node", "3 AS copies").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="session")
def empty_tables(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "pages", "embeddings"):
        spark.read.parquet(f"{tables}/{name}.parquet").filter(F.lit(False)).write.parquet(f"{path}/{name}.parquet")
    return path
