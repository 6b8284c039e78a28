from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.operators.postings import build_postings


def test_tokenizer_positions(docs_df):
    d = docs_df([(1, "Hello, World -- the end .  Next-line\tword!"), (2, ""), (3, "  lead space")])
    rows = sorted(tuple(r) for r in build_postings(d).collect())
    assert rows == [
        (1, 0, 0, "hello"), (1, 1, 1, "world"), (1, 2, 3, "the"), (1, 3, 4, "end"),
        (1, 4, 5, "next-line"), (1, 5, 6, "word"),
        (3, 0, 1, "lead"), (3, 1, 2, "space"),
    ]


def test_doc_length_and_title(docs_df):
    d = docs_df([(1, "a, b. c\n"), (2, ""), (3, " x y"), (4, "l1\nl2\nl3\nl4\nl5"), (5, "t\nx\n")])
    out = {r[0]: (r[1], r[2]) for r in d.select(
        "doc_id", T.doc_length("text"), T.document_title("text")).collect()}
    assert out[1][0] == 3 and out[2][0] == 0 and out[3][0] == 3
    assert out[4][1] == "l1\nl2\nl3\nl4"
    assert out[5][1] == "t\nx"


def test_docno_normalize(spark):
    df = spark.createDataFrame([("doc-12",), ("A1B2",), ("\n10\n",), ("abc",)], "d string")
    assert [r[0] for r in df.select(T.normalize_docno("d")).collect()] == [12, 12, 10, None]


def test_snippet(docs_df):
    words = " ".join(f"w{i}" for i in range(40))
    d = docs_df([(1, words)])
    s = d.select(T.snippet("text", F.lit(20)).alias("s"), T.snippet("text", F.lit(0)).alias("z")).first()
    assert s.s == " ".join(f"w{i}" for i in range(9, 20)) + " \n\t\t" + " ".join(
        f"w{i}" for i in range(20, 30)) + " "
    assert s.z.startswith("w0 w1") and s.z.count("\n\t\t") == 1
