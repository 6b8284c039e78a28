from pyspark.sql import functions as F

from inkwell.functions.distance import weighted_distance, weighted_edit_distance
from inkwell.operators.fuzzy import fuzzy_match

GOLDEN = [  # a, b, costs, hyphen, distance
    ("foo", "four", (0, 1, 1), "plain", 2), ("foo", "four", (0, 1, 2), "plain", 3),
    ("foo", "foo", (0, 1, 1), "plain", 0), ("foo", "bar", (0, 1, 1), "plain", 3),
    ("foo", "four", (0, 2, 1), "plain", 3), ("foo", "foo", (0, 2, 1), "plain", 0),
    ("foo", "bar", (0, 2, 1), "plain", 3), ("co-op", "coop", (0, 1, 1), "gap", 0),
    ("co-op", "coop", (0, 1, 1), "plain", 1), ("-a", "a", (0, 1, 1), "gap", 1),
    ("a-", "a", (0, 1, 1), "gap", 0), ("", "abc", (0, 2, 1), "plain", 6),
]


def test_golden_python():
    for a, b, c, h, d in GOLDEN:
        assert weighted_distance(a, b, c, h) == d, (a, b, c, h)


def test_golden_udf(spark):
    df = spark.createDataFrame([(a, b) for a, b, *_ in GOLDEN[:4]], "a string, b string")
    got = [r[0] for r in df.select(weighted_edit_distance("a", "b", (0, 1, 1))).collect()]
    assert got == [2, 2, 0, 3]  # all four with costs (0, 1, 1)


def test_columns_equal_the_plain_table(spark):
    """All three forms of the cost function, hyphens and empty words included."""
    words = ["", "-", "a-b", "ab", "co-op", "coop", "--x", "aeiou", "uoxea", "été"]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")

    def plain(x, y):
        return 0 if x == y else 2 if "-" in (x, y) else 1 if x in "aeiou" and y in "aeiou" else 3

    def column(x, y):
        v = list("aeiou")
        return (F.when(x == y, 0).when((x == "-") | (y == "-"), 2).when(x.isin(v) & y.isin(v), 1).otherwise(3))

    rows = df.select("a", "b", weighted_edit_distance("a", "b", (0, 1, 2)).alias("p"),
                     weighted_edit_distance("a", "b", (0, 1, 2), "gap").alias("g"),
                     weighted_edit_distance("a", "b", (0, 2, 3), weight=column).alias("w")).collect()
    for r in rows:
        want = (weighted_distance(r.a, r.b, (0, 1, 2)), weighted_distance(r.a, r.b, (0, 1, 2), "gap"),
                weighted_distance(r.a, r.b, (0, 2, 3), weight=plain))
        assert (r.p, r.g, r.w) == want, r


def test_fuzzy_match_brute_force(spark):
    vocab = ["the", "then", "than", "they", "a", "an", "ab", "abc", "été", "ete", "tea",
             "theatre", "thermal", "other", "x", "xy", "zzzz"]
    words = ["the", "ete", "a", "thermos", "q"]
    v = spark.createDataFrame([(t,) for t in vocab], "term string")
    w = spark.createDataFrame([(t,) for t in words], "word string")
    for k in (1, 2, 3):
        got = {(r.word, r.match, r.distance) for r in fuzzy_match(w, v, k).collect()}
        exp = {(a, b, weighted_distance(a, b)) for a in words for b in vocab
               if weighted_distance(a, b) <= k}
        assert got == exp, k


def test_levenshtein_counts_characters(spark):
    df = spark.createDataFrame([("été", "ete")], "a string, b string")
    assert df.select(F.levenshtein("a", "b")).first()[0] == 2


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

WORD = st.text(alphabet="abc-é", max_size=7)


@settings(max_examples=200, deadline=None)
@given(WORD, WORD, WORD)
def test_distance_symmetry_and_triangle(a, b, c):
    d = weighted_distance
    assert d(a, b) == d(b, a)
    assert d(a, c) <= d(a, b) + d(b, c)
    assert (d(a, b) == 0) == (a == b)
    assert abs(len(a) - len(b)) <= d(a, b) <= max(len(a), len(b))
