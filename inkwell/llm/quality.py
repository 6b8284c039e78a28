"""Quality rules: statistics of a text and a learned decision list over them
(DataFrame functions only).

A decision list is an ordered list of rules, each a conjunction of threshold
conditions over statistics; the first rule that holds rejects the document,
none keeps it.  Sequential covering learns it: grow a conjunction condition by
condition (greatest information gain for the rejected class), prune it from
its end on held-back rows, accept it if it is precise there, remove what it
covers, go on.  Every step counts classes per (feature, bin) with one Spark
aggregate; the driver sees at most ``features * bins`` counts.

Fit sample: the ``max_labelled`` (20,000) labelled documents that come first
by a hash of doc_id, whatever the size of the corpus.  Everything else runs on
every document, as one projection without a shuffle.

Words are runs of characters other than blank and \\t to \\r.  A null or empty
text has no words, fails the base rules and is rejected.  Labels with a null
doc_id or a null class are ignored; a doc_id with both classes counts as
rejected.  Without labels of both classes the list is empty and only the base
rules reject.  Repeated rows are judged one by one, other columns are kept by
``annotate`` (a column named like a statistic is replaced).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import WORD_GAP, WORD_GAP_CHARS, stored, text_or_empty

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MAX_LABELLED = 20_000


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the columns of ``STATS`` to a frame with a text column.

    The words, the 3-word windows and the windows sorted with their positions
    are columns of intermediate projections, so that each is made once per
    row; sorting brings equal windows together, in n log n steps for a text
    of any length.  The statistics leave through a generator: a filter on them
    is not pushed below it, where it would spell out all of this again."""
    text = text_or_empty(text_col)
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1),
                     lambda x: F.translate(x, WORD_GAP_CHARS, "") != "")
    n = F.size("_words")
    windows = F.when(n < 3, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.concat_ws(
            " ", F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))))
    # Only texts with a repeated window are sorted.
    placed = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    return (docs.withColumn("_words", words).withColumn("_lines", lines)
            .withColumn("_windows", windows)
            .withColumn("_placed", placed)
            .withColumn("_made", F.explode(F.array(F.struct(
                n.cast("bigint").alias("n_words"),
                F.length(F.translate(text, WORD_GAP_CHARS, "")).cast("bigint").alias("word_chars"),
                (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
                (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
                _repeat_words().alias("n_repeat_words")))))
            .withColumns({k: F.col(f"_made.{k}") for k in STATS})
            .drop("_words", "_lines", "_windows", "_placed", "_made"))


def _repeat_words() -> Column:
    """Words within windows that come twice or more: positions of repeated
    windows in order, each adding the words that the one before left out."""
    s, n = F.col("_placed"), F.size("_placed")
    none = F.array(F.lit(None).cast("struct<w:string,i:int>"))
    trio = F.arrays_zip(s.alias("s"), F.concat(none, F.slice(s, 1, n - 1)).alias("p"),
                        F.concat(F.slice(s, 2, n - 1), none).alias("q"))
    repeated = F.filter(trio, lambda x: F.coalesce(x["s"]["w"] == x["p"]["w"], F.lit(False))
                        | F.coalesce(x["s"]["w"] == x["q"]["w"], F.lit(False)))
    starts = F.sort_array(F.transform(repeated, lambda x: x["s"]["i"]))
    total = F.aggregate(
        starts, F.struct(F.lit(0).alias("sum"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["sum"] + F.least(F.lit(3), i - a["last"])).alias("sum"), i.alias("last")))
    return F.when(s.isNull(), F.lit(0)).otherwise(total["sum"]).cast("bigint")


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def features() -> dict[str, Column]:
    """Learnable statistics; ratios so that a long text is judged like a short one."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {"words": F.col("n_words").cast("double"),
            "word_length": F.col("word_chars") / n,
            "symbol_share": F.col("n_symbols") / chars,
            "dup_lines_per_100_words": 100 * F.col("n_dup_lines") / n,
            "repeat_share": F.col("n_repeat_words") / n}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def column(self, value: Column) -> Column:
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule, values: dict[str, Column]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(values[c.feature])
    return out


def keep_expression(rules: list[Rule], values: dict[str, Column] | None = None) -> Column:
    """The list as one ordered conditional: false at the first rule that
    holds, true if none does."""
    values = values or features()
    out = None
    for rule in rules:
        holds = _holds(rule, values)
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame,
                    max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, bad) of the labelled documents in the fit sample.  The
    sampled ids are broadcast: at most ``max_labelled`` of them."""
    ids = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy("doc_id").agg((F.min("quality") == 0).cast("int").alias("bad"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def _entropy_gain(p: float, n: float, p0: float, n0: float) -> float:
    """FOIL gain of going from (p0, n0) covered rows of the target and the
    other class to (p, n)."""
    if p <= 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts are not above the value."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value))


def learn(sample: DataFrame, bins: int = 32, max_rules: int = 8, max_conditions: int = 3,
          min_precision: float = 0.9, min_cover: int = 10) -> list[Rule]:
    """Decision list from (doc_id, text, bad) rows that pass the base rules."""
    values = features()
    rows = stored(
        with_statistics(sample).filter(~base_failed())
        .select("bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("held"),
                *[v.alias(k) for k, v in values.items()]), "quality-fit")
    names = list(values)
    cols = {k: F.col(k) for k in names}
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    # Cuts: quantiles of either class, so that a rare class has its own.
    found = rows.groupBy("bad").agg(*[F.percentile_approx(k, at, 10_000).alias(k) for k in names]).collect()
    if len(found) < 2:
        return []
    cuts = {k: sorted({float(x) for r in found for x in r[k]}) for k in names}

    def counts(left: DataFrame, rule: Rule):
        """{feature: [(bad, good) per bin]} of the rows to grow on."""
        bin_of = [F.struct(F.lit(k).alias("f"), _bin(cols[k], cuts[k]).alias("b")) for k in names]
        got = (left.filter(~F.col("held") & _holds(rule, cols))
               .select("bad", F.explode(F.array(*bin_of)).alias("x"))
               .groupBy("x.f", "x.b").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
               .collect())
        out = {k: [[0, 0] for _ in range(len(cuts[k]) + 1)] for k in names}
        for r in got:
            out[r["f"]][r["b"]] = [r["p"], r["n"]]
        return out

    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        rule: Rule = ()
        while len(rule) < max_conditions:
            table = counts(left, rule)
            p0, n0 = (sum(x[i] for x in table[names[0]]) for i in (0, 1))
            if p0 < min_cover or n0 == 0:
                break
            best = (1e-9, None)
            for k in names:
                p = n = 0
                for b, cut in enumerate(cuts[k]):
                    p, n = p + table[k][b][0], n + table[k][b][1]
                    for above, (pp, nn) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        gain = _entropy_gain(pp, nn, p0, n0)
                        if pp >= min_cover and gain > best[0]:
                            best = (gain, Condition(k, above, cut))
            if best[1] is None:
                break
            rule = (*rule, best[1])
        if not rule:
            break
        # Prune: the prefix with the best (bad - good) / (bad + good) on held rows.
        held = left.filter("held").agg(*[
            f for i in range(1, len(rule) + 1) for f in (
                F.sum(F.when(_holds(rule[:i], cols), F.col("bad"))).alias(f"p{i}"),
                F.sum(F.when(_holds(rule[:i], cols), 1 - F.col("bad"))).alias(f"n{i}"))]).first()
        worth = [((held[f"p{i}"] or 0) / max(1, (held[f"p{i}"] or 0) + (held[f"n{i}"] or 0)), -i)
                 for i in range(1, len(rule) + 1)]
        precision, size = max(worth)
        if precision < min_precision:
            break
        rule = rule[:-size]
        rules.append(rule)
        left = left.filter(~_holds(rule, cols))
    return rules


def annotate(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """Add the statistics, ``base_failed`` and ``kept``."""
    return (with_statistics(docs, text_col).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & keep_expression(rules)))
