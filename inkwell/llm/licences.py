"""Licence scan: lines compared to licence templates by the Dice coefficient
over word bigrams (DataFrame functions only).

A line's words are its lower-cased runs of letters and digits; its set of
distinct word bigrams A meets a template's set B with
``2 |A n B| / (|A| + |B|)``.  A line with a single word, or none, has no
bigram and matches nothing.  With a threshold t, a pair can only reach it
when ``|B| t / (2 - t) <= |A| <= |B| (2 - t) / t``: every template is listed
under the sizes it admits, and a line meets only the templates listed under
its own size, through an equi-join on the size.

The template table is a fixed text of a few dozen rows, so the size table is
bounded by ``len(templates) * largest template * (2 - t) / t`` rows and is
broadcast.  No document row is shuffled.

Passages: the same notices, full licence texts and file headers
(``licence_texts``) are also met with word windows of the whole text, across
line ends, so wrapped, one-paragraph and embedded notices count.  A window
can only reach t when it holds ``|B| t / (2 - t)`` of a template's bigrams, so
a text that does not hold them anywhere is left out (by 64-bit hashes, which
never lose an equal pair; the windows themselves compare the words).  A
window begins and ends with a run of words that the template has too: any
other can be shortened or lengthened without a lower coefficient.  An outer
run is dropped when the gap behind it is over ``(2 - t) / t`` times its
length, which lowers the coefficient for any window that reaches t.  A window
of several runs has ``(2 - t) / t`` times the template's words at most.  Of
overlapping windows the one with most shared bigrams stays (ties: the
greater coefficient, the name that sorts first, the earlier one).

Rows out: one per matching line, with the best template (ties: the name that
sorts first); and one per passage, unless it lies within a line that matches
as a whole: line_no is the line where it begins, line the whole lines that it
touches.  Null and empty texts give none; a null doc_id is kept; copies
of a row give copies of its matches; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.licence_texts import full_texts

THRESHOLD = 0.8
# Templates that need so many bigrams are only met with texts that have as many.
LONG = 300

# Short notices by which texts name their licence.
NOTICES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)


def words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bigrams(ws: Column) -> Column:
    """Distinct word bigrams of an array of words."""
    n = F.size(ws)
    pairs = F.zip_with(F.slice(ws, 1, F.greatest(n - 1, F.lit(0))),
                       F.slice(ws, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Sizes of a set that can reach the threshold with a set of n."""
    low = math.ceil(n * threshold / (2 - threshold) - 1e-9)
    high = math.floor(n * (2 - threshold) / threshold + 1e-9)
    return low, high


def _templates(docs: DataFrame, templates, threshold: float) -> DataFrame:
    """size -> the templates that a line of that many bigrams can match."""
    spark = docs.sparkSession
    listed = (spark.createDataFrame(list(templates), "name string, notice string")
              .withColumn("bigrams", bigrams(words(F.col("notice"))))
              .withColumn("n", F.size("bigrams")).filter("n > 0"))
    low = F.ceil(F.col("n") * threshold / (2 - threshold) - 1e-9).cast("int")
    high = F.floor(F.col("n") * (2 - threshold) / threshold + 1e-9).cast("int")
    return (listed.withColumn("size", F.explode(F.sequence(low, high)))
            .groupBy("size").agg(F.collect_list(F.struct("name", "n", "bigrams")).alias("fits")))


def _let(value: Column, body) -> Column:
    """body(value), with the value made once."""
    return F.transform(F.array(value), body)[0]


def _hashes(ws: Column) -> Column:
    """Distinct 64-bit hashes of the word bigrams of an array of words."""
    n = F.greatest(F.size(ws) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(ws, 1, n), F.slice(ws, 2, n), lambda a, b: F.xxhash64(a, b)))


def _library(docs: DataFrame, notices, texts, threshold: float) -> DataFrame:
    """One row: all templates, and the hashes of the shorter and longer ones."""
    rows = [(n, t, True) for n, t in notices] + [(n, t, False) for n, t in texts]
    ws = words(F.col("text"))
    listed = (docs.sparkSession.createDataFrame(rows, "name string, text string, notice boolean").distinct()
              .withColumn("bigrams", bigrams(ws)).withColumn("n", F.size("bigrams")).filter("n > 0")
              .withColumn("hashes", _hashes(ws))
              .withColumn("need", F.ceil(F.col("n") * threshold / (2 - threshold) - 1e-9).cast("int"))
              .withColumn("longest", F.floor((F.size(ws) - 1) * (2 - threshold) / threshold + 1e-9).cast("int")))
    short = F.col("need") < LONG
    return listed.coalesce(1).agg(
        F.collect_list(F.struct("name", "notice", "bigrams", "n", "hashes", "need", "longest")).alias("templates"),
        F.array_distinct(F.flatten(F.collect_list(F.when(short, F.col("hashes"))))).alias("short_hashes"),
        F.array_distinct(F.flatten(F.collect_list(F.when(~short, F.col("hashes"))))).alias("long_hashes"))


def _fitting(ws: Column) -> Column:
    """Templates whose needed number of bigrams the words have anywhere."""
    def known(h: Column) -> Column:
        return F.concat(F.array_intersect("short_hashes", h),
                        F.when(F.size(h) >= LONG, F.array_intersect("long_hashes", h))
                        .otherwise(F.array().cast("array<bigint>")))

    def fits(k: Column) -> Column:
        return F.filter("templates", lambda t: F.when(
            F.size(k) >= t["need"], F.size(F.array_intersect(t["hashes"], k)) >= t["need"]).otherwise(F.lit(False)))

    return _let(_let(_hashes(ws), known), fits)


def _windows(grams: Column, t: Column, threshold: float) -> Column:
    """Windows of a text's word bigrams that reach the threshold with one
    template: (-shared, -dice, name, first, last)."""
    wide = (2 - threshold) / threshold

    def scored(r: Column, u: Column) -> Column:
        inside = F.slice(grams, r["first"] + 1, u["last"] - r["first"] + 1)
        return _let(F.array_distinct(inside), lambda a: _let(F.size(F.array_intersect(a, t["bigrams"])), lambda k: F.struct(
            (-k).alias("shared"), (F.lit(-2.0) * k / (F.size(a) + t["n"])).alias("dice"), t["name"].alias("name"),
            r["first"].alias("first"), u["last"].alias("last"))))

    def pairs(runs: Column) -> Column:
        def ends(r: Column, i: Column) -> Column:
            after = F.when(r["opens"], F.filter(F.slice(runs, i + 2, F.size(runs)), lambda u: u["closes"] & (
                u["last"] - r["first"] < t["longest"]) & (u["upto"] - r["before"] >= t["need"])))
            alone = F.when(r["upto"] - r["before"] >= t["need"], F.array(r))
            none = F.slice(runs, 1, 0)
            return F.transform(F.concat(F.coalesce(alone, none), F.coalesce(after, none)), lambda u: scored(r, u))
        return F.filter(F.flatten(F.transform(runs, ends)), lambda w: -w["dice"] >= threshold)

    def spans(hits: Column) -> Column:
        """Runs of hits, with the numbers of hits before and up to their ends."""
        at = F.transform(hits, lambda p, j: F.struct(p.alias("p"), j.alias("j")))
        firsts = F.filter(at, lambda x: (x["j"] == 0) | (F.get(hits, x["j"] - 1) < x["p"] - 1))
        lasts = F.filter(at, lambda x: (x["j"] == F.size(hits) - 1) | (F.get(hits, x["j"] + 1) > x["p"] + 1))
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(
            a["p"].alias("first"), b["p"].alias("last"), a["j"].alias("before"), (b["j"] + 1).alias("upto"),
            # The gap to the next and to the last run, against this run's length.
            F.coalesce(F.get(hits, b["j"] + 1) - b["p"] - 1 <= (b["p"] - a["p"] + 1) * wide, F.lit(False)).alias("opens"),
            F.coalesce((a["j"] > 0) & (a["p"] - F.get(hits, F.greatest(a["j"] - 1, F.lit(0))) - 1
                                       <= (b["p"] - a["p"] + 1) * wide), F.lit(False)).alias("closes")))

    places = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(t["bigrams"], g), i)),
                      lambda p: p.isNotNull())
    return _let(_let(places, spans), pairs)


def _apart(found: Column) -> Column:
    """The best windows, none of which has a word of another."""
    return F.aggregate(F.array_sort(found), F.slice(found, 1, 0), lambda kept, x: F.when(
        F.exists(kept, lambda y: (x["first"] <= y["last"] + 1) & (y["first"] <= x["last"] + 1)), kept)
        .otherwise(F.concat(kept, F.array(x))))


def passages(docs: DataFrame, notices=NOTICES, texts=None, threshold: float = THRESHOLD,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no, license, dice, line), one row per passage of the
    whole text that is no part of a matching line."""
    library = F.broadcast(_library(docs, notices, full_texts() if texts is None else texts, threshold))
    fitting = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).crossJoin(library)
               .select("doc_id", "text", F.filter("templates", lambda t: t["notice"]).alias("notices"),
                       F.explode(F.array(_let(words(F.col("text")), _fitting))).alias("fits"))
               .filter(F.size("fits") > 0))
    lines = F.split("text", "\n", -1)
    # One word per element, with the number of its line.
    numbered = F.flatten(F.transform(lines, lambda l, i: F.transform(
        words(l), lambda w: F.struct(w.alias("w"), i.alias("i")))))
    found = _let(numbered, lambda ws: _let(
        F.zip_with(F.slice(ws, 1, F.size(ws) - 1), F.slice(ws, 2, F.size(ws) - 1),
                   lambda a, b: F.concat(a["w"], F.lit(" "), b["w"])),
        lambda grams: F.transform(
            _let(F.flatten(F.transform("fits", lambda t: _windows(grams, t, threshold))), _apart),
            lambda x: F.struct(x["name"].alias("license"), (-x["dice"]).alias("dice"),
                               F.get(ws, x["first"])["i"].alias("low"), F.get(ws, x["last"] + 1)["i"].alias("high")))))
    line = F.array_join(F.slice(lines, F.col("p.low") + 1, F.col("p.high") - F.col("p.low") + 1), "\n")
    whole = F.exists("notices", lambda t: F.lit(2.0) * F.size(F.array_intersect("bigrams", t["bigrams"]))
                     / (F.size("bigrams") + t["n"]) >= threshold)
    return (fitting.select("doc_id", "text", "notices", F.explode(found).alias("p"))
            .select("doc_id", "notices", F.col("p.low").cast("bigint").alias("line_no"), "p.license", "p.dice",
                    line.alias("line"), (F.col("p.low") == F.col("p.high")).alias("one"))
            .withColumn("bigrams", bigrams(words(F.col("line"))))
            .filter(~(F.col("one") & whole))
            .select("doc_id", "line_no", "license", "dice", "line"))


def scan(docs: DataFrame, templates=NOTICES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text", texts=None) -> DataFrame:
    """(doc_id, line_no from 0, license, dice, line): the matching lines and
    the passages."""
    return matching_lines(docs, templates, threshold, id_col, text_col).unionByName(
        passages(docs, templates, texts, threshold, id_col, text_col))


def matching_lines(docs: DataFrame, templates=NOTICES, threshold: float = THRESHOLD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no from 0, license, dice, line), one row per matching
    line; lines end at \\n."""
    sizes = _templates(docs, templates, threshold)
    lines = (docs.select(F.col(id_col).alias("doc_id"),
                         F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line"))
             .filter(F.length("line") > 2)  # two words at least
             .withColumn("bigrams", bigrams(words(F.col("line")))))
    # coalesce: a key that is never null needs no filter that makes it twice.
    met = lines.join(F.broadcast(sizes), F.coalesce(F.size("bigrams"), F.lit(0)) == F.col("size"))
    scores = F.transform("fits", lambda t: F.struct(
        (F.lit(2.0) * F.size(F.array_intersect(F.col("bigrams"), t["bigrams"]))
         / (F.size("bigrams") + t["n"])).alias("dice"), t["name"].alias("name")))
    best = F.array_max(F.transform(scores, lambda s: s["dice"]))
    return (met.withColumn("scores", scores).withColumn("dice", best)
            .filter(F.col("dice") >= threshold)
            .select("doc_id", F.col("line_no").cast("bigint").alias("line_no"),
                    F.array_min(F.transform(
                        F.filter("scores", lambda s: s["dice"] == F.col("dice")),
                        lambda s: s["name"])).alias("license"),
                    "dice", "line"))
