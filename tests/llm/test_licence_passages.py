"""Licence texts and notices that are no line of their own."""

import re
import textwrap

from inkwell.llm import licences
from inkwell.llm.licence_texts import full_texts

TEXTS = full_texts()
MIT = dict(t for t in TEXTS if t[0] == "MIT")["MIT"]


def grams(text):
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    return list(zip(w, w[1:]))


def found(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return sorted((r["doc_id"], r["line_no"], r["license"], round(r["dice"], 3), r["line"]) for r in licences.scan(docs).collect())


def best_window(text, threshold=licences.THRESHOLD):
    """Every window of the text with every template."""
    g = grams(text)
    wins = []
    for name, t in (*licences.NOTICES, *licences.full_texts()):
        b = set(grams(t))
        if len(b) > 200 or not b:
            continue
        for i in range(len(g)):
            for j in range(i + 1, min(len(g), i + 2 * len(b)) + 1):
                a = set(g[i:j])
                d = 2 * len(a & b) / (len(a) + len(b))
                if d >= threshold:
                    wins.append((-len(a & b), -d, name))
    return min(wins, default=None)


def test_wrapped_one_paragraph_and_embedded_notices(spark):
    wrapped = "readme of x\n\n" + textwrap.fill(MIT, 70) + "\nend of it"
    n = textwrap.fill(MIT, 70).count("\n") + 1
    got = found(spark, wrapped, MIT, "Copyright 2024 Example Ltd. All rights reserved.", "Licensed under the MIT License.",
                "This project is released under the MIT License, see LICENSE.", "nothing of the sort", "",
                "Some words. This work is licensed\nunder the GNU General Public License,\nversion 3. More words.")
    assert (0, 2, "MIT", 1.0, "\n".join(wrapped.split("\n")[2:2 + n])) in got
    assert (1, 0, "MIT", 1.0, MIT) in got
    assert (2, 0, "Proprietary", 1.0, "Copyright 2024 Example Ltd. All rights reserved.") in got
    assert {(r[0], r[2]) for r in got} >= {(3, "MIT"), (4, "MIT")}
    assert (7, 0, "GPL-3.0", 1.0, "Some words. This work is licensed\nunder the GNU General Public License,\nversion 3. More words.") in got
    assert {r[0] for r in got} == {0, 1, 2, 3, 4, 7}


def test_every_full_text_is_found_with_its_own_name(spark):
    got = found(spark, *[f"head of the file\n{textwrap.fill(t, 72)}\nthe tail" for _, t in TEXTS])
    for i, (name, t) in enumerate(TEXTS):
        mine = [r for r in got if r[0] == i]
        assert max(mine, key=lambda r: len(r[4]))[2:4] == (name, 1.0)


def test_the_best_window_is_that_of_brute_force(spark):
    edited = MIT.replace("without restriction", "with no limits").replace("sublicense", "rent").replace("claim", "suit")
    texts = ["before it of the " + edited + " after it in the software", "we say that all rights are reserved, all rights reserved",
             "under the licensed under the Apache License, of Version 2.0 or so", "released under a BSD 2-Clause License of the u"]
    got = found(spark, *texts)
    for i, text in enumerate(texts):
        want = best_window(text)
        mine = {(r[2], r[3]) for r in got if r[0] == i}
        assert mine == set() if want is None else (want[2], round(-want[1], 3)) in mine


def test_lines_that_match_are_not_repeated_and_copies_stay(spark):
    docs = spark.createDataFrame([(None, "a b\nReleased under the MIT License.\nc d"), (5, "x. All rights\nreserved. y")] * 2 + [(6, None)],
                                 "doc_id bigint, text string")
    got = sorted(tuple(r) for r in licences.scan(docs).select("license", "line_no", "dice", "line").collect())
    assert got == [("MIT", 1, 1.0, "Released under the MIT License.")] * 2 + [
        ("Proprietary", 0, 1.0, "x. All rights\nreserved. y")] * 2
