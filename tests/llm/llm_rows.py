"""Rows of the awkward documents table."""

import random


def awkward_rows():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]

    def prose(n, vocabulary=words):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, line = prose(60), prose(12)
    texts = [prose(rng.randrange(1, 300)) for _ in range(60)]
    texts += [texts[3]] * 5 + [texts[4] + " end", "start " + texts[4]]  # copies, near copies
    texts += [prose(80) + " " + passage + " " + prose(80) for _ in range(6)]  # a shared passage
    texts += [line + "\n" + prose(100) for _ in range(6)]  # a shared line below the length
    texts += [prose(2) + " ñandú " + (prose(40) + " ") * 8, "ab" * 400, "x" * 1000, "x" * 1000]  # repeats within
    texts += [prose(6000), "", None, " \n\t ", "One", "one", "two words"]
    texts += ["Released under the MIT License.\n" + prose(70), "Licensed under the Apache licence, Version 2.0"]
    texts += [" ".join(f"{w}***" for w in rng.sample(words, 90)) for _ in range(36)]  # junk
    texts += [prose(50) + " zork " + prose(30) + ". zorkly " + prose(20) for _ in range(40)]  # toxic
    rows = [(i, x, "en", "s", None if x is None else len(x), 1, "k") for i, x in enumerate(texts)]
    rows += [(None, texts[5], None, None, 3, None, None), (None, None, None, None, None, None, None)]
    rows += [rows[7], rows[7], (8, prose(90), "en", "s", 9, 1, "k")]  # a row three times, one id twice
    return rows
