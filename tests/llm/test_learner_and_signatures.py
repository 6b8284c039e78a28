import random

from inkwell.llm import lz_fingerprint as lz
from inkwell.llm import quality

WORD64 = 2**64


def plain_fingerprint(text):
    """LZ78 phrases and least hashes with Python integers, one phrase at a time."""
    phrases, current = set(), ""
    for c in text:
        current += c
        if current not in phrases:
            phrases.add(current)
            current = ""
    least = [WORD64 - 1] * lz.COMPONENTS
    for p in phrases:
        h = sum((ord(c) + 1) * pow(lz._BASE, i, WORD64) for i, c in enumerate(p)) % WORD64
        h = (h ^ (h >> 31)) * 0xBF58476D1CE4E5B9 % WORD64
        h ^= h >> 29
        for j in range(lz.COMPONENTS):
            x = (h * int(lz._MULTIPLY[j]) + int(lz._ADD[j])) % WORD64
            least[j] = min(least[j], x ^ (x >> 32))
    return "".join(f"{(v * 0x94D049BB133111EB % WORD64) >> 48:04x}" for v in least)


def test_signatures_equal_a_plain_minimum_hash():
    rng = random.Random(5)
    texts = ["", "a", "aaaaaaa", "abababab", "été \U0001f600 \U0001f600", "the cat sat on the mat " * 40]
    texts += ["".join(rng.choice("ab \n") for _ in range(rng.randint(1, 400))) for _ in range(30)]
    for a, b in zip(texts, texts[1:] + texts[:1]):
        assert lz.fingerprint(a) == plain_fingerprint(a)
        parsed = lz.Parsed(a)
        assert lz.shown(parsed.parts) == plain_fingerprint(a)
        edited, parts = parsed.edited(b)
        assert edited == a[:len(a) - len(a) // 3] + b[:len(a) // 3]
        assert lz.shown(parts) == plain_fingerprint(edited)


def labelled(n, seed, noise):
    """Bad: long words together with symbols, or many words; a share of all labels is turned."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        long_words, symbols, size = rng.random() < 0.5, rng.random() < 0.5, rng.randint(60, 200)
        words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(8, 10) if long_words else rng.randint(3, 5)))
                 for _ in range(size)]
        if symbols:
            words = [w + rng.choice(["#", "##"]) for w in words]
        bad = (long_words and symbols) or size > 160
        rows.append((i, " ".join(words), int(bad != (rng.random() < noise))))
    return rows


def test_learner_grows_and_prunes_conjunctions_and_adds_rules(spark):
    schema = "doc_id bigint, text string, bad int"
    rules = quality.learn(spark.createDataFrame(labelled(1500, 1, 0.02), schema), max_rules=4)
    # Turned labels leave both classes everywhere, so every rule was grown to three conditions.
    assert len(rules) >= 2 and any(len(r) < 3 for r in rules)
    assert any({"word_length", "symbol_share"} <= {c.feature for c in r} and all(
        c.above for c in r if c.feature in ("word_length", "symbol_share")) for r in rules)
    assert any("words" in {c.feature for c in r} for r in rules)
    fresh = quality.annotate(spark.createDataFrame(labelled(400, 2, 0.0), schema), rules)
    right = [r["kept"] == (r["bad"] == 0) for r in fresh.select("kept", "bad").collect()]
    assert sum(right) >= 0.97 * len(right)


def test_learner_without_a_pattern_rejects_nothing(spark):
    rng = random.Random(3)
    rows = [(i, t, int(rng.random() < 0.3)) for i, t, _ in labelled(300, 4, 0.0)]
    assert quality.learn(spark.createDataFrame(rows, "doc_id bigint, text string, bad int")) == []
