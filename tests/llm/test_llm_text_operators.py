"""Operators that work on one text at a time, against libraries and brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

from inkwell.llm import bpe, lz_fingerprint, packing, simhash, toxicity, unigram
from inkwell.llm.queries import tokenizer_path

WORD_BPE = tokenizer_path("word_bpe_49k.json")


def texts():
    rng = random.Random(1)
    out = ["", " ", "Hello  World! it's 42 l'été ΑΣ ﬁ İstanbul <|endoftext|>x <|startoftext|>",
           "a" * 500 + " " + "xyz" * 300, "naïve café \x1c b c\x85d e", "日本語テキスト 🙂🙂 foo_bar--baz..",
           "don't we'll I'M 'S 'd ''ve", "line\nline\n\nlast "]
    out += ["".join(rng.choice("abcdeé ñ'12!<|>\n\tΣİß日🙂") for _ in range(rng.randrange(40))) for _ in range(150)]
    out += [" ".join("".join(rng.choice("aeiourstnl") for _ in range(rng.randrange(1, 14))) for _ in range(60))
            for _ in range(20)]
    return out


@pytest.fixture(scope="module")
def encoder(tmp_path_factory):
    model = bpe.Model(WORD_BPE)
    words = Counter(w for t in texts() for c in bpe.chunks(t) for w in bpe.split_words(c))
    path = str(tmp_path_factory.mktemp("lexicon") / "lexicon.bin")
    model.lexicon_file(path, [w.encode() for w, _ in words.most_common(400) if len(w.encode()) <= bpe.LONGEST])
    return bpe.Encoder(bpe.Lexicon(path), model.special)


def test_bpe_equals_the_library(encoder):
    tok = Tokenizer.from_file(WORD_BPE)
    for t, (n, ids, decoded) in zip(texts(), encoder.rows(texts())):
        want = tok.encode(t, add_special_tokens=False).ids
        assert n == len(want) and ids == " ".join(map(str, want))
        assert decoded == tok.decode(want, skip_special_tokens=False)
        assert bpe.decode(encoder.ids(t), encoder.lexicon.strings) == decoded


def test_lexicon_accepts_its_words_only(encoder):
    words = sorted({"", "a", "ab", "abc", "b", "bab", "cab", "zebra"} - {""})
    keys, targets, numbers, final = bpe.compile_lexicon([w.encode() for w in words])
    seen = {}
    for w in [*words, "ba", "c", "abcd", "x", "zebr"]:
        state, number = 0, 0
        for b in w.encode():
            at = np.searchsorted(keys, state * 256 + b)
            if at == len(keys) or keys[at] != state * 256 + b:
                state = -1
                break
            state, number = targets[at], number + numbers[at]
        if state >= 0 and final[state]:
            seen[w] = number
    assert seen == {w: i for i, w in enumerate(words)}
    assert len(final) < sum(map(len, words))  # suffixes are shared


def test_chunk_tokens_equal_the_library():
    with open(WORD_BPE, encoding="utf-8") as f:
        own = packing.ChunkTokens(f.read())
    tok = Tokenizer.from_file(WORD_BPE)
    for t, ids in zip(texts(), own.encode(texts())):
        assert ids == np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_chunk_tokens_outside_the_plain_characters_and_with_a_full_cache():
    with open(WORD_BPE, encoding="utf-8") as f:
        own = packing.ChunkTokens(f.read(), budget=20_000)
    tok = Tokenizer.from_file(WORD_BPE)
    odd = ["I'll DON'T 'S x's 'T", "İstanbul ıI ΣΑΣ µm ª²½ Ŀŉſ", "e\u0301 Å ﬁ \x01\x7f a\xadb", "<|startoftext|>a <|endoftext|> <|x",
           "日本 1٢३ ǅ ß ẞ", "a\x85b\xa0c\u2003d", "".join(map(chr, range(33, 0x250)))]
    for _ in range(3):
        words = [" ".join(f"{w}{i}" for i in range(60) for w in ("Word", "été,", "x")) for _ in range(4)]
        for t, ids in zip(odd + words, own.encode(odd) + own.encode(words)):
            assert ids == np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert max(own.words.bytes, own.chunks.bytes) < 200_000


def test_rare_toxic_words_and_small_classes():
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(3000)]
    rude = ["".join(rng.choice("qxzvkj") for _ in range(7)) for _ in range(120)]
    prose = lambda: [rng.choice(plain) for _ in range(rng.randrange(20, 120))]

    def made(n, words):
        out = []
        for _ in range(n):
            ws = prose()
            for _ in range(4):
                ws.insert(rng.randrange(len(ws)), rng.choice(words))
            out.append(" ".join(ws))
        return out

    clean = [" ".join(prose()) for _ in range(1000)]
    crf = toxicity.fit(made(800, rude) + clean[:700], [1] * 800 + [0] * 700)  # a word in 2.6 % of the toxic texts
    score = toxicity.Scorer(crf)
    assert (score(made(100, rude))[0] >= 0.5).mean() > 0.95 and (score(clean[700:])[0] >= 0.5).mean() < 0.02
    crf = toxicity.fit(made(10, rude[:5]) + clean[:58], [1] * 10 + [0] * 58)
    score = toxicity.Scorer(crf)
    assert (score(made(50, rude[:5]))[0] >= 0.5).mean() > 0.5 and (score(clean[700:])[0] >= 0.5).mean() < 0.05


@pytest.mark.parametrize("ties", [False, True])
def test_unigram_counts_equal_the_library(ties):
    voc = unigram.ranked_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    if ties:  # whole numbers: many equal scores
        voc = [(p, float(round(s))) for p, s in voc]
    least = min(s for _, s in voc)
    tok = Tokenizer(models.Unigram([("<unk>", least), *voc, *((f"<0x{i:02X}>", least) for i in range(256))],
                                   unk_id=0, byte_fallback=True))
    tok.normalizer = normalizers.Sequence([normalizers.Replace(Regex("[ \\t-\\r]+"), " "), normalizers.Strip()])
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = unigram.Counter(voc)
    for t in texts():
        if t.strip():
            assert counter.tokens(t) == len(tok.encode(t).ids), t
    assert counter.tokens("") == 0 == unigram.Counter([]).tokens(" ")


def test_lz_phrases_and_edited_state():
    rng = random.Random(2)
    for t in texts():
        phrases, w = set(), ""
        for c in t:
            w += c
            if w not in phrases:
                phrases.add(w)
                w = ""
        known: set = set()
        lz_fingerprint.phrase_ends(t, 0, len(t), known)
        assert known == phrases
        following = rng.choice(texts())
        parsed = lz_fingerprint.Parsed(t)
        edited, parts = parsed.edited(following)
        assert edited == t[:len(t) - len(t) // 3] + following[:len(t) // 3]
        assert (parts == lz_fingerprint.Parsed(edited).parts).all()


def test_lz_likeness_orders_texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    a = " ".join(rng.choice(words) for _ in range(400))
    b = a[:2 * len(a) // 3] + "".join(rng.choice("klmnopqrst ") for _ in range(len(a) // 3))
    c = "".join(rng.choice("klmnopqrst ") for _ in range(len(a)))
    parts = [lz_fingerprint.Parsed(t).parts for t in (a, b, c)]
    like = lz_fingerprint.likeness
    assert like(parts[0], parts[0]) == 1 and like(parts[0], parts[1]) > like(parts[0], parts[2]) + 0.1
    assert lz_fingerprint.likeness(lz_fingerprint.Parsed("").parts, lz_fingerprint.Parsed("").parts) == 1


def test_simhash_fingerprint_definition():
    import xxhash
    for t in texts():
        words = t.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))
        assert simhash.fingerprint(t) == want


def test_thresholds_cover_all_pairs():
    """Any two words within the radius meet in some partition of the plan."""
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 2, (300, 64))
    bits[:, 32:40] = bits[:, :8]  # correlated bits
    both = (bits.T @ bits).astype(float)
    for n in (300, 10_000, 50_000_000):
        scale = n / 300
        asked = simhash.plan(n, both * scale)
        assert sorted(b for part, _ in asked for b in part) == sorted({b for part, _ in asked for b in part})
        for _ in range(200):
            flips = set(rng.choice(64, 3, replace=False).tolist())
            assert any(len(flips.intersection(part)) <= t for part, t in asked)
    part = simhash.group_bits(300, both, 8)[0]
    assert any({b, b + 32} <= set(part) for b in range(8))


def test_evolved_packings_are_whole():
    rng = random.Random(5)
    for n in (0, 1, 7, 600):
        sizes = [min(4096, int(rng.expovariate(1 / 1500)) + 1) for _ in range(n)]
        best = packing.evolve(sizes, 4096, seed=9)[0]
        assert sorted(i for g in best for i in g) == list(range(n))
        assert all(sum(sizes[i] for i in g) <= 4096 for g in best)
        assert len(best) <= -(-sum(sizes) // 4096) * 1.05 + 1
        assert packing.evolve(sizes, 4096, seed=9)[0] == best  # a rerun gives the same


def test_crossover_and_mutation_keep_all_items():
    rng = random.Random(6)
    sizes = [rng.randrange(1, 60) for _ in range(200)]
    a = packing.first_solution(sizes, 100, rng, 0.0)
    b = packing.first_solution(sizes, 100, rng, 0.5)
    for g in (packing.crossover(a, b, sizes, 100, rng), packing.mutate(b, sizes, 100, rng)):
        assert sorted(i for x in g for i in x) == list(range(200))
        assert all(sum(sizes[i] for i in x) <= 100 for x in g)


def test_crf_messages_equal_enumeration():
    rng = np.random.default_rng(7)
    crf = toxicity.Crf(first=-0.5, enter=-1.0, leave=0.3, stay=0.8)
    lengths = np.array([1, 4, 3, 6])
    e = rng.normal(size=int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    got = toxicity.sigmoid(crf.logits(e, starts, lengths))
    trans = {(0, 0): 0.0, (0, 1): crf.enter, (1, 0): crf.leave, (1, 1): crf.stay}
    for s, n in zip(starts, lengths):
        weight = np.zeros(2 ** n)
        tags = (np.arange(2 ** n)[:, None] >> np.arange(n)) & 1
        for k, y in enumerate(tags):
            weight[k] = crf.first * y[0] + (e[s:s + n] * y).sum() + sum(trans[a, b] for a, b in zip(y, y[1:]))
        p = np.exp(weight) / np.exp(weight).sum()
        assert np.allclose(got[s:s + n], p @ tags)


def test_crf_learns_spans_and_offsets():
    rng = random.Random(8)
    clean = ["".join(rng.choice("aeiourst") for _ in range(6)) for _ in range(200)]
    bad = ["zork", "zorkly", "blimp"]

    def doc(toxic):
        ws = [rng.choice(clean) for _ in range(60)]
        if toxic:
            for _ in range(4):
                ws[rng.randrange(60)] = rng.choice(bad)
        return " ".join(ws[:30]) + ".\n" + "\t".join(ws[30:])

    labels = [i % 2 for i in range(300)]
    docs = [doc(y) for y in labels]
    crf = toxicity.fit(docs[:200], labels[:200])
    scores, spans = toxicity.Scorer(crf)([*docs[200:], "", "zork " * 3])
    assert [int(s >= 0.5) for s in scores] == [*labels[200:], 0, 1]
    for text, own in zip(docs[200:], spans):
        assert all(text[x["start"]:x["end"]].strip(".") in bad for x in own)
    assert toxicity.fit(["a"], [0]).score[0] < 0  # one class only: nothing is toxic
    assert toxicity.held_out(0) == (zlib.crc32(b"0") % 5 == 0)
