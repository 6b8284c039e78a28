"""Every registered query on the awkward tables, against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from inkwell.llm import licences, lz_fingerprint, quality, simhash
from inkwell.llm.queries import QUERIES, URL_RULES, tokenizer_path
from llm_rows import awkward_rows

SPACE = " \t\n\x0b\x0c\r"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def run(spark, tables, name):
    return rows_of(QUERIES[name](spark, tables))


def key(value):
    return (value is None, value or 0)


def same(got, want, columns):
    """Equal as multisets of rows."""
    pick = lambda rows: Counter(tuple(r[c] for c in columns) for r in rows)
    assert pick(got) == pick(want)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, empty_tables, name):
    assert run(spark, empty_tables, name) == []


def test_op1(spark, tables):
    order = sorted(((r[0], r[1] or "") for r in awkward_rows()), key=lambda r: (-(r[0] if r[0] is not None else -1), r[1]))
    want = []
    for i, (doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        n = len(text) // 3
        edited = text[:len(text) - n] + following[:n]
        a, b, c = (lz_fingerprint.Parsed(t).parts for t in (text, edited, following))
        want.append({"doc_id": doc, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
                     "fingerprint": lz_fingerprint.shown(a), "edited_fingerprint": lz_fingerprint.shown(b),
                     "near_edited": lz_fingerprint.likeness(a, b), "near_next": lz_fingerprint.likeness(a, c)})
    same(run(spark, tables, "op1_lz_fingerprint"), want, list(want[0]))


def split_words(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def statistics(text):
    ws = split_words(text)
    lines = [x for x in text.split("\n") if split_words(x)]
    windows = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    count = Counter(windows)
    inside = {j for i, w in enumerate(windows) if count[w] > 1 for j in (i, i + 1, i + 2)}
    return {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside)}


def test_op2(spark, tables):
    got = run(spark, tables, "op2_quality_rules")
    want = []
    for r in awkward_rows():
        s = statistics(r[1] or "")
        failed = s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]
        want.append({"doc_id": r[0], **s, "base_failed": failed, "kept": not failed and "***" not in (r[1] or "")})
    same(got, want, list(want[0]))


def test_decision_list_is_ordered(spark):
    first = (quality.Condition("words", True, 100.0),)
    second = (quality.Condition("words", False, 50.0), quality.Condition("symbol_share", True, 0.5))
    assert str(first[0]) == "words >= 100"
    sql = str(quality.keep_expression([first, second])._jc.toString())
    assert sql.index("100") < sql.index("50")
    rows = spark.createDataFrame([(120, 500, 0), (30, 10, 9), (30, 10, 1)], "n_words bigint, word_chars bigint, n_symbols bigint")
    values = {"words": rows["n_words"].cast("double"), "symbol_share": rows["n_symbols"] / rows["word_chars"]}
    kept = rows.select(quality.keep_expression([first, second], values).alias("k")).collect()
    assert [r["k"] for r in kept] == [False, False, True]


def test_op3(spark, tables):
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in awkward_rows():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        want.append({"doc_id": r[0], "n_tokens": len(ids), "ids_sha256": sha(" ".join(map(str, ids))),
                     "decoded_sha256": sha(tok.decode(ids, skip_special_tokens=False))})
    same(run(spark, tables, "op3_bpe_encode"), want, list(want[0]))


def judged(url):
    if url is None or "://" not in url:
        return {"host": "", "path": "", "rule": None, "verdict": "allow"}
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), h + p, a) for h, p, a in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return {"host": host, "path": path, "rule": rule, "verdict": verdict}


def test_op4(spark, tables):
    pages = rows_of(spark.read.parquet(f"{tables}/pages.parquet"))
    want = [{"page_id": p["page_id"], **judged(p["url"])} for p in pages]
    same(run(spark, tables, "op4_url_filters"), want, list(want[0]))


def test_rules_without_a_final_slash_and_salts(spark):
    from inkwell.llm.url_rules import apply_rules
    pages = spark.createDataFrame([(1, "http://x.com/abc"), (2, "http://x.com/ab"), (3, "http://x.com/"), (4, "http://y.x.com")],
                                  "page_id bigint, url string")
    rules = spark.createDataFrame([("X.com", "/ab", "block"), ("x.com", "", "allow"), ("x.com", "/ab", "allow"),
                                   (None, "/", "block")], "host string, path string, action string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows_of(apply_rules(pages, rules, "none", salts=3))}
    assert got == {1: ("x.com/ab", "block"), 2: ("x.com/ab", "block"), 3: ("x.com", "allow"), 4: ("x.com", "allow")}


def brute_components(prints):
    """Smallest id per row of a list of (id, fingerprint)."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(prints):
        r = find(i)
        if doc is not None and (least[r] is None or doc < least[r]):
            least[r] = doc
    return [least[find(i)] for i in range(len(prints))]


def test_op5(spark, tables):
    prints = [(r[0], simhash.fingerprint(r[1] or "")) for r in awkward_rows()]
    want = [{"doc_id": d, "fingerprint": f"{f:016x}", "component_id": c}
            for (d, f), c in zip(prints, brute_components(prints))]
    assert len({r["component_id"] for r in want}) < len(want) - 8
    same(run(spark, tables, "op5_simhash"), want, list(want[0]))


def test_links_and_components_of_many_fingerprints(spark):
    rng = np.random.default_rng(12)
    base = rng.integers(0, 2**63, 60, dtype=np.int64)
    values = sorted({int(b) ^ int(sum(1 << int(x) for x in rng.choice(62, rng.integers(0, 5), replace=False)))
                     for b in base for _ in range(12)})
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    n, both = simhash.bit_counts(fps)
    assert n == len(values)
    for plan in (simhash.plan(n, both), [(list(range(32)), 1), (list(range(32, 64)), 1)],
                 [(list(range(16 * i, 16 * i + 16)), 0) for i in range(4)]):
        got = {(r["u"], r["v"]) for r in simhash.links(fps, plan).collect()}
        assert got == {(a, b) for a in values for b in values if a > b and (a ^ b).bit_count() <= 3}
    # A path is the longest way for labels.
    chain = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 99)], "u bigint, v bigint")
    found = {r["node"]: r["root"] for r in simhash.components(chain).collect()}
    assert found == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}
    with pytest.raises(RuntimeError):
        simhash.components(chain, rounds=1)
    assert simhash.components(chain.limit(0)).count() == 0


def repeated(texts, length=200):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((d, gone))
    return out


def test_op6(spark, tables):
    rows = awkward_rows()
    want = []
    for r, (d, gone) in zip(rows, repeated([r[1] for r in rows])):
        left = np.frombuffer(d, dtype=np.uint8)[~gone].tobytes()
        want.append({"doc_id": r[0], "n_bytes": len(d), "n_removed": int(gone.sum()),
                     "n_spans": int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()),
                     "kept_sha256": hashlib.sha256(left).hexdigest()})
    assert sum(w["n_spans"] > 0 for w in want) > 15
    same(run(spark, tables, "op6_suffix_dedup"), want, list(want[0]))


def test_op6_hot_anchors(spark, tables, monkeypatch):
    """With the bound for hot anchors at nothing, all repeats take that way."""
    from inkwell.llm import suffix
    monkeypatch.setattr(suffix, "HOT_ENTRIES", 1)
    texts = [r[1] for r in awkward_rows()]
    found = suffix.entries(suffix.keyed(spark.read.parquet(f"{tables}/documents.parquet")), 200)
    assert suffix.hot_anchors(found, 1 << 20).count() > 20
    monkeypatch.setattr(suffix, "hot_anchors", lambda f, s, g=suffix.hot_anchors: g(f, 1 << 20))
    got = rows_of(suffix.remove_repeats(spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")))
    want = [{"doc_id": r[0], "n_removed": int(gone.sum())} for r, (_, gone) in zip(awkward_rows(), repeated(texts))]
    same(got, want, ["doc_id", "n_removed"])


def test_index_levels_meet_all_equal_keys():
    from inkwell.llm.suffix import Levels
    rng = np.random.default_rng(13)
    keys = rng.integers(0, 400, 500)
    levels = Levels(keys)
    for part in np.array_split(rng.permutation(500), 7):
        levels.insert(part)
    values, counts = np.unique(keys, return_counts=True)
    assert (levels.met == np.isin(keys, values[counts > 1])).all()
    assert [rank for rank, _ in levels.levels] == [2, 1, 0]  # 7 = 4 + 2 + 1
    assert all((np.diff(keys[level]) >= 0).all() for _, level in levels.levels)


def test_op7(spark, tables):
    got = run(spark, tables, "op7_token_counts")
    same(got, [{"doc_id": r[0], "n_words": len(split_words(r[1] or ""))} for r in awkward_rows()], ["doc_id", "n_words"])
    assert all((r["n_tokens"] == 0) == (r["n_words"] == 0) and r["n_tokens"] >= r["n_words"] for r in got)


def test_op8(spark, tables):
    got = run(spark, tables, "op8_toxicity")
    same(got, [{"doc_id": r[0], "held_out": r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0,
                "predicted": int("zork" in (r[1] or ""))} for r in awkward_rows()], ["doc_id", "held_out", "predicted"])
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.5) == bool(r["predicted"]) for r in got)
    assert all(len(r["toxic_spans"]) == 2 for r in got if r["predicted"])


def check_packing(got, docs):
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want, total = Counter(), 0
    for doc, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        total += len(ids)
        for i, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a:a + 4096]
            want[(doc, i, a, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-total // 4096) + 2


def test_op9(spark, tables):
    check_packing(run(spark, tables, "op9_packing"), [(r[0], r[1]) for r in awkward_rows()])


def test_op9_many_shards(spark, tables):
    from inkwell.llm import packing
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = rows_of(packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), shard=40, islands=3, epochs=3))
    check_packing(got, [(r[0], r[1]) for r in awkward_rows()])


def grams(text):
    ws, w = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            w += c
        elif w:
            ws.append(w)
            w = ""
    return set(zip(ws, ws[1:]))


def test_op10(spark, tables):
    want = []
    for r in awkward_rows():
        for i, line in enumerate((r[1] or "").split("\n")):
            a = grams(line)
            found = [(2 * len(a & b) / (len(a) + len(b)), name) for name, b in
                     ((n, grams(t)) for n, t in licences.NOTICES) if a]
            best = max((d for d, _ in found), default=0)
            if best >= licences.THRESHOLD:
                want.append({"doc_id": r[0], "line_no": i, "license": min(n for d, n in found if d == best),
                             "dice": best, "line": line})
    assert {w["license"] for w in want} == {"MIT", "Apache-2.0"} or len(want) >= 1
    same(run(spark, tables, "op10_license_scans"), want, ["doc_id", "line_no", "license", "dice", "line"])


def test_size_bounds_are_exact():
    for n in range(1, 40):
        low, high = licences.size_bounds(n, 0.8)
        for m in range(1, 120):
            assert (low <= m <= high) == (2 * min(n, m) / (n + m) >= 0.8)


def test_pipeline_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    state = [(r[0], r[1]) for r in awkward_rows()]
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, tables), f"t-{name}")
        assert docs.columns == corpus_pipeline.COLUMNS
        if name == "toxicity":
            state = [r for r in state if "zork" not in (r[1] or "")]
        elif name == "quality":
            state = [r for r in state if statistics(r[1] or "")["n_words"] >= 50 and "***" not in r[1]
                     and 2 * statistics(r[1])["n_repeat_words"] <= statistics(r[1])["n_words"]]
        elif name == "near_dedup":
            prints = [(i, simhash.fingerprint(r[1] or "")) for i, r in enumerate(state)]
            groups = defaultdict(list)
            for r, c in zip(state, brute_components(prints)):
                groups[c].append(r)
            got = Counter((r["doc_id"], r["text"]) for r in docs.collect())
            assert sum(got.values()) == len(groups)
            for own in groups.values():
                least = min(key(r[0]) for r in own)
                assert sum(got[r] for r in set(own) if key(r[0]) == least) == 1
            state = list(got)
        else:
            state = [(r[0], np.frombuffer(d, np.uint8)[~gone].tobytes().decode("utf-8", "ignore"))
                     for r, (d, gone) in zip(state, repeated([t for _, t in state]))]
        assert Counter((r["doc_id"], r["text"]) for r in docs.collect()) == Counter(state), name
    check_packing(rows_of(corpus_pipeline.STAGES[4][1](spark, docs, tables)), state)


def test_pipeline_runs(spark, tables, empty_tables):
    assert corpus_pipeline.run(spark, tables).count() > 0
    assert corpus_pipeline.run(spark, empty_tables).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "repeats", "packing"]
