def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_every_word_of_the_log_is_matched(spark, tmp_path):
    import re
    from inkwell.plans.catalog import REGISTRY
    texts = ["river silver liver deliver", "stone stones tone alone", "river stone paper pepper"]
    turns = ["Rivver stohne unknownword?", "paper, pepers!"]
    bench = ["silver tones"]
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    put("documents", list(enumerate(texts)), "doc_id bigint, text string")
    put("conversations", [(0, i, t) for i, t in enumerate(turns)], "conv_id bigint, turn bigint, text string")
    put("benchmark", list(enumerate(bench)), "item_id bigint, text string")
    put("events", [(i, i % 3) for i in range(60)], "event_id bigint, user_id bigint")
    vocab = {w for t in texts for w in t.split()}
    ranked = sorted(vocab, key=lambda w: (-sum(t.split().count(w) for t in texts), w))
    asked = [ranked[i // 4 * 31 % len(ranked)] for i in range(60)]
    words = {w if i % 2 else w[0] + w[2:] for i, w in enumerate(asked)} | {
        w for t in turns + bench for w in re.findall(r"\w+", t.lower())}
    got = {(r["word"], r["match"], r["distance"]) for r in REGISTRY["fuzzy_match_log"](spark, str(tmp_path)).collect()}
    want = {(w, v, distance(w, v)) for w in words for v in vocab if distance(w, v) <= 2}
    assert got == want and {"rivver", "stohne", "pepers"} <= {w for w, _, _ in got}
