"""The query log whose sessions are whole user histories."""

from collections import defaultdict

from inkwell.operators import spelling as SP
from inkwell.sources import workloads as WL


def test_one_session_with_a_third_of_the_log(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}xyz{i}" for i in range(100)]
    stats = spark.createDataFrame([(w, 200 - i) for i, w in enumerate(words)], "term string, cf bigint")
    users = [1 if i % 3 == 0 else 2 + i % 29 for i in range(1500)]
    events = spark.createDataFrame(list(enumerate(users)), "event_id bigint, user_id bigint")
    log = WL.user_query_log(events, stats).checkpoint()
    rows = sorted((r["session_id"], r["ts"], r["query"]) for r in log.collect())
    assert len(rows) == 1500 and [(u, t) for u, t, _ in rows] == sorted((u, t) for t, u in enumerate(users))
    assert sum(u == 1 for u, _, _ in rows) == 500
    learnt, last, want, age = defaultdict(dict), {}, [], []
    cf = dict(zip(words, range(200, 100, -1)))
    for user, ts, q in rows:
        p = last.get(user)
        # A misspelling is no term here, and one edit from the word after it.
        if p is not None and q in cf and p not in cf and p == q[0] + q[2:]:
            learnt[user][p] = (q, ts)
        if q in learnt[user]:
            want.append((user, ts, q, learnt[user][q][0]))
            age.append(ts - learnt[user][q][1])
        last[user] = q
    got = sorted(tuple(r) for r in SP.suggest(log, stats).select("session_id", "ts", "query", "suggestion").collect())
    exact = [g for g in got if g[2] == g[3][0] + g[3][2:]]
    assert exact == want and max(age) > 100
