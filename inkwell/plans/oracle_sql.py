"""Independent DuckDB SQL for the registered queries.

Each statement starts from the raw Parquet views (documents, events, ...)
and recomputes the result with DuckDB's own functions: the tokenizer, query
parsing, phrase matching, statistics and so on are written again in SQL, not
generated from the Spark plans.
"""

from __future__ import annotations

from inkwell.sources.workloads import (DELTA_RULES, LANG_METHODS, LOG_CONVERSATIONS, LOG_MULT, LOG_REPEAT,
                                       LOG_SESSION, LOG_USER_WORDS,
                                       LOOKUP_PHRASES, SIMILAR_WORDS, TOMBSTONE_MOD, TOMBSTONE_REM, WORKLOAD)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values_cte(name: str, cols: str, rows, types: list[str]) -> str:
    body = ", ".join(
        "(" + ", ".join(
            (_sql_str(v) if isinstance(v, str) else ("NULL" if v is None else str(v))) + f"::{t}"
            for v, t in zip(r, types)) + ")" for r in rows)
    return f"{name}({cols}) AS (VALUES {body})"


WORKLOAD_CTE = values_cte("queries", "query_id, query", WORKLOAD, ["BIGINT", "VARCHAR"])

TERM_RE = r"'^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$'"


def tokenize_cte(src: str = "documents", name: str = "postings") -> str:
    """Postings (doc_id, pos, wpos, term) of the ``text`` column of ``src``."""
    return f"""
{name}_words AS (
  SELECT doc_id, CASE WHEN s = '' THEN []::VARCHAR[] ELSE string_split_regex(s, '\\s+') END AS ws
  FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '\\s\\.', '.', 'g'), '\\s+$', '') AS s
        FROM {src})
),
{name}_raw AS (
  SELECT doc_id, CAST(g.i - 1 AS INTEGER) AS wpos,
         regexp_replace(lower(ws[g.i]), {TERM_RE}, '', 'g') AS term
  FROM {name}_words, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i) g
),
{name} AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY wpos) - 1 AS INTEGER) AS pos,
         wpos, term
  FROM {name}_raw WHERE term <> ''
)"""


def query_terms_cte(src: str = "queries", name: str = "qt") -> str:
    return f"""
{name}_raw AS (
  SELECT query_id, list_concat(
      list_transform(regexp_extract_all(coalesce(query, ''), '!"(.+?)"', 1), lambda x: '!' || x),
      list_concat(
        regexp_extract_all(regexp_replace(coalesce(query, ''), '!"(.+?)"', '', 'g'), '"(.+?)"', 1),
        string_split_regex(regexp_replace(regexp_replace(coalesce(query, ''), '!"(.+?)"', '', 'g'),
                                          '"(.+?)"', '', 'g'), '\\s+'))) AS terms
  FROM {src}
),
{name}_terms AS (
  SELECT query_id, CAST(term_no AS INTEGER) AS term_no, contains(raw, '!') AS negated,
         list_filter(list_transform(string_split_regex(replace(raw, '!', ''), '\\s+'),
                                    lambda w: regexp_replace(lower(w), {TERM_RE}, '', 'g')),
                     lambda w: w <> '') AS words
  FROM (SELECT query_id, unnest(range(0, len(terms))) AS term_no, unnest(terms) AS raw
        FROM {name}_raw)
),
{name} AS (
  SELECT query_id, term_no, negated, CAST(len(words) AS INTEGER) AS n_words,
         CAST(o.i - 1 AS INTEGER) AS "offset", words[o.i] AS word
  FROM {name}_terms, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS i) o
  WHERE len(words) > 0
)"""


def search_ctes(postings: str = "postings", qt: str = "qt", docs: str = "documents",
                queries: str = "queries", name: str = "results") -> str:
    """Results of a workload: positive matches minus negated documents, plus
    every non-negated document for queries without positive terms."""
    return f"""
{name}_hits AS (
  SELECT q.query_id, q.term_no, q.negated, q.n_words, p.doc_id, p.pos - q."offset" AS start, p.wpos
  FROM {postings} p JOIN {qt} q ON p.term = q.word
),
{name}_occ AS (
  SELECT query_id, term_no, any_value(negated) AS negated, any_value(n_words) AS n_words,
         doc_id, start, min(wpos) AS start_wpos
  FROM {name}_hits GROUP BY query_id, term_no, doc_id, start
  HAVING count(*) = any_value(n_words)
),
{name}_per_term AS (
  SELECT query_id, doc_id, term_no, negated, sum(n_words) AS pts, min(start_wpos) AS first_wpos
  FROM {name}_occ GROUP BY query_id, doc_id, term_no, negated
),
{name}_neg AS (
  SELECT DISTINCT query_id, doc_id FROM {name}_per_term WHERE negated
),
{name}_pos AS (
  SELECT query_id, doc_id, CAST(sum(pts) AS BIGINT) AS score,
         CAST(arg_min(first_wpos, term_no) + 1 AS INTEGER) AS location
  FROM {name}_per_term WHERE NOT negated GROUP BY query_id, doc_id
),
{name}_negonly AS (
  SELECT query_id FROM {queries}
  WHERE query_id NOT IN (SELECT query_id FROM {qt} WHERE NOT negated)
),
{name} AS (
  SELECT p.* FROM {name}_pos p
  WHERE NOT EXISTS (SELECT 1 FROM {name}_neg n WHERE n.query_id = p.query_id AND n.doc_id = p.doc_id)
  UNION ALL
  SELECT o.query_id, d.doc_id, CAST(1 AS BIGINT) AS score, CAST(0 AS INTEGER) AS location
  FROM {name}_negonly o CROSS JOIN (SELECT DISTINCT doc_id FROM {docs}) d
  WHERE NOT EXISTS (SELECT 1 FROM {name}_neg n WHERE n.query_id = o.query_id AND n.doc_id = d.doc_id)
)"""


def snippet_sql(text: str, location: str, line_break: bool = True) -> str:
    """21-word snippet in DuckDB (1-based list slicing)."""
    words = (f"(CASE WHEN regexp_replace(regexp_replace({text}, '\\s\\.', '.', 'g'), '\\s+$', '') = '' "
             f"THEN []::VARCHAR[] ELSE string_split_regex(regexp_replace(regexp_replace({text}, "
             f"'\\s\\.', '.', 'g'), '\\s+$', ''), '\\s+') END)")
    start = f"(CASE WHEN {location} > 11 THEN {location} - 11 ELSE 0 END)"
    head = f"list_slice({words}, {start} + 1, {start} + 11)"
    tail = f"list_slice({words}, {start} + 12, {start} + 21)"
    brk = "chr(10) || chr(9) || chr(9)" if line_break else "''"
    return (f"(array_to_string(list_transform({head}, lambda w: w || ' '), '') || {brk} || "
            f"array_to_string(list_transform({tail}, lambda w: w || ' '), ''))")


BASE = "WITH " + tokenize_cte() + ",\n" + WORKLOAD_CTE + ",\n" + query_terms_cte()
SEARCH = BASE + "," + search_ctes()


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


ORACLES: dict[str, str] = {}

# --- step 1: index tables -------------------------------------------------
ORACLES["postings"] = _with(tokenize_cte()) + "\nSELECT doc_id, pos, wpos, term FROM postings"
ORACLES["term_counts"] = _with(tokenize_cte()) + """
SELECT doc_id, term, count(*) AS tf FROM postings GROUP BY doc_id, term"""
ORACLES["packed_postings"] = _with(tokenize_cte()) + """
SELECT term, doc_id, count(*) AS tf, list_sort(list(pos)) AS positions FROM postings GROUP BY term, doc_id"""
ORACLES["term_stats"] = _with(tokenize_cte()) + """
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf,
       round(ln((SELECT count(DISTINCT doc_id) FROM documents) / count(DISTINCT doc_id)), 6) AS idf
FROM postings GROUP BY term"""
ORACLES["all_docs"] = "SELECT DISTINCT doc_id FROM documents"
ORACLES["doc_length"] = """
SELECT doc_id, CAST(CASE WHEN s = '' THEN 0 ELSE len(string_split_regex(s, '\\s+')) END AS INTEGER) AS doc_length
FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '[.,]', '', 'g'), '\\s+$', '') AS s FROM documents)"""
ORACLES["index_size_main"] = _with(tokenize_cte()) + """
SELECT count(*) AS n_postings, count(DISTINCT term) AS n_terms, count(DISTINCT doc_id) AS n_docs,
       CAST(sum(octet_length(encode(term)) + 16) AS BIGINT) AS logical_bytes FROM postings"""

# --- step 2/3: search -------------------------------------------------------
EXT_WORKLOAD_CTE = WORKLOAD_CTE.replace("queries(", "fixed_queries(", 1) + """,
queries AS (
  SELECT query_id, query FROM fixed_queries
  UNION ALL SELECT 1000000 + item_id, '"' || text || '"' FROM benchmark
  UNION ALL SELECT 2000000 + conv_id * 1000 + turn, text FROM conversations
)"""
ORACLES["query_terms"] = _with(EXT_WORKLOAD_CTE, query_terms_cte()) + """
SELECT query_id, term_no, negated, n_words, "offset", word FROM qt"""
ORACLES["term_hits"] = BASE + """
SELECT q.query_id, q.term_no, q.negated, q.n_words, p.doc_id, p.pos - q."offset" AS start, p.wpos
FROM postings p JOIN qt q ON p.term = q.word"""
ORACLES["phrase_hits"] = SEARCH + """
SELECT query_id, term_no, negated, n_words, doc_id, start, start_wpos FROM results_occ"""
ORACLES["disjunction"] = SEARCH + """
SELECT DISTINCT query_id, doc_id FROM results_per_term WHERE NOT negated"""
ORACLES["search_score"] = SEARCH + """
SELECT query_id, doc_id, score FROM results_pos"""
ORACLES["search_location"] = SEARCH + """
SELECT query_id, doc_id, location FROM results_pos"""
ORACLES["search"] = SEARCH + "\nSELECT query_id, doc_id, score, location FROM results"
ORACLES["search_rank"] = SEARCH + """
SELECT query_id, doc_id, score, location,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
FROM results"""
ORACLES["search_page"] = SEARCH + """
SELECT * FROM (
  SELECT query_id, doc_id, score, location,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM results) WHERE rank > 10 AND rank <= 20"""
ORACLES["snippets"] = SEARCH + f"""
SELECT r.query_id, r.doc_id, r.score, r.location,
       CASE WHEN d.text IS NULL THEN '' ELSE {snippet_sql('d.text', 'r.location')} END AS snippet
FROM results r LEFT JOIN documents d ON r.doc_id = d.doc_id"""
ORACLES["search_page_bounded"] = ORACLES["search_page"]
ORACLES["search_report"] = SEARCH + f"""
SELECT query_id, rank, doc_id, score, location,
       CASE WHEN text IS NULL THEN '' ELSE {snippet_sql('text', 'location')} END AS snippet
FROM (SELECT r.*, d.text,
             CAST(row_number() OVER (PARTITION BY r.query_id ORDER BY r.score DESC, r.doc_id) AS INTEGER) AS rank
      FROM results r LEFT JOIN documents d ON r.doc_id = d.doc_id) WHERE rank <= 10"""
ORACLES["docs_with_any"] = SEARCH + "\nSELECT query_id, doc_id FROM results_neg"
ORACLES["negation_search"] = SEARCH + """
SELECT query_id, doc_id, score, location FROM results
WHERE query_id IN (SELECT query_id FROM qt WHERE negated)"""
ORACLES["negation_only"] = SEARCH + """
SELECT query_id, doc_id, score, location FROM results
WHERE query_id IN (SELECT query_id FROM results_negonly)"""
ORACLES["empty_query"] = SEARCH.replace(
    WORKLOAD_CTE, values_cte("queries", "query_id, query", [(0, ""), (1, "   ")],
                             ["BIGINT", "VARCHAR"])) + """
SELECT query_id, doc_id, score, location FROM results"""


# --- step 4: statistics and lookups -----------------------------------------
PHRASE_WORDS = f"""
pw_terms AS (
  SELECT phrase_id, phrase,
         list_filter(list_transform(string_split_regex(coalesce(phrase, ''), '\\s+'),
                                    lambda w: regexp_replace(lower(w), {TERM_RE}, '', 'g')),
                     lambda w: w <> '') AS words
  FROM phrases
),
pw AS (
  SELECT phrase_id, CAST(len(words) AS INTEGER) AS n_words, CAST(o.i - 1 AS INTEGER) AS "offset",
         words[o.i] AS word
  FROM pw_terms, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS i) o WHERE len(words) > 0
),
pw_occ AS (
  SELECT q.phrase_id, p.doc_id, p.pos - q."offset" AS start
  FROM postings p JOIN pw q ON p.term = q.word
  GROUP BY q.phrase_id, p.doc_id, p.pos - q."offset"
  HAVING count(*) = any_value(q.n_words)
)"""
BENCH_PHRASES = "phrases AS (SELECT item_id AS phrase_id, text AS phrase FROM benchmark)"
ORACLES["document_freq"] = _with(tokenize_cte(), BENCH_PHRASES, PHRASE_WORDS) + """
SELECT ph.phrase_id, ph.phrase, CAST(coalesce(c.df, 0) AS BIGINT) AS df
FROM phrases ph LEFT JOIN (SELECT phrase_id, count(DISTINCT doc_id) AS df FROM pw_occ GROUP BY phrase_id) c
  ON ph.phrase_id = c.phrase_id"""
ORACLES["index_freq"] = _with(tokenize_cte(), BENCH_PHRASES, PHRASE_WORDS) + """
SELECT ph.phrase_id, ph.phrase, CAST(coalesce(c.cf, 0) AS BIGINT) AS cf
FROM phrases ph LEFT JOIN (SELECT phrase_id, count(*) AS cf FROM pw_occ GROUP BY phrase_id) c
  ON ph.phrase_id = c.phrase_id"""
_LOOKUP = ", ".join(f"({k}, {_sql_str(p)})" for k, p in enumerate(LOOKUP_PHRASES))
PAIRS = f"""lookup(k, phrase) AS (VALUES {_LOOKUP}),
pairs AS (SELECT l.doc_id * 10 + k.k AS pair_id, l.doc_id, k.phrase FROM labels l CROSS JOIN lookup k),
phrases AS (SELECT DISTINCT phrase AS phrase_id, phrase FROM pairs)"""
ORACLES["document_term_freq"] = _with(tokenize_cte(), PAIRS, PHRASE_WORDS) + """
SELECT pr.pair_id, pr.doc_id, pr.phrase, CAST(coalesce(c.tf, 0) AS BIGINT) AS tf
FROM pairs pr LEFT JOIN (SELECT phrase_id, doc_id, count(*) AS tf FROM pw_occ GROUP BY phrase_id, doc_id) c
  ON pr.phrase = c.phrase_id AND pr.doc_id = c.doc_id"""
ORACLES["document_text"] = """
SELECT l.doc_id, coalesce(d.text, '') AS text FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id"""
ORACLES["document_title"] = """
SELECT l.doc_id, coalesce(CASE WHEN len(string_split(d.text, chr(10))) > 4
                               THEN array_to_string(list_slice(string_split(d.text, chr(10)), 1, 4), chr(10))
                               ELSE regexp_replace(d.text, '\n$', '') END, '') AS title
FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id"""


# --- step 7: similar words ---------------------------------------------------
SIM_WORDS = "sim_words(word) AS (VALUES " + ", ".join(f"({_sql_str(w)})" for w in SIMILAR_WORDS) + ")"
NEIGH = """
neigh AS (
  SELECT doc_id, pos, wpos, term,
         lag(term, 2) OVER w AS prev2, lag(term, 1) OVER w AS prev1,
         lead(term, 1) OVER w AS next1, lead(term, 2) OVER w AS next2
  FROM postings WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
firsts AS (
  SELECT n.* FROM neigh n
  JOIN (SELECT doc_id, term, min(pos) AS pos FROM postings GROUP BY doc_id, term) f
    ON n.doc_id = f.doc_id AND n.pos = f.pos
),
ctx AS (
  SELECT DISTINCT f.term AS word, f.prev1 AS pre, f.next1 AS post
  FROM firsts f JOIN sim_words s ON f.term = s.word
  WHERE f.prev1 IS NOT NULL AND f.next1 IS NOT NULL
),
cf AS (SELECT term, count(*) AS cf FROM postings GROUP BY term),
anchors AS (
  SELECT word, pre, post,
         CASE WHEN coalesce(a.cf, 0) > 0 AND length(pre) > length(post) THEN pre ELSE post END AS anchor,
         CASE WHEN coalesce(a.cf, 0) > 0 AND length(pre) > length(post) THEN 'pre' ELSE 'post' END AS side
  FROM ctx LEFT JOIN cf a ON a.term = ctx.pre LEFT JOIN cf b ON b.term = ctx.post
  WHERE coalesce(a.cf, 0) > 0 OR coalesce(b.cf, 0) > 0
),
cands AS (
  SELECT a.word, a.pre, a.post, a.side, f.doc_id, f.next1 AS candidate
  FROM anchors a JOIN firsts f ON a.side = 'pre' AND f.term = a.anchor AND f.next2 = a.post
  UNION ALL
  SELECT a.word, a.pre, a.post, a.side, f.doc_id, f.prev1 AS candidate
  FROM anchors a JOIN firsts f ON a.side = 'post' AND f.term = a.anchor AND f.prev2 = a.pre
),
similar_first AS (
  SELECT word, candidate, count(*) AS n FROM cands WHERE candidate <> word GROUP BY word, candidate
)"""
SIM = _with(tokenize_cte(), SIM_WORDS, NEIGH)
ORACLES["neighbours"] = SIM + "\nSELECT doc_id, pos, wpos, term, prev2, prev1, next1, next2 FROM neigh"
ORACLES["first_occurrence"] = _with(tokenize_cte()) + """
SELECT doc_id, term, min(pos) AS pos, min(wpos) AS wpos FROM postings GROUP BY doc_id, term"""
ORACLES["word_contexts"] = SIM + "\nSELECT word, pre, post FROM ctx"
# Only what the anchors need, each part once.
ORACLES["context_anchors"] = _with(tokenize_cte(), SIM_WORDS, NEIGH[:NEIGH.index("),\ncands AS")] + ")").replace(
    "postings AS (", "postings AS MATERIALIZED (").replace("neigh AS (", "neigh AS MATERIALIZED (").replace(
    "firsts AS (", "firsts AS MATERIALIZED (") + "\nSELECT word, pre, post, anchor, side FROM anchors"
ORACLES["similar_candidates"] = SIM + """
SELECT word, pre, post, side, doc_id, candidate FROM cands WHERE candidate <> word"""
ORACLES["similar_first"] = SIM + "\nSELECT word, candidate, n FROM similar_first"
ORACLES["similar_all"] = SIM + """,
ctx_all AS (
  SELECT DISTINCT n.term AS word, n.prev1 AS pre, n.next1 AS post
  FROM neigh n JOIN sim_words s ON n.term = s.word
  WHERE n.prev1 IS NOT NULL AND n.next1 IS NOT NULL
)
SELECT c.word, n.term AS candidate, count(*) AS n
FROM neigh n JOIN ctx_all c ON n.prev1 = c.pre AND n.next1 = c.post
WHERE n.term <> c.word GROUP BY c.word, n.term"""
ORACLES["similar_frames"] = ORACLES["similar_all"]
ORACLES["similar_report"] = SIM + """
SELECT word, candidate, n, rank FROM (
  SELECT word, candidate, n,
         CAST(row_number() OVER (PARTITION BY word ORDER BY n DESC, candidate) AS INTEGER) AS rank
  FROM similar_first WHERE regexp_matches(candidate, '[^0-9]')) WHERE rank <= 10"""


# --- step 6: live indexing ---------------------------------------------------
def _delta_rules_sql() -> str:
    parts = []
    for seq, mod, rem, shift, new_off in DELTA_RULES:
        parts.append(
            f"SELECT s.doc_id + {new_off} AS doc_id, t.text, {seq} AS index_seq FROM documents s "
            f"JOIN documents t ON t.doc_id = s.doc_id + {shift} WHERE s.doc_id % {mod} = {rem}")
    return " UNION ALL ".join(parts)


DELTA = f"""
delta_raw AS ({_delta_rules_sql()}),
delta_docs AS (SELECT doc_id, text, index_seq, 'docs/' || CAST(doc_id AS VARCHAR) || '.xml' AS path FROM delta_raw),
latest AS (
  SELECT doc_id, arg_max(text, index_seq) AS text, max(index_seq) AS index_seq,
         arg_max(path, index_seq) AS path
  FROM delta_docs GROUP BY doc_id
),
live_docs AS (
  SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM latest)
  UNION ALL SELECT doc_id, text FROM latest
)"""
ORACLES["latest_delta"] = _with(DELTA) + "\nSELECT doc_id, text, index_seq, path FROM latest"
ORACLES["duplicate_delta_docs"] = _with(DELTA) + """
SELECT doc_id, count(DISTINCT index_seq) AS n_deltas FROM delta_docs GROUP BY doc_id HAVING count(DISTINCT index_seq) > 1"""
ORACLES["index_size_delta"] = _with(DELTA, tokenize_cte("latest", "dpost")) + """
SELECT l.index_seq, count(*) AS n_postings, count(DISTINCT p.term) AS n_terms, count(DISTINCT p.doc_id) AS n_docs,
       CAST(sum(octet_length(encode(p.term)) + 16) AS BIGINT) AS logical_bytes
FROM dpost p JOIN latest l ON p.doc_id = l.doc_id GROUP BY ROLLUP (l.index_seq)"""
ORACLES["remove_docs"] = _with(tokenize_cte()) + f"""
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM postings
WHERE doc_id % {TOMBSTONE_MOD} <> {TOMBSTONE_REM} GROUP BY term"""
ORACLES["needs_merge"] = _with(DELTA) + """
SELECT count(DISTINCT path) AS n_files, 10 AS threshold, count(DISTINCT path) > 10 AS needs_merge FROM delta_docs"""
LIVE_SEARCH = _with(DELTA, tokenize_cte("live_docs", "postings"), WORKLOAD_CTE, query_terms_cte(),
                    search_ctes(docs="live_docs")) + "\nSELECT query_id, doc_id, score, location FROM results"
ORACLES["live_search"] = LIVE_SEARCH
LIVE_TOKENS = (DELTA, tokenize_cte("live_docs", "postings"))
_LIVE_STATS = """
SELECT term, df, cf, round(ln((SELECT count(DISTINCT doc_id) FROM {docs}) / df), 6) AS idf
FROM (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM postings {where} GROUP BY term)"""
_KEPT = f"doc_id % {TOMBSTONE_MOD} <> {TOMBSTONE_REM}"
ORACLES["live_term_stats"] = _with(*LIVE_TOKENS) + _LIVE_STATS.format(docs="live_docs", where="")
ORACLES["segment_term_stats"] = _with(*LIVE_TOKENS, f"kept AS (SELECT * FROM live_docs WHERE {_KEPT})") + \
    _LIVE_STATS.format(docs="kept", where=f"WHERE {_KEPT}")
for _name in ("document_freq", "index_freq", "document_term_freq"):
    ORACLES[f"live_{_name}"] = ORACLES[_name].replace(
        "WITH " + tokenize_cte().strip(), _with(*LIVE_TOKENS), 1)
ORACLES["segment_search"] = LIVE_SEARCH + f" WHERE {_KEPT}"
LIVE_KEPT = (DELTA, f"kept AS (SELECT * FROM live_docs WHERE {_KEPT})", tokenize_cte("kept", "postings"))
# Two segments of one size class (powers of 4 in documents) are merged.
ORACLES["segment_history"] = _with(DELTA, f"""
one AS (SELECT doc_id FROM delta_docs WHERE index_seq = 1), two AS (SELECT doc_id FROM delta_docs WHERE index_seq = 2),
n AS (
  SELECT (SELECT count(*) FROM documents) AS n0, (SELECT count(*) FROM one) AS n1, (SELECT count(*) FROM two) AS n2,
         (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM one)) AS a0,
         (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM latest)) AS b0,
         (SELECT count(*) FROM one WHERE doc_id NOT IN (SELECT doc_id FROM two)) AS b1,
         (SELECT count(*) FROM documents WHERE {_KEPT} AND doc_id NOT IN (SELECT doc_id FROM latest)) AS c0,
         (SELECT count(*) FROM one WHERE {_KEPT} AND doc_id NOT IN (SELECT doc_id FROM two)) AS c1,
         (SELECT count(*) FROM two WHERE {_KEPT}) AS c2)""") + """
SELECT 1 AS version, 'build' AS step, 1::BIGINT AS n_segments, n0 AS written_docs, n0 AS live_docs FROM n
UNION ALL SELECT 2, 'append', 2, n1, a0 + n1 FROM n
UNION ALL SELECT 3, 'append', 3, n2, b0 + b1 + n2 FROM n
UNION ALL SELECT 4, 'delete', 3, 0, c0 + c1 + c2 FROM n
UNION ALL SELECT 5, 'merge', 2, c1 + c2, c0 + c1 + c2 FROM n
WHERE floor(ln(n1) / ln(4) + 1e-9) = floor(ln(n2) / ln(4) + 1e-9)"""
ORACLES["merged_search"] = LIVE_SEARCH


# --- step 8/9: spelling and distance -----------------------------------------
def _norm(x: str) -> str:
    return f"regexp_replace(lower({x}), {TERM_RE}, '', 'g')"


# levenshtein() counts bytes: each letter beyond ASCII becomes a control
# character, which no word holds.
_LETTERS = "äçèéêíñóößüÄÇÈÉÊÍÑÓÖÜ"
_STAND_INS = "".join(chr(i) for i in (*range(1, 9), *range(14, 32)))[:len(_LETTERS)]
_BYTES = " || ".join(f"chr({ord(c)})" for c in _STAND_INS)


def _lev(a: str, b: str) -> str:
    one = [f"translate({x}, '{_LETTERS}', {_BYTES})" for x in (a, b)]
    return f"levenshtein({one[0]}, {one[1]})"


SINGLE = "(query NOT LIKE '% %' AND NOT starts_with(query, '!'))"
QLOG = f"""
cf AS (SELECT term, count(*) AS cf FROM postings GROUP BY term),
vocab AS (SELECT term AS word, row_number() OVER (ORDER BY cf DESC, term) - 1 AS rank FROM cf),
qlog AS (
  SELECT e.event_id // {LOG_SESSION} AS session_id, e.event_id AS ts,
         CASE WHEN e.event_id % 2 = 0 THEN substr(v.word, 1, 1) || substr(v.word, 3) ELSE v.word END AS query
  FROM events e JOIN vocab v ON v.rank = ((e.event_id // {LOG_REPEAT}) * {LOG_MULT}) % (SELECT count(*) FROM cf)
  UNION ALL
  SELECT conv_id + {LOG_CONVERSATIONS}, turn, text FROM conversations
),
prevq AS (
  SELECT session_id, ts, query,
         last_value(CASE WHEN {SINGLE} THEN query END IGNORE NULLS) OVER (
           PARTITION BY session_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM qlog
),
pairs AS (SELECT * FROM prevq WHERE prev IS NOT NULL AND {SINGLE}),
dom AS (
  SELECT p.session_id, p.ts, p.query, p.prev, coalesce(a.cf, 0) AS prev_cf, coalesce(b.cf, 0) AS cur_cf,
         (p.prev <> '' AND coalesce(b.cf, 0) > 0 AND coalesce(a.cf, 0) <= 0.5 * coalesce(b.cf, 0)) AS dominates
  FROM pairs p LEFT JOIN cf a ON a.term = {_norm('p.prev')} LEFT JOIN cf b ON b.term = {_norm('p.query')}
),
corr AS (
  SELECT session_id, ts, prev AS word, query AS correction, CAST({_lev('prev', 'query')} AS INTEGER) AS distance
  FROM dom WHERE dominates AND {_lev('prev', 'query')} <= 3
)"""
SPELL = _with(tokenize_cte(), QLOG)
ORACLES["previous_query"] = SPELL + "\nSELECT session_id, ts, query, prev FROM prevq"
ORACLES["dominates"] = SPELL + "\nSELECT session_id, ts, query, prev, prev_cf, cur_cf, dominates FROM dom"
ORACLES["mine_corrections"] = SPELL + "\nSELECT session_id, ts, word, correction, distance FROM corr"
ORACLES["latest_corrections"] = SPELL + """
SELECT session_id, word, arg_max(correction, ts) AS correction, max(ts) AS ts FROM corr GROUP BY session_id, word"""
ORACLES["suggest"] = SPELL + """
SELECT * FROM (
  SELECT q.session_id, q.ts, q.query,
         (SELECT arg_max(c.correction, c.ts) FROM corr c
          WHERE c.session_id = q.session_id AND c.word = q.query AND c.ts <= q.ts) AS suggestion
  FROM qlog q) WHERE suggestion IS NOT NULL"""
ORACLES["edit_distance"] = SPELL + f"""
SELECT session_id, ts, prev, query, CAST({_lev('prev', 'query')} AS INTEGER) AS distance FROM pairs"""


def _weighted(indel: int, weight: str) -> str:
    """The table of a weighted distance cell by cell, all pairs in step.
    ``win`` holds the last m + 2 cells: diagonal, above, ..., left.  ``weight``
    is the cost of two characters in SQL, {x} and {y}."""
    a, b = "substr(a, i, 1)", "substr(b, j, 1)"
    cost = [weight.format(x=x, y=y) for x, y in ((a, "'-'"), ("'-'", b), (a, b))]
    return f""",
asked AS MATERIALIZED (SELECT DISTINCT prev AS a, query AS b, length(prev) AS n, length(query) AS m FROM pairs),
cells AS (
  SELECT a, b, n, m, 0 AS k, 1 AS i, 0 AS j, [0] || list_transform(range(0, m + 1), lambda c: c * {indel}) AS win
  FROM asked WHERE n > 0 AND m > 0
  UNION ALL
  SELECT a, b, n, m, k + 1, (k + 1) // (m + 1) + 1, (k + 1) % (m + 1),
         list_slice(win, 2, m + 2) || [CASE WHEN j = 0 THEN i * {indel} ELSE
           least(win[2] + {cost[0]}, win[m + 2] + {cost[1]}, win[1] + {cost[2]}) END]
  FROM cells WHERE k < n * (m + 1)
),
scored AS (
  SELECT a, b, win[m + 2] AS distance FROM cells WHERE k = n * (m + 1)
  UNION ALL SELECT a, b, greatest(n, m) * {indel} FROM asked WHERE n = 0 OR m = 0
)
SELECT p.session_id, p.ts, p.prev, p.query, CAST(s.distance AS BIGINT) AS distance
FROM pairs p JOIN scored s ON s.a = p.prev AND s.b = p.query"""


_RECURSIVE = SPELL.replace("WITH ", "WITH RECURSIVE ", 1)
ORACLES["edit_distance_weighted"] = _RECURSIVE + _weighted(
    1, "(CASE WHEN {x} = {y} THEN 0 WHEN {x} = '-' OR {y} = '-' THEN 1 ELSE 2 END)")
ORACLES["edit_distance_custom"] = _RECURSIVE + _weighted(
    2, "(CASE WHEN {x} = {y} THEN 0 WHEN {x} = '-' OR {y} = '-' THEN 2 "
       "WHEN {x} IN ('a', 'e', 'i', 'o', 'u') AND {y} IN ('a', 'e', 'i', 'o', 'u') THEN 1 ELSE 3 END)")
ORACLES["fuzzy_match"] = _with(
    tokenize_cte(), "bench AS (SELECT item_id AS doc_id, text FROM benchmark)",
    tokenize_cte("bench", "bench_postings")) + f"""
SELECT w.word, v.term AS match, CAST({_lev('w.word', 'v.term')} AS INTEGER) AS distance
FROM (SELECT DISTINCT term AS word FROM bench_postings) w
JOIN (SELECT DISTINCT term FROM postings) v
  ON abs(length(w.word) - length(v.term)) <= 2 AND {_lev('w.word', 'v.term')} <= 2"""


# Pairs within two unit-cost edits, hyphens aside, are a superset; the table decides.
_BARE = "replace({}, '-', '')"
ORACLES["fuzzy_match_weighted"] = _with(
    tokenize_cte(), "bench AS (SELECT item_id AS doc_id, text FROM benchmark)",
    tokenize_cte("bench", "bench_postings"), f"""pairs AS (
  SELECT 0 AS session_id, 0 AS ts, w.word AS prev, v.term AS query
  FROM (SELECT DISTINCT term AS word FROM bench_postings) w JOIN (SELECT DISTINCT term FROM postings) v
    ON {_lev(_BARE.format('w.word'), _BARE.format('v.term'))} <= 2)""").replace("WITH ", "WITH RECURSIVE ", 1) + _weighted(
    1, "(CASE WHEN {x} = {y} THEN 0 WHEN {x} = '-' OR {y} = '-' THEN 1 ELSE 2 END)").replace(
    "SELECT p.session_id, p.ts, p.prev, p.query,", "SELECT p.prev AS word, p.query AS match,") + \
    "\nWHERE s.distance <= 2"


# --- step 5: corpus ----------------------------------------------------------
XML = """
xml AS (
  SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS DOCNO, 'T ' || CAST(doc_id AS VARCHAR) AS TITLE,
         coalesce(source, '') AS AUTHOR, '' AS BIBLIO, text AS TEXT, doc_id FROM documents
),
built AS (
  SELECT doc_id, TITLE AS title, AUTHOR AS author,
         TITLE || chr(10) || TEXT || chr(10) || AUTHOR AS text FROM xml
)"""
DOC_LEN = """CAST(CASE WHEN regexp_replace(regexp_replace({t}, '[.,]', '', 'g'), '\\s+$', '') = '' THEN 0
  ELSE len(string_split_regex(regexp_replace(regexp_replace({t}, '[.,]', '', 'g'), '\\s+$', ''), '\\s+')) END AS INTEGER)"""
ORACLES["xml_docs"] = _with(XML) + "\nSELECT DOCNO, TITLE, AUTHOR, BIBLIO, TEXT FROM xml"
ORACLES["docno_normalize"] = _with(XML) + "\nSELECT DOCNO, doc_id FROM xml"
ORACLES["compose_body"] = _with(XML) + "\nSELECT doc_id, text AS body FROM built"
ORACLES["build_docs"] = _with(XML) + f"""
SELECT doc_id, title, author, text, {DOC_LEN.format(t='text')} AS doc_length FROM built"""
ORACLES["write_docs"] = ORACLES["build_docs"]
ORACLES["build_index"] = ORACLES["postings"]
ORACLES["parse_changes"] = _with(DELTA) + f"""
SELECT doc_id, 'T ' || CAST(doc_id AS VARCHAR) AS title, '' AS author,
       'T ' || CAST(doc_id AS VARCHAR) || chr(10) || text || chr(10) AS text,
       {DOC_LEN.format(t="('T ' || CAST(doc_id AS VARCHAR) || chr(10) || text || chr(10))")} AS doc_length
FROM latest"""

# --- step 10: change detection ------------------------------------------------
def _sig(method: str, content: str) -> str:
    nopad = "rtrim(to_base64(unhex({h})), '=')"
    if method == "MD5":
        return nopad.format(h=f"md5({content})")
    if method == "SHA-1":
        return nopad.format(h=f"sha1({content})")
    if method == "SHA-256":
        return nopad.format(h=f"sha256({content})")
    if method == "checksum":
        h = f"hex(encode({content}))"
        return (f"CASE WHEN {content} IS NULL OR octet_length(encode({content})) = 0 THEN NULL ELSE "
                f"CAST(list_sum(list_transform(range(0, length({h}) // 2), "
                f"lambda i: ('0x' || substr({h}, 2 * i + 1, 2))::BIGINT)) % 4294967295 AS VARCHAR) END")
    raise ValueError(method)


FILES = "files AS (SELECT 'docs/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text AS content, lang FROM documents)"
for _name, _m in [("signatures_md5", "MD5"), ("signatures_sha256", "SHA-256"),
                  ("signatures_checksum", "checksum")]:
    ORACLES[_name] = _with(FILES) + f"\nSELECT path, '{_m}' AS method, {_sig(_m, 'content')} AS signature FROM files"
_LANG_CASE = "CASE " + " ".join(f"WHEN lang = {_sql_str(l)} THEN {_sql_str(m)}" for l, m in LANG_METHODS) + " END"
ORACLES["watch_set"] = _with(FILES) + f"""
SELECT path, method, CASE method WHEN 'MD5' THEN {_sig('MD5', 'content')}
                               WHEN 'SHA-1' THEN {_sig('SHA-1', 'content')}
                               WHEN 'SHA-256' THEN {_sig('SHA-256', 'content')}
                               WHEN 'checksum' THEN {_sig('checksum', 'content')} END AS signature
FROM (SELECT path, content, coalesce({_LANG_CASE}, 'MD5') AS method FROM files)"""
SNAP = DELTA + f""",
old_sig AS (SELECT 'docs/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, {_sig('MD5', 'text')} AS signature FROM documents),
new_files AS (SELECT 'docs/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text AS content FROM live_docs
              WHERE doc_id % {TOMBSTONE_MOD} <> {TOMBSTONE_REM}),
new_sig AS (SELECT path, 'MD5' AS method, {_sig('MD5', 'content')} AS signature FROM new_files),
diff AS (
  SELECT coalesce(o.path, n.path) AS path,
         CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed'
              WHEN o.signature IS DISTINCT FROM n.signature THEN 'changed' END AS change,
         n.signature
  FROM old_sig o FULL OUTER JOIN new_sig n ON o.path = n.path
)"""
ORACLES["signature_diff"] = _with(SNAP) + "\nSELECT path, change, signature FROM diff WHERE change IS NOT NULL"
_DIGESTED = """
staged AS (SELECT n.path, 'MD5' AS method, octet_length(encode(f.content)) AS n_bytes, n.signature,
                  (o.path IS NULL OR o.text IS DISTINCT FROM f.content) AS digested
           FROM new_sig n JOIN new_files f USING (path)
           LEFT JOIN (SELECT 'docs/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text FROM documents) o USING (path))"""
ORACLES["staged_signatures"] = _with(SNAP, _DIGESTED) + "\nSELECT path, method, n_bytes, signature, digested FROM staged"
ORACLES["staged_digests"] = _with(SNAP, _DIGESTED) + """
SELECT coalesce(d.change, 'unchanged') AS change, count(*) AS n_files,
       count(*) FILTER (WHERE s.digested) AS n_digested
FROM diff d LEFT JOIN staged s USING (path) GROUP BY 1"""
# The corpus, then the delta, then the corpus again.
ORACLES["change_stream"] = _with(SNAP) + """
SELECT CAST(1 AS BIGINT) AS snapshot, path, 'added' AS change, signature FROM old_sig
UNION ALL SELECT 2, path, change, signature FROM diff WHERE change IS NOT NULL
UNION ALL
SELECT 3, d.path, CASE d.change WHEN 'added' THEN 'removed' WHEN 'removed' THEN 'added' ELSE 'changed' END,
       o.signature
FROM diff d LEFT JOIN old_sig o USING (path) WHERE d.change IS NOT NULL"""
ORACLES["commit_baseline"] = _with(SNAP) + "\nSELECT path, method, signature FROM new_sig"
ORACLES["signature_scalar"] = _with(FILES) + f"""
SELECT path, 'MD5' AS method, {_sig('MD5', 'content')} AS signature,
       'MD5|' || path || '|' || {_sig('MD5', 'content')} AS scalar,
       'MD5' AS back_method, path AS back_path, {_sig('MD5', 'content')} AS back_signature FROM files"""
ORACLES["publish_changes"] = _with(SNAP) + """
SELECT d.path, d.change, CASE WHEN d.change = 'removed' THEN NULL ELSE f.content END AS content,
       d.signature, CAST(1 AS BIGINT) AS batch
FROM diff d LEFT JOIN new_files f ON d.path = f.path WHERE d.change IS NOT NULL"""


# --- step 11: streaming (final state equals the batch operators) -------------
ORACLES["live_index_stream"] = ORACLES["latest_delta"]
# Streamed texts are bodies of DOC elements: empty title, text, empty author.
_STREAMED = DELTA.replace("UNION ALL SELECT doc_id, text FROM latest",
                          "UNION ALL SELECT doc_id, chr(10) || text || chr(10) AS text FROM latest")
ORACLES["stream_merge"] = _with(
    _STREAMED, tokenize_cte("live_docs", "postings"), WORKLOAD_CTE, query_terms_cte(),
    search_ctes(docs="live_docs")) + "\nSELECT query_id, doc_id, score, location FROM results"
ORACLES["live_stream_removals"] = (
    ORACLES["stream_merge"] + f" WHERE doc_id % {TOMBSTONE_MOD} <> {TOMBSTONE_REM}")
ORACLES["suggest_stream"] = ORACLES["suggest"]

ORACLES["search_benchmark"] = _with(
    tokenize_cte(),
    "queries AS (SELECT item_id AS query_id, "
    "'\"' || regexp_replace(text, '\\s+', ' ', 'g') || '\"' AS query FROM benchmark)",
    query_terms_cte(), search_ctes()) + "\nSELECT query_id, doc_id, score, location FROM results"

# The log whose sessions are whole user histories.
_BY_USER = f"""
numbered AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k FROM events),
qlog AS (
  SELECT e.user_id AS session_id, e.event_id AS ts,
         CASE WHEN e.k % 2 = 0 THEN substr(v.word, 1, 1) || substr(v.word, 3) ELSE v.word END AS query
  FROM numbered e JOIN vocab v ON v.rank = ((coalesce(e.user_id, 0) * {LOG_USER_WORDS}
    + (e.k // {LOG_REPEAT}) % {LOG_USER_WORDS}) * {LOG_MULT}) % (SELECT count(*) FROM cf)
"""
_head, _rest = QLOG.split("qlog AS (")
_SPELL_BY_USER = _with(tokenize_cte(), _head + _BY_USER.lstrip() + _rest[_rest.index("  UNION ALL"):])
for _q in ("previous_query", "dominates", "mine_corrections", "latest_corrections", "suggest", "edit_distance"):
    ORACLES[f"{_q}_by_user"] = _SPELL_BY_USER + ORACLES[_q].removeprefix(SPELL)
ORACLES["edit_distance_weighted_by_user"] = _SPELL_BY_USER.replace("WITH ", "WITH RECURSIVE ", 1) + \
    ORACLES["edit_distance_weighted"].removeprefix(_RECURSIVE)
ORACLES["suggest_stream_by_user"] = ORACLES["suggest_by_user"]
ORACLES["live_similar_all"] = ORACLES["similar_all"].replace("WITH " + tokenize_cte().strip(), _with(*LIVE_KEPT), 1)

# One row per timed step: the build, each kind of query, similar words.
ORACLES["query_metrics"] = SEARCH + f""",
kinds AS (
  SELECT q.query_id, CASE WHEN count(t.query_id) = 0 THEN 'empty' WHEN count(*) FILTER (WHERE NOT t.negated) = 0 THEN 'negated'
    WHEN bool_or(t.negated) THEN 'mixed' WHEN max(t.n_words) > 1 THEN 'phrase'
    WHEN count(*) > 1 THEN 'words' ELSE 'word' END AS kind
  FROM queries q LEFT JOIN qt t ON t.query_id = q.query_id AND t."offset" = 0 GROUP BY q.query_id
)
SELECT 'build' AS name, count(*) AS n_rows, true AS timed FROM postings WHERE term IN (SELECT word FROM qt)
UNION ALL
SELECT n.kind, count(r.query_id), true
FROM (SELECT unnest(['empty', 'negated', 'mixed', 'phrase', 'words', 'word']) AS kind) n
LEFT JOIN kinds k ON k.kind = n.kind LEFT JOIN results r ON r.query_id = k.query_id GROUP BY n.kind
UNION ALL SELECT 'similar first', count(*), true FROM ({ORACLES["similar_first"]})
UNION ALL SELECT 'similar all', count(*), true FROM ({ORACLES["similar_all"]})"""
