"""Column expressions for document text.

Everything here is a built-in Spark expression (JVM side, no Python per
row), so it runs inside the scan's stage and never forces a shuffle.

Split semantics follow the "split on whitespace runs" rule of the source
system: a leading empty field is kept, trailing empty fields are dropped and
an empty string has no fields at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the source system's for equal results).
# A term is a lower-cased word with leading and trailing characters that are
# neither letters nor digits removed.
TERM_EDGE_PATTERN = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
# Whitespace directly before a full stop is removed before splitting.
STOP_FOLD_PATTERN = r"\s\."
# Snippets: 21 words, the hit is word 11 (1-based) when it is far enough in.
SNIPPET_BEFORE = 11
SNIPPET_WORDS = 21
SNIPPET_BREAK = "\n\t\t"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_stops(text) -> Column:
    return F.regexp_replace(_col(text), STOP_FOLD_PATTERN, ".")


def split_words(text) -> Column:
    """Whitespace split: keep a leading empty field, drop trailing ones."""
    stripped = F.regexp_replace(_col(text), r"\s+$", "")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, r"\s+"))


def normalize_term(word) -> Column:
    return F.regexp_replace(F.lower(_col(word)), TERM_EDGE_PATTERN, "")


# Whitespace that is not yet a single space: runs of two or more, and others alone
# (told apart by their first character, so that a letter is tested once).
_NOT_ONE_SPACE = r" \s++|[\t\n\x0B\f\r]\s*+"
# Word edges on lower-cased text whose whitespace runs are single spaces: a run of
# non-letter/digit characters at the start or at the end of a word.  Most characters
# are plain letters, digits and spaces; the test before both cases leaves them at one
# table look-up each (which Java has for listed characters, not for ranges or classes).
_PLAIN = "abcdefghijklmnopqrstuvwxyz0123456789"
_OTHER = r"[^ a-z0-9\p{L}\p{N}]"
_WORD_EDGES = rf"(?=[^ {_PLAIN}])(?:(?<![^ ]){_OTHER}++|{_OTHER}++(?![^ ]))"


def term_array(text) -> Column:
    """Terms of a text aligned with its whitespace split ('' where a word has
    no letter or digit, and after trailing whitespace).  Whole-text regular
    expressions (one pass each) instead of one expression per word."""
    spaced = F.regexp_replace(fold_stops(text), _NOT_ONE_SPACE, " ")
    return F.split(F.regexp_replace(F.lower(spaced), _WORD_EDGES, ""), " ")


def term_positions(text) -> Column:
    """array<struct<term:string, wpos:int>> of the non-empty terms of a text.

    ``wpos`` is the offset in the whitespace split (used for snippets); the
    array index of an element is its dense term position ``pos`` (used for
    phrase adjacency).  Computed per row, so no window or shuffle is needed
    to number positions.  (An array of one element binds the terms, so that the
    text is split once.)
    """
    def tagged(terms):
        pairs = F.arrays_zip(terms.alias("term"), F.sequence(F.lit(0), F.size(terms) - 1).alias("wpos"))
        return F.filter(pairs, lambda x: x["term"] != "")

    return F.element_at(F.transform(F.array(term_array(text)), tagged), 1)


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _places(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1)).otherwise(_none("int"))


def with_terms(docs: DataFrame, *keep, text_col="text") -> DataFrame:
    """The columns ``keep`` of every document, the array ``_t`` of its non-empty
    terms and the array ``_w`` of their offsets in the whitespace split (null
    where offsets and places are the same).  Exploded, single elements are read
    from the arrays inside the generator's loop: no copy of a text per term.
    (A null text has no terms, and the arrays are never null: for a filter or a join
    on an element of an array that may be, the optimizer would drop null arrays
    before it, and make the whole array twice for that.)  Documents that hold these
    arrays already (``with_terms`` of them, stored) are not tokenized again."""
    if {"_t", "_w"} <= set(docs.columns):
        return docs.select(*keep, "_t", "_w")
    words = docs.select(*keep, F.coalesce(term_array(text_col), _none("string")).alias("_words"))
    terms = words.select("*", F.array_remove("_words", "").alias("_t"))
    offsets = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: F.get("_words", i) != "")
    return terms.withColumn("_w", F.when(F.size("_t") < F.size("_words"), offsets)).drop("_words")


def exploded(docs: DataFrame, *keep: str, array: str = "_t", pos: str = "pos", value: str = "term") -> DataFrame:
    """``keep``, place and value of every element of an array.  (Exploded as
    outer and the empty ones dropped: for an inner one the optimizer would repeat
    the array's whole expression in a filter before it.)"""
    return docs.select(*keep, F.posexplode_outer(array).alias(pos, value)).filter(F.col(pos).isNotNull())


def placed_terms(terms="_t") -> Column:
    """array<struct<term, pos>> of an array of terms, sorted."""
    terms = _col(terms)
    return F.sort_array(F.arrays_zip(terms.alias("term"), _places(terms).alias("pos")))


def offset_of(pos="pos") -> Column:
    """Offset in the whitespace split of the term at a place of ``with_terms``."""
    return F.coalesce(F.get("_w", _col(pos)), _col(pos)).cast("int")


def run_starts(items, same) -> Column:
    """array<int>: places of a sorted array at which a run of equal elements
    begins; ``same`` takes the part of an element that is compared."""
    items = _col(items)
    return F.filter(_places(items),
                    lambda i: (i == 0) | (same(F.get(items, i)) != same(F.get(items, i - 1))))


def begins_run(items, place, same) -> Column:
    """Whether a run of equal elements begins at a place of a sorted array: beside
    the exploded place, where it is compiled with the generator's loop."""
    items, place = _col(items), _col(place)
    return (place == 0) | (same(F.get(items, place)) != same(F.get(items, place - 1)))


def doc_length(text) -> Column:
    """Words after removing '.' and ',' (leading empty field counts)."""
    cleaned = F.regexp_replace(_col(text), r"[.,]", "")
    return F.size(split_words(cleaned)).cast("int")


def normalize_docno(docno) -> Column:
    """Keep the digits of a document number: 'doc-12' and 'A1B2' give 12."""
    return F.regexp_replace(F.trim(_col(docno)), r"[^0-9]", "").try_cast("bigint")


def compose_body(title, text, author) -> Column:
    """TITLE, TEXT and AUTHOR joined by newlines; missing parts are ''."""
    return F.concat_ws("\n", F.coalesce(_col(title), F.lit("")),
                       F.coalesce(_col(text), F.lit("")),
                       F.coalesce(_col(author), F.lit("")))


def document_title(text) -> Column:
    """First four lines of the stored text, one final newline removed."""
    parts = F.split(_col(text), "\n", -1)
    return F.when(F.size(parts) > 4,
                  F.array_join(F.slice(parts, 1, 4), "\n")).otherwise(
        F.regexp_replace(_col(text), r"\n\z", ""))


def snippet(text, location, line_break: bool = True) -> Column:
    """21 words around a 1-based word location (0 = from the start).

    Each word is followed by a space; the break goes after the 11th slot
    whether or not that word exists.
    """
    return snippet_of(split_words(fold_stops(text)), location, line_break)


def snippet_of(words, location, line_break: bool = True) -> Column:
    """``snippet`` from the words of a text."""
    words, loc = _col(words), _col(location)
    start = F.when(loc > SNIPPET_BEFORE, loc - SNIPPET_BEFORE).otherwise(F.lit(0))
    head = F.slice(words, start + 1, SNIPPET_BEFORE)
    tail = F.slice(words, start + SNIPPET_BEFORE + 1,
                   SNIPPET_WORDS - SNIPPET_BEFORE)

    def spaced(a):
        return F.when(F.size(a) == 0, F.lit("")).otherwise(F.concat(F.array_join(a, " "), F.lit(" ")))

    sep = F.lit(SNIPPET_BREAK if line_break else "")
    return F.concat(spaced(head), sep, spaced(tail))
