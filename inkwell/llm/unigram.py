"""Token counts of a unigram tokenizer without its tokens.

The vocabulary is a list of (piece, score).  White space (blank, \\t to \\r)
becomes the word mark in front of each word, and no piece holds a mark
elsewhere than at its start, so words are independent.  An Aho-Corasick
automaton enumerates the pieces that end at each character of a word; dynamic
programming carries the best score and the number of pieces up to there.

Tie rules are those of the tokenizers library's Unigram model: scores are added
from the left in double precision, and of equal scores the path whose last
piece starts first stays.  A character that no piece of its own stands for can
be an unknown one, at the least score of the vocabulary minus 10; it counts as
its UTF-8 bytes (byte fallback).

The vocabulary of the query is the piece list of a public model file in rank
order, scored by Zipf's law; any list can be given.  Null and empty texts count
0; every row gets its row; a null doc_id is kept; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import frame, slices, texts_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0
UNIT_BYTES = 8 << 20


def ranked_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file in rank order, scored -log(rank + 1)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    out: list[tuple[str, float]] = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and MARK not in piece[1:]:
            out.append((piece, -math.log(len(out) + 1)))
    return out


class Counter(dict):
    """word in UTF-8 -> number of pieces, found when first asked for; holds ``most``
    words at most."""

    def __init__(self, vocabulary: list[tuple[str, float]], most: int = 800_000):
        super().__init__()
        self.vocabulary, self.most = vocabulary, most
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        n = self[word] = self.count(MARK + word.decode())
        return n

    def count(self, word: str) -> int:
        n, single, unknown = len(word), self.single, self.unknown
        score: list[float | None] = [0.0] + [None] * n
        pieces = [0] * (n + 1)
        end = 0  # positions up to here are settled

        def settle(upto: int) -> None:
            # Unknown characters come last among the paths to their end.
            nonlocal end
            while end < upto:
                c = word[end]
                if c not in single:
                    s = score[end] + unknown
                    if score[end + 1] is None or s > score[end + 1]:
                        score[end + 1], pieces[end + 1] = s, pieces[end] + len(c.encode())
                end += 1

        matches = self.automaton.iter(word) if len(self.automaton) else ()
        for last, (size, own) in matches:  # ascending ends, longest piece first
            if last > end:
                settle(last)
            start = last + 1 - size
            s = score[start] + own
            if score[last + 1] is None or s > score[last + 1]:
                score[last + 1], pieces[last + 1] = s, pieces[start] + 1
        settle(n)
        return pieces[n]

    def tokens(self, text: str) -> int:
        return sum(map(self.__getitem__, _words(text)))


def _words(text: str) -> list[bytes]:
    return text.encode().split()  # bytes.split: blank and \t to \r, nothing else


_KEPT: list[Counter] = []


def kept_counter(vocabulary: list[tuple[str, float]]) -> Counter:
    """One counter per Python worker and vocabulary, so that later tasks know
    the words of earlier ones."""
    if not _KEPT or _KEPT[0].vocabulary is not vocabulary:
        _KEPT[:] = [Counter(vocabulary)]
    return _KEPT[0]


COUNT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens), one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept_counter(shared.value)
        for batch in slices(batches, "text", UNIT_BYTES):
            words = [_words(t) for t in texts_of(batch.column(1))]
            yield frame(COUNT, [batch.column(0), [len(w) for w in words],
                                [sum(map(counter.__getitem__, w)) for w in words]])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id bigint, n_words bigint, n_tokens bigint"))
