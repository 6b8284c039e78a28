"""Word-level BPE encoding and decoding with a minimal acyclic transducer.

Encoding does what the tokenizers library does with a model file of the kind
"NFC, white space to blanks, lower case; split into contractions, letter runs,
single digits and runs of other characters; byte-level BPE with a word end
mark".  A text is cut at white space, which no token crosses; each distinct
chunk of a batch is normalised and split into words, and each distinct word is
encoded once.

* The lexicon is built from the most frequent words of the whole table: a
  minimal acyclic automaton over their UTF-8 bytes (equal suffixes share their
  states) with a number on every arc; the numbers along a word's path add up
  to its place in a table of id sequences.  Spark ships the file to every
  executor once (``addFile``) and workers map it into memory, so a machine
  holds one copy.  All words of a batch walk it in step.
* Words that it does not accept are merged exactly: one merge per step, the
  lowest rank first, the leftmost of equals, all words in step; long words one
  by one with a heap.  Which words are listed changes the speed, not the ids.

The lexicon holds ``LEXICON`` words of ``LONGEST`` bytes at most, which bounds
what the driver gathers.  Words that come only once in a batch of text are not
counted for it.  The strings of special tokens in a text become their ids, as
the library has it by default.

Decoding joins the tokens' strings by blanks, as the library does for a model
without a decoder.  Null and empty texts have no ids and decode to the empty
text; repeated rows get a row each; a null doc_id is kept.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import chunks, frame, slices, stored, texts_of

LEXICON, LONGEST = 1 << 16, 48
UNIT_BYTES = 8 << 20
NO_RANK = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself if printable in
    Latin-1, else the next free one from U+0100 on."""
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class Merges:
    """Exact merging with arrays: a pair of ids is looked up in a sorted key
    table that gives its rank and the id it becomes."""

    def __init__(self, first: np.ndarray, final: np.ndarray, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        self.first, self.final = first, final  # id of a byte inside a word, and at its end
        self.keys, self.ranks, self.made = keys, ranks, made

    def lookup(self, left: np.ndarray, right: np.ndarray):
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], NO_RANK), at

    def word(self, data: bytes) -> list[int]:
        """One word with a heap of candidate pairs."""
        ids = [int(x) for x in self.first[np.frombuffer(data[:-1], dtype=np.uint8)]] + [int(self.final[data[-1]])]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank, at = self.lookup(np.array([ids[i]]), np.array([ids[j]]))
                if rank[0] != NO_RANK:
                    heapq.heappush(heap, (int(rank[0]), i, ids[i], ids[j], int(self.made[at[0]])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def words(self, found: list[bytes]) -> list[np.ndarray]:
        """Ids of every word."""
        out: list[np.ndarray] = [None] * len(found)  # type: ignore[list-item]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        order = np.argsort(sizes, kind="stable")
        long = np.searchsorted(sizes[order], LONGEST, side="right")
        for i in order[long:]:
            out[i] = np.array(self.word(found[i]), dtype=np.int32)
        for a in range(0, long, 1 << 14):
            some = order[a:min(a + (1 << 14), long)]
            self._together([found[i] for i in some], sizes[some], some, out)
        return out

    def _together(self, found, sizes, places, out) -> None:
        n, width = len(found), int(sizes[-1])
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in found), dtype=np.uint8).reshape(n, width)
        col = np.arange(width)
        ids = np.where(col < sizes[:, None], self.first[data], np.int32(-1))
        ids[np.arange(n), sizes - 1] = self.final[data[np.arange(n), sizes - 1]]
        ids = np.hstack([ids, np.full((n, 1), -1, dtype=ids.dtype)])
        rank = self.lookup(ids[:, :-1], ids[:, 1:])[0]
        row = np.arange(n)
        while len(row):
            at = rank.argmin(axis=1)
            r = np.arange(len(row))
            done = rank[r, at] == NO_RANK
            for i in np.flatnonzero(done):
                own = ids[i]
                out[places[row[i]]] = own[own >= 0]
            live = ~done
            ids, rank, row, at = ids[live], rank[live], row[live], at[live]
            if not len(row):
                break
            r = np.arange(len(row))
            _, key = self.lookup(ids[r, at], ids[r, at + 1])
            ids[r, at] = self.made[key]
            # Close the gap after the merged pair.
            from_ = np.arange(ids.shape[1]) + (np.arange(ids.shape[1]) > at[:, None])
            ids = np.take_along_axis(np.hstack([ids, np.full((len(row), 1), -1, ids.dtype)]), from_, axis=1)
            from_ = np.minimum(from_[:, :-1], rank.shape[1])
            rank = np.take_along_axis(np.hstack([rank, np.full((len(row), 1), NO_RANK, rank.dtype)]), from_, axis=1)
            rank[r, at] = self.lookup(ids[r, at], ids[r, at + 1])[0]
            back = at > 0
            rb, ab = r[back], at[back] - 1
            rank[rb, ab] = self.lookup(ids[rb, ab], ids[rb, ab + 1])[0]


# --- the transducer ------------------------------------------------------------
def compile_lexicon(words: list[bytes]):
    """Arrays of the minimal acyclic automaton of sorted distinct words:
    (arc keys = state * 256 + byte, sorted; arc targets; arc numbers; final
    states).  State 0 is the start."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, list[tuple[int, int]]]] = []  # of registered states
    size: list[int] = []  # words below each registered state

    def freeze(node) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append((node[0], list(node[1])))
            size.append(int(node[0]) + sum(size[t] for _, t in node[1]))
        return register[key]

    path = [[False, []]]  # the last word's states; arcs of frozen children
    last = b""
    for w in words:
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        for depth in range(len(last), common, -1):
            child = freeze(path.pop())
            path[-1][1].append((last[depth - 1], child))
        path.extend([False, []] for _ in range(len(w) - common))
        path[-1][0] = True
        last = w
    for depth in range(len(last), 0, -1):
        child = freeze(path.pop())
        path[-1][1].append((last[depth - 1], child))
    root = freeze(path[0])
    # The root first; a minimal automaton has no arc into it.
    place = np.empty(len(states), dtype=np.int64)
    place[[root, *(s for s in range(len(states)) if s != root)]] = np.arange(len(states))
    arcs = []
    for s, (final, out) in enumerate(states):
        number = int(final)
        for byte, target in out:
            arcs.append((int(place[s]) * 256 + byte, int(place[target]), number))
            number += size[target]
    arcs.sort()
    table = np.array(arcs, dtype=np.int64).reshape(-1, 3)
    final = np.zeros(len(states), dtype=np.uint8)
    final[place] = [f for f, _ in states]
    return table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32), final


PARTS = ("arc_keys", "arc_targets", "arc_numbers", "final", "id_starts", "ids",
         "first", "last", "pair_keys", "pair_ranks", "pair_made")


def write_lexicon(path: str, arrays: dict[str, np.ndarray], strings: list[str]) -> None:
    """One file: a JSON line with places and types, then the arrays."""
    arrays = dict(arrays, strings=np.frombuffer("\n".join(strings).encode(), dtype=np.uint8))
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = (at, len(a), a.dtype.str)
        at += -(-a.nbytes // 64) * 64
    with open(path, "wb") as f:
        f.write(json.dumps(head).encode().ljust(4096))
        for a in arrays.values():
            f.write(a.tobytes().ljust(-(-a.nbytes // 64) * 64, b"\0"))


class Lexicon:
    """The mapped file: words to ids."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype=np.uint8, mode="r").view(np.ndarray)  # pages of the file still
        head = json.loads(bytes(data[:4096]))
        part = {k: data[4096 + at:4096 + at + n * np.dtype(t).itemsize].view(t) for k, (at, n, t) in head.items()}
        self.arc_keys, self.arc_targets, self.arc_numbers, self.final, self.id_starts, self.ids = (
            part[k] for k in PARTS[:6])
        self.merges = Merges(*(part[k] for k in PARTS[6:]))
        self.strings = bytes(part["strings"]).decode().split("\n")

    def find(self, words: list[bytes]) -> np.ndarray:
        """Place of every word in the id table, -1 for words not listed."""
        out = np.full(len(words), -1, dtype=np.int64)
        if not len(self.arc_keys):
            return out
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        short = np.flatnonzero(sizes <= LONGEST)
        order = short[np.argsort(-sizes[short], kind="stable")]
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        state, number = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -step, side="left"))  # words longer than step
            live = np.flatnonzero(state[:n] >= 0)
            key = state[live] * 256 + text[starts[live] + step]
            at = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
            ok = self.arc_keys[at] == key
            state[live] = np.where(ok, self.arc_targets[at], -1)
            number[live] += np.where(ok, self.arc_numbers[at], 0)
        good = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        out[order[good]] = number[good]
        return out

    def encode(self, words: list[bytes]) -> list[list[int]]:
        place = self.find(words)
        new = np.flatnonzero(place < 0).tolist()
        merged = iter(self.merges.words([words[i] for i in new]))
        starts, ids = self.id_starts, self.ids
        return [ids[starts[p]:starts[p + 1]].tolist() if p >= 0 else next(merged).tolist() for p in place.tolist()]


# --- the model -------------------------------------------------------------------
# How the model file's tokenizer splits a chunk.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def lowered(chunk: str) -> str:
    """NFC and lower case, character by character (a final sigma is none)."""
    if chunk.isascii():
        return chunk.lower()
    chunk = unicodedata.normalize("NFC", chunk)
    return "".join(c.lower() for c in chunk) if "Σ" in chunk else chunk.lower()


def split_words(chunk: str) -> list[str]:
    low = lowered(chunk)
    return [low] if low.isalpha() else SPLIT.findall(low)


class Model:
    """A tokenizer file of the library: vocabulary, merges, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        mark = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = token
        letters = byte_letters()
        first = np.array([vocab[c] for c in letters], dtype=np.int32)
        last = np.array([vocab[c + mark] for c in letters], dtype=np.int32)
        pairs = []
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pairs.append(((vocab[a] << 32) | vocab[b], rank, vocab[a + b]))
        keys, ranks, made = np.array(sorted(pairs), dtype=np.int64).T
        self.merges = Merges(first, last, keys.copy(), ranks.astype(np.int32), made.astype(np.int32))

    def lexicon_file(self, path: str, words: list[bytes]) -> None:
        words = sorted(set(words))
        encoded = self.merges.words(words)
        starts = np.r_[0, np.cumsum([len(i) for i in encoded])].astype(np.int64)
        ids = np.concatenate(encoded) if encoded else np.zeros(0, dtype=np.int32)
        m = self.merges
        arrays = [*compile_lexicon(words), starts, ids, m.first, m.final, m.keys, m.ranks, m.made]
        write_lexicon(path, dict(zip(PARTS, arrays)), self.strings)


class Encoder:
    """Encodes texts batch by batch; remembers up to ``most`` chunks, each as
    (number of ids, ids in decimals, decoded text)."""

    def __init__(self, lexicon: Lexicon, special: dict[str, int], most: int = 300_000):
        self.lexicon, self.special, self.most = lexicon, special, most
        self.known: dict[str, tuple[int, str, str]] = {}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.mark = os.path.commonprefix(list(special))  # in every chunk with a special token

    def words_of(self, chunk: str) -> list[str | int]:
        """Words of a chunk; an id for a special token's string."""
        if self.mark not in chunk or self.at_special is None:
            return split_words(chunk)
        out: list[str | int] = []
        for part in self.at_special.split(chunk):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(split_words(part))
        return out

    def learn(self, found: set[str]) -> None:
        if len(self.known) > self.most:
            self.known.clear()
        strings = self.lexicon.strings
        split = {c: self.words_of(c) for c in found.difference(self.known)}
        words = list({w for ws in split.values() for w in ws if isinstance(w, str)})
        shown: dict = {i: (1, str(i), strings[i]) for i in self.special.values()}
        for w, ids in zip(words, self.lexicon.encode([w.encode() for w in words])):
            shown[w] = (len(ids), " ".join(map(str, ids)), " ".join([strings[i] for i in ids]))
        for c, ws in split.items():
            self.known[c] = shown[ws[0]] if len(ws) == 1 else self._joined([shown[w] for w in ws])

    @staticmethod
    def _joined(parts: list[tuple[int, str, str]]) -> tuple[int, str, str]:
        if not parts:
            return 0, "", ""
        n, decimals, decoded = zip(*parts)
        return sum(n), " ".join(decimals), " ".join(decoded)

    def rows(self, texts: list[str]):
        """(number of ids, ids in decimals, decoded text) of every text."""
        split = [chunks(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        for cs in split:
            yield self._joined(list(map(self.known.__getitem__, cs)))

    def ids(self, text: str) -> list[int]:
        return [int(i) for i in next(self.rows([text]))[1].split()]


def decode(ids, strings: list[str]) -> str:
    return " ".join(strings[i] for i in ids)


def frequent_words(docs: DataFrame, most: int = LEXICON, text_col: str = "text") -> list[bytes]:
    """The most frequent words of all texts: all with a count of at least 2^k,
    for the least k that leaves no more than ``most``.  Words are counted per
    batch of text first; single occurrences in a batch are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", UNIT_BYTES):
            count: Counter = Counter()
            for chunk, n in Counter(chain.from_iterable(map(chunks, texts_of(batch.column(0))))).items():
                for w in split_words(chunk):
                    count[w] += n
            rows = [(w.encode(), n) for w, n in count.items() if n > 1]
            rows = [r for r in rows if len(r[0]) <= LONGEST]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                                  pa.array([r[1] for r in rows], pa.int64())], names=["w", "n"])

    counts = stored(docs.select(F.col(text_col).alias("text")).mapInArrow(run, "w binary, n bigint")
                    .groupBy("w").agg(F.sum("n").alias("n")), "word-counts")
    digits = F.length(F.bin("n"))
    sizes = {r["k"]: r["n"] for r in counts.groupBy(digits.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least = max(sizes, default=0) + 1
    while least > 1 and sum(n for k, n in sizes.items() if k >= least - 1) <= most:
        least -= 1
    return [bytes(r["w"]) for r in counts.filter(digits >= least).select("w").collect()]


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                    ("decoded_sha256", pa.string())])


def ship_lexicon(docs: DataFrame, model: Model, most: int = LEXICON) -> str:
    """Build the lexicon of a table, hand the file to all executors; its name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="inkwell-"), name)
    model.lexicon_file(path, frequent_words(docs, most))
    docs.sparkSession.sparkContext.addFile(path)
    return name


@lru_cache(maxsize=1)
def kept_encoder(path: str, special: tuple) -> Encoder:
    """One per Python worker, so that later tasks know the chunks of earlier ones."""
    return Encoder(Lexicon(path), dict(special))


def _encoded(docs: DataFrame, tokenizer_path: str, row, schema: pa.Schema, sql: str) -> DataFrame:
    model = Model(tokenizer_path)
    name, special = ship_lexicon(docs, model), model.special

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(SparkFiles.get(name), tuple(special.items()))
        for batch in slices(batches, "text", UNIT_BYTES):
            rows = [row(*r) for r in encoder.rows(texts_of(batch.column(1)))]
            yield frame(schema, [batch.column(0), *zip(*rows)])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, sql))


def encode_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per document."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return _encoded(docs, tokenizer_path, lambda n, ids, text: (n, sha(ids), sha(text)), DIGEST,
                    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids, decoded), one row per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
    return _encoded(docs, tokenizer_path, lambda n, ids, text: ([int(i) for i in ids.split()], text), schema,
                    "doc_id bigint, ids array<int>, decoded string")
