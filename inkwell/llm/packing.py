"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

A document is its token ids and a final ``END`` id; only longer ones are cut
into pieces of ``CAPACITY`` (4096) ids, the last of which may be shorter.  Full
pieces are sequences of their own.  The others are dealt by a hash of their
row number to shards of about ``SHARD`` pieces; the shards are independent
tasks, as many as the input needs.

Each shard is packed by ``ISLANDS`` populations of solutions (groupings of
pieces into sequences), each a task of its own.  They start from best-fit
orders with random swaps and evolve: crossover injects whole well-filled
sequences of one parent into the other, drops the sequences that hold the
same pieces, and best-fits the displaced pieces, largest first; mutation
dissolves badly filled sequences the same way.  After every epoch the islands'
best solutions are stored and the next island of the shard takes them in.
A population that reaches the lower bound stops.

What is left over at the shards' ends (sequences filled below ``REPACK`` of the
capacity) is gathered, dealt to new shards and packed once more.

Null and empty texts are one piece that holds only the final id.  A null doc_id
is kept, repeated rows are packed one by one, other columns are ignored, an
empty table gives an empty result.  Random choices are seeded by shard and
island, so a task that is run again gives the same rows.
"""

from __future__ import annotations

import gc
import json
import random
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.bpe import byte_letters
from inkwell.llm.common import chunks, frame, kept, release, slices, stored, texts_of

CAPACITY, END = 4096, 1
SHARD, ISLANDS, EPOCHS, REPACK = 4000, 2, 2, 0.99
POPULATION, GENERATIONS, ELITES = 4, 6, 2
UNIT_BYTES = 2 << 20  # with what is kept of the tokens, what bounds a worker's memory
KEPT_BYTES, ENTRY_BYTES = 48 << 20, 190  # one generation; an entry's own objects
_BYTE_LETTERS = {b: c for b, c in enumerate(byte_letters()) if chr(b) != c}


# --- tokens --------------------------------------------------------------------
# Characters below this have the same class in every Unicode table in use; a
# chunk of others goes through the library whole.
_PLAIN = 0x180
_LETTERS, _NUMBERS = ("".join(re.escape(chr(i)) for i in range(_PLAIN) if unicodedata.category(chr(i))[0] == kind)
                      for kind in "LN")
# The library's way of parting words (fixed value), over these characters.
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")
# Printable; U+0130 is left out, as its lower case is two characters.
_SIMPLE = re.compile("[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f]+")


class Words(dict):
    """word (lower case, printable) -> ids as little-endian 32-bit bytes."""

    def __init__(self, model, older: dict):
        super().__init__()
        self.model, self.older, self.bytes = model, older, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        self[word] = ids
        self.bytes += ENTRY_BYTES + len(word) + len(ids)
        return ids


class Chunks(dict):
    """chunk (no white space in it) -> the ids of its words."""

    def __init__(self, owner: ChunkTokens, older: dict):
        super().__init__()
        self.owner, self.older, self.bytes = owner, older, 0

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.owner.chunk(chunk)
        self[chunk] = ids
        self.bytes += ENTRY_BYTES + len(chunk) + len(ids)
        return ids


class ChunkTokens:
    """Ids of texts by the tokenizers library.  The tokenizer's pieces never
    cross white space, so a text's ids are those of its chunks, and a chunk's
    those of its words, which are lower-cased and parted here and encoded by the
    library's model.  Chunks with special tokens or characters outside
    ``_SIMPLE`` go through the whole library.

    Chunks and words are kept in two generations of about ``budget`` bytes each:
    a full one becomes the older one, and what is asked for moves on to the next."""

    def __init__(self, tokenizer_json: str, budget: int = KEPT_BYTES):
        from tokenizers import Tokenizer
        self.library, self.budget = Tokenizer.from_str(tokenizer_json), budget
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(tokenizer_json)
        self.special = [t["content"] for t in spec["added_tokens"]]
        plain = spec | {"added_tokens": [], "normalizer": None, "pre_tokenizer": None}
        self.model = Tokenizer.from_str(json.dumps(plain)).model
        self.words, self.chunks = Words(self.model, {}), Chunks(self, {})

    def chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self.words[chunk.lower()]
        if _SIMPLE.fullmatch(chunk) and not any(s in chunk for s in self.special):
            return b"".join(map(self.words.__getitem__, _WORDS.findall(chunk.lower())))
        return array("I", self.library.encode(chunk, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        known = self.chunks.__getitem__
        out = [b"".join(map(known, chunks(t))) for t in texts]
        if self.words.bytes > self.budget:
            self.words = Words(self.model, self._young(self.words))
        if self.chunks.bytes > self.budget:
            self.chunks = Chunks(self, self._young(self.chunks))
        return out

    @staticmethod
    def _young(full) -> dict:
        full.older = {}  # the generation before is forgotten
        return full


PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                   ("length", pa.int64()), ("ids_crc32", pa.int64())])
PIECE_SQL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END,
           id_col: str = "doc_id", text_col: str = "text", kept_bytes: int = KEPT_BYTES) -> DataFrame:
    """One row per piece of every document."""
    with open(tokenizer_path, encoding="utf-8") as f:  # on the driver; a few MB
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = kept(("packing", zlib.crc32(model.value.encode()), kept_bytes), lambda: ChunkTokens(model.value, kept_bytes))
        gc.disable()  # nothing here makes cycles
        try:
            for batch in slices(batches, "text", UNIT_BYTES):
                rows = []
                for doc, ids in zip(batch.column(0).to_pylist(), tokens.encode(texts_of(batch.column(1)))):
                    ids += last
                    for i, a in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[a:a + 4 * capacity]
                        rows.append((doc, i, a // 4, len(part) // 4, zlib.crc32(part)))
                yield frame(PIECE, zip(*rows))
        finally:
            gc.enable()
            release()

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, PIECE_SQL))


# --- one population --------------------------------------------------------------
class Bins:
    """Groups of pieces; finds the fullest group that still takes a piece."""

    def __init__(self, sizes, capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.groups: list[list[int]] = []
        self.room: list[int] = []
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]  # groups by room
        self.some = 0  # bit r is set if a group may have room r

    def add(self, group: list[int]) -> None:
        room = self.capacity - sum(self.sizes[i] for i in group)
        self.groups.append(group)
        self.room.append(room)
        self._file(len(self.groups) - 1, room)

    def _file(self, g: int, room: int) -> None:
        self.at[room].append(g)
        self.some |= 1 << room

    def best_fit(self, items) -> None:
        """Put items one by one into the group with the least sufficient room."""
        sizes, at = self.sizes, self.at
        for i in items:
            size = sizes[i]
            left = self.some >> size
            if left:
                room = size + (left & -left).bit_length() - 1
                g = at[room].pop()
                if not at[room]:
                    self.some ^= 1 << room
                self.groups[g].append(i)
            else:
                g, room = len(self.groups), self.capacity
                self.groups.append([i])
                self.room.append(room)
            self.room[g] = room - size
            self._file(g, room - size)


def fitness(groups, sizes, capacity: int) -> float:
    """Fewer groups first, then uneven filling (a nearly empty group is about to go)."""
    fill = [sum(sizes[i] for i in g) / capacity for g in groups]
    return -len(groups) + sum(f * f for f in fill) / (len(groups) + 1)


def rebuild(groups, keep, free, sizes, capacity: int):
    """The kept groups, with the free pieces best-fitted, largest first."""
    bins = Bins(sizes, capacity)
    for g in keep:
        bins.add(list(groups[g]))
    bins.best_fit(sorted(free, key=lambda i: -sizes[i]))
    return bins.groups


def crossover(a, b, sizes, capacity: int, rng: random.Random, share: float = 0.05):
    """Inject well-filled groups of b into a."""
    fill = [sum(sizes[i] for i in g) for g in b]
    best = sorted(range(len(b)), key=lambda g: -fill[g])[:max(1, len(b) // 2)]
    taken = [b[g] for g in rng.sample(best, max(1, int(share * len(b))))] if len(best) > 1 else [b[best[0]]]
    inside = set(chain.from_iterable(taken))
    keep, free = [], []
    for g, items in enumerate(a):
        if inside.isdisjoint(items):
            keep.append(g)
        else:
            free.extend(i for i in items if i not in inside)
    return rebuild([*a, *taken], [*keep, *range(len(a), len(a) + len(taken))], free, sizes, capacity)


def mutate(a, sizes, capacity: int, rng: random.Random, share: float = 0.02):
    """Dissolve the emptiest groups and a few others."""
    n = max(2, int(share * len(a)))
    order = sorted(range(len(a)), key=lambda g: sum(sizes[i] for i in a[g]))
    gone = set(order[:n]) | set(rng.sample(range(len(a)), min(len(a), n)))
    return rebuild(a, [g for g in range(len(a)) if g not in gone],
                   [i for g in gone for i in a[g]], sizes, capacity)


def first_solution(sizes, capacity: int, rng: random.Random, noise: float):
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + noise * rng.random()))
    bins = Bins(sizes, capacity)
    bins.best_fit(order)
    return bins.groups


def evolve(sizes: list[int], capacity: int, seed: int, guests=(), generations: int = GENERATIONS,
           population: int = POPULATION):
    """The ``ELITES`` best groupings, best first."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    rank = lambda g: -fitness(g, sizes, capacity)
    pool = [list(map(list, g)) for g in guests]
    while len(pool) < population:
        pool.append(first_solution(sizes, capacity, rng, 0.0 if not pool else 0.1))
        if len(pool[-1]) == least:
            break
    pool.sort(key=rank)
    for _ in range(generations):
        if len(pool[0]) <= least:
            break
        a, b = rng.sample(range(len(pool)), 2) if len(pool) > 1 else (0, 0)
        new = [crossover(pool[min(a, b)], pool[max(a, b)], sizes, capacity, rng),
               mutate(pool[0], sizes, capacity, rng)]
        pool = sorted([*pool, *new], key=rank)[:population]
    return pool[:ELITES]


# --- islands on Spark --------------------------------------------------------------
ITEMS = ["shard", "item", "length"]
SOLUTION = "shard bigint, island int, place int, worth double, groups binary"


def _numbered(groups, n: int) -> bytes:
    out = np.zeros(n, dtype="<i4")
    for g, items in enumerate(groups):
        out[items] = g
    return out.tobytes()


def _grouped(data: bytes):
    of = np.frombuffer(data, dtype="<i4")
    groups: list[list[int]] = [[] for _ in range(int(of.max()) + 1 if len(of) else 0)]
    for i, g in enumerate(of.tolist()):
        groups[g].append(i)
    return [g for g in groups if g]


def _epoch(capacity: int, epoch: int):
    def run(key, items: pd.DataFrame, guests: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(key[0]), int(key[1])
        sizes = items.sort_values("item")["length"].tolist()
        seed = (shard * 64 + island) * 64 + epoch
        known = [_grouped(g) for g in guests.sort_values(["worth", "place"], ascending=[False, True])["groups"]]
        best = evolve(sizes, capacity, seed, known) if sizes else []
        return pd.DataFrame([(shard, island, i, fitness(g, sizes, capacity), _numbered(g, len(sizes)))
                             for i, g in enumerate(best)],
                            columns=["shard", "island", "place", "worth", "groups"])
    return run


def _place(key, items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
    items = items.sort_values("item").reset_index(drop=True)
    items["bin"] = np.frombuffer(best["groups"].iloc[0], dtype="<i4").astype("int64") if len(items) else []
    items["offset"] = items.groupby("bin")["length"].cumsum() - items["length"]
    items["fill"] = items.groupby("bin")["length"].transform("sum")
    return items[["shard", "item", "bin", "offset", "fill"]]


def pack(items: DataFrame, capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS,
         shard: int = SHARD, round_no: int = 0) -> DataFrame:
    """(shard, item, bin, offset, fill) for items(item, length), each group
    (shard, bin) holding at most ``capacity``."""
    n = items.count()
    shards = max(1, -(-n // shard))
    items = items.select(F.pmod(F.xxhash64("item", F.lit(round_no)), F.lit(shards)).cast("bigint").alias("shard"),
                         "item", "length")
    each = items.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
    spark = items.sparkSession
    found = spark.createDataFrame([], SOLUTION)
    for epoch in range(epochs):
        # Every island goes on with its own elites and the best of its neighbour.
        guests = found if epoch == 0 else found.unionByName(
            found.filter("place = 0").withColumn("island", ((F.col("island") + 1) % islands).cast("int")))
        found = stored(each.groupBy("shard", "island").cogroup(guests.groupBy("shard", "island"))
                       .applyInPandas(_epoch(capacity, epoch), SOLUTION), "packing-epoch")
    best = found.groupBy("shard").agg(F.max_by("groups", F.struct("worth", -F.col("island"))).alias("groups"))
    return items.groupBy("shard").cogroup(best.groupBy("shard")).applyInPandas(
        _place, "shard bigint, item bigint, bin bigint, offset bigint, fill bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END,
                   kept_bytes: int = KEPT_BYTES, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row
    per piece.  ``kept_bytes`` bounds one generation of the tokens that a worker
    keeps; it changes the speed, not the rows."""
    rows = stored(pieces(docs, tokenizer_path, capacity, end, kept_bytes=kept_bytes)
                  .withColumn("item", F.monotonically_increasing_id()), "pieces")
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = (rows.filter(F.col("length") == capacity)
            .withColumn("sequence_id", -F.col("item") - 1).withColumn("offset", F.lit(0).cast("bigint")))
    small = rows.filter(F.col("length") < capacity)
    placed = stored(pack(small.select("item", "length"), capacity, **options), "packed")
    loose = F.col("fill") < int(REPACK * capacity)
    again = small.join(placed.filter(loose).select("item"), "item").select("item", "length")
    last = pack(again, capacity, round_no=1, **options)
    number = F.col("shard") * F.lit(1 << 31) + F.col("bin")
    places = (placed.filter(~loose).select("item", (2 * number).alias("sequence_id"), "offset")
              .unionByName(last.select("item", (2 * number + 1).alias("sequence_id"), "offset")))
    return full.select(*out).unionByName(small.join(places, "item").select(*out))
