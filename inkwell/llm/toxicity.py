"""Toxic spans and document scores from a linear-chain conditional random
field.

Two tags (0 clean, 1 toxic) over the words of a sentence; a chain ends at
``.``, ``!``, ``?`` or a line end.  Words are white-space separated; their
features are the lower-cased word without outer punctuation and its prefixes
of 3 to 6 characters.  Labels are given per document, so the token tags to
learn from are made first: in a toxic training document the words with a
feature that tells toxic from clean documents (a significance test of document
frequencies that follows the sizes of the classes) are tagged 1, all others 0.

Forward and backward messages of two tags are one log-ratio each, computed in
step for all sentences of a batch; their sum is the logit of the marginal.  A
document's score is a logistic function of the marginals' sum and maximum,
fitted on the training documents; offending words are those with a marginal of
at least 0.5, given as (start, end) code-point offsets.

Fit sample: of either class the ``max_docs`` (1,000) labelled documents of at
most ``max_chars`` (20,000) characters that come first by a hash of doc_id,
gathered on the driver (bounded by 2 * max_docs * max_chars characters); the
model is a table of at most ``max_features`` weights.  Scoring covers every
word of every text.  Null and empty texts have no words and get the score of
no evidence; repeated rows are scored one by one; labels that are null are
ignored, a doc_id with both labels counts as toxic.  Without both classes all
scores are 0.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import release, slices, texts_of

MAX_DOCS, MAX_CHARS, MAX_FEATURES = 1_000, 20_000, 200_000
PREFIXES = (3, 4, 5, 6)
UNIT_BYTES = 4 << 20  # text handled at once by a worker
_EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + " \n"
_BREAKS = (".", "!", "?", "\n")
_WORD = re.compile(r"\S+")


def word_features(word: str) -> list[str]:
    core = word.strip(_EDGE).lower()
    return [f"={core}", *(core[:k] for k in PREFIXES if len(core) >= k)] if core else []


def tokens(text: str) -> list[str]:
    """Words; a line end is glued to the word before it, so that it can end a
    chain.  Joined by blanks (none after a line end), they give the text back,
    with blanks for tabs and the like."""
    for c in "\t\x0b\x0c\r":
        if c in text:
            text = text.replace(c, " ")
    return text.replace("\n", "\n ").split(" ")


def ends_chain(word: str) -> bool:
    return word.endswith(_BREAKS)


def stepwise(lengths: np.ndarray):
    """Sentences by descending length and, for every step, how many of them
    are still running."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths[order[0]]) if len(lengths) else 0
    running = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    return order, running


@dataclass
class Crf:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    first: float = 0.0  # a chain starts toxic
    enter: float = 0.0  # 0 -> 1
    leave: float = 0.0  # 1 -> 0
    stay: float = 0.0  # 1 -> 1
    score: tuple[float, ...] = (-30.0, 0.0, 0.0)  # document logit: constant, log sum, maximum

    def emission(self, word: str) -> float:
        """The word's log-ratio of toxic to clean: bias and feature weights
        (the loop of ``word_features``, spelled out for speed)."""
        core, get = word.strip(_EDGE).lower(), self.weights.get
        out = self.bias + get("=" + core, 0.0)
        for k in PREFIXES:
            if len(core) < k:
                break
            out += get(core[:k], 0.0)
        return out

    def messages(self, e: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """Log-ratios of the forward and the backward messages of every token."""
        fwd, bwd = np.empty_like(e), np.zeros_like(e)
        order, running = stepwise(lengths)
        s, last = starts[order], (starts + lengths - 1)[order]
        la = np.logaddexp
        for t, n in enumerate(running):
            at = s[:n] + t
            if t == 0:
                fwd[at] = self.first + e[at]
            else:
                r = fwd[at - 1]
                fwd[at] = e[at] + la(r + self.stay, self.enter) - la(r + self.leave, 0.0)
        for t, n in enumerate(running):
            if t:
                at = last[:n] - t
                x = e[at + 1] + bwd[at + 1]
                bwd[at] = la(self.leave, self.stay + x) - la(0.0, self.enter + x)
        return fwd, bwd

    def logits(self, e, starts, lengths) -> np.ndarray:
        if not len(e):
            return np.zeros(0)
        fwd, bwd = self.messages(e, starts, lengths)
        return fwd + bwd

    def document_logit(self, log_sum: np.ndarray, top: np.ndarray) -> np.ndarray:
        a, b, c = self.score
        return a + b * log_sum + c * top


def chains(word_ends: np.ndarray, doc_first: np.ndarray):
    """Starts and lengths of the chains: a token starts one if it is the first
    of a document or the token before it ends one."""
    n = len(word_ends)
    new = np.zeros(n, dtype=bool)
    new[doc_first[doc_first < n]] = True
    new[1:] |= word_ends[:-1]
    starts = np.flatnonzero(new)
    return starts, np.diff(np.r_[starts, n])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def evidence(p: np.ndarray, first: np.ndarray, counts: np.ndarray):
    """Per document: log of the sum of the marginals, and their maximum."""
    log_sum, top = np.full(len(counts), np.log(1e-6)), np.zeros(len(counts))
    some = counts > 0
    if some.any():
        log_sum[some] = np.log(np.add.reduceat(p, first[some]) + 1e-6)
        top[some] = np.maximum.reduceat(p, first[some])
    return log_sum, top


# --- fit ------------------------------------------------------------------
def training_sample(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS,
                    max_chars: int = MAX_CHARS) -> DataFrame:
    """(doc_id, text, toxic) of the training documents: rows whose
    crc32(doc_id as text) mod 5 is not 0."""
    usable = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    some = None
    for c in (0, 1):  # three times the ids that are wanted, as some texts are too long or missing
        part = (usable.filter(F.col("toxic") == c)
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(3 * max_docs))
        some = part if some is None else some.unionByName(part)
    rows = (docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
            .filter(F.length("text").between(1, max_chars)))
    out = None
    for c in (0, 1):
        part = (rows.filter(F.col("toxic") == c)
                .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(max_docs))
        out = part if out is None else out.unionByName(part)
    return out


def telling_features(toxic: Counter, clean: Counter, n1: int, n0: int, min_log_odds: float = 2.0) -> set[str]:
    """Features whose document frequency tells toxic from clean documents: more
    frequent by ``min_log_odds``, and so much that chance would bring it about
    for less than one of all features tested.  Chance is the binomial tail (by
    its Chernoff bound) of the toxic documents among the c that hold it; a
    feature too rare to pass even if all its documents were toxic is not tested.
    So the bar follows the sizes of the classes and the number of features."""
    share = n1 / (n1 + n0)
    # Tests in order of the best value they can reach: the k-th must reach ln k.
    reach = np.sort([-(c + clean[f]) * np.log(share) for f, c in toxic.items()])[::-1]
    tested = int((reach >= np.log(np.arange(1, len(reach) + 1))).sum())
    bar = np.log(max(1, tested))
    out = set()
    for f, c1 in toxic.items():
        c = c1 + clean[f]
        if c1 <= share * c:
            continue
        q = c1 / c
        chance = c1 * np.log(q / share) + ((c - c1) * np.log((1 - q) / (1 - share)) if c1 < c else 0.0)
        odds = np.log((c1 + 0.5) / (n1 + 1)) - np.log((clean[f] + 0.5) / (n0 + 1))
        if chance >= bar and odds >= min_log_odds:
            out.add(f)
    return out


def fit(texts: list[str], toxic: list[int], min_docs: int = 3, min_log_odds: float = 2.0,
        max_features: int = MAX_FEATURES, rounds: int = 40, rate: float = 0.3,
        l2: float = 1e-4) -> Crf:
    pairs = dict(zip(texts, toxic))  # copies count once
    texts, y = list(pairs), np.array(list(pairs.values()), dtype=bool)
    if not y.any() or y.all():
        return Crf()
    words = [tokens(t) for t in texts]
    feats: dict[str, list[str]] = {}
    seen = {True: Counter(), False: Counter()}
    for ws, label in zip(words, y):
        own: set[str] = set()
        for w in set(ws):
            if w not in feats:
                feats[w] = word_features(w)
            own.update(feats[w])
        seen[bool(label)].update(own)
    n1, n0 = int(y.sum()), int((~y).sum())
    telling = telling_features(seen[True], seen[False], n1, n0, min_log_odds)
    # Features that come in several documents, most frequent first.
    total = seen[True] + seen[False]
    kept = sorted((f for f, c in total.items() if c >= min_docs), key=lambda f: (-total[f], f))[:max_features]
    index = {f: i for i, f in enumerate(kept)}

    types = {w: i for i, w in enumerate(feats)}
    rows = np.array([i for w, i in types.items() for f in feats[w] if f in index], dtype=np.int64)
    cols = np.array([index[f] for w in types for f in feats[w] if f in index], dtype=np.int64)
    marked = np.array([any(f in telling for f in feats[w]) for w in types])
    ends = np.array([ends_chain(w) for w in types])
    counts = np.array([len(w) for w in words])
    first = np.r_[0, np.cumsum(counts)[:-1]]
    token = np.fromiter((types[w] for ws in words for w in ws), dtype=np.int64, count=int(counts.sum()))
    starts, lengths = chains(ends[token], first)
    # A word that tells toxic documents apart is toxic in those.
    tag = (marked[token] & np.repeat(y, counts)).astype(float)
    at = np.ones(len(token), dtype=bool)
    at[starts] = False
    second = np.flatnonzero(at)  # tokens with a token before them in their chain

    crf = Crf()
    w = np.zeros(len(kept))
    params = np.array([crf.bias, 0.0, 0.0, 0.0, 0.0])
    theta = np.concatenate([params, w])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n_types = len(types)
    observed_type = np.bincount(token, weights=tag, minlength=n_types)
    a, b = tag[second - 1], tag[second]
    observed = np.array([tag.sum(), tag[starts].sum(), ((1 - a) * b).sum(), (a * (1 - b)).sum(), (a * b).sum()])
    for step in range(1, rounds + 1):
        crf.bias, crf.first, crf.enter, crf.leave, crf.stay = theta[:5]
        w = theta[5:]
        unary = crf.bias + np.bincount(rows, weights=w[cols], minlength=n_types)
        e = unary[token]
        fwd, bwd = crf.messages(e, starts, lengths)
        p = sigmoid(fwd + bwd)
        # Pairwise marginals, up to their sum.
        r, x = fwd[second - 1], e[second] + bwd[second]
        s01, s10, s11 = crf.enter + x, crf.leave + r, crf.stay + r + x
        z = np.logaddexp(np.logaddexp(0.0, s01), np.logaddexp(s10, s11))
        expected_type = np.bincount(token, weights=p, minlength=n_types)
        expected = np.array([p.sum(), p[starts].sum(), np.exp(s01 - z).sum(),
                             np.exp(s10 - z).sum(), np.exp(s11 - z).sum()])
        miss = (observed_type - expected_type)[rows]
        grad = np.concatenate([observed - expected, np.bincount(cols, weights=miss, minlength=len(kept))])
        grad = grad / max(1.0, tag.sum()) - l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    crf.bias, crf.first, crf.enter, crf.leave, crf.stay = (float(x) for x in theta[:5])
    crf.weights = {f: float(x) for f, x in zip(kept, theta[5:]) if abs(x) > 1e-6}
    e = (crf.bias + np.bincount(rows, weights=theta[5:][cols], minlength=n_types))[token]
    log_sum, top = evidence(sigmoid(crf.logits(e, starts, lengths)), first, counts)
    crf.score = _logistic(np.column_stack([np.ones(len(y)), log_sum, top]), y.astype(float))
    return crf


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.05, rounds: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    beta, penalty = np.zeros(x.shape[1]), l2 * np.eye(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ beta)
        hess = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hess, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def train(docs: DataFrame, labels: DataFrame, **bounds) -> Crf:
    got = training_sample(docs, labels, **bounds).select("text", "toxic").toPandas()
    return fit(got["text"].tolist(), got["toxic"].tolist())


# --- scoring --------------------------------------------------------------
class Emissions(dict):
    """word -> emission, made when first asked for; chain ends are marked by
    adding ``END``.  Forgets everything when it holds ``most`` words."""

    END = 1e6

    def __init__(self, crf: Crf, most: int = 150_000):
        super().__init__()
        self.crf, self.most = crf, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        value = self.crf.emission(word) + (self.END if ends_chain(word) else 0.0)
        self[word] = value
        return value


class Scorer:
    """Scores texts batch by batch."""

    def __init__(self, crf: Crf):
        self.crf, self.emissions = crf, Emissions(crf)

    def __call__(self, texts: list[str]):
        crf = self.crf
        words = [tokens(t) for t in texts]
        counts = np.array([len(w) for w in words], dtype=np.int64)
        first = np.cumsum(counts) - counts
        e = np.fromiter(map(self.emissions.__getitem__, chain.from_iterable(words)),
                        dtype=np.float64, count=int(counts.sum()))
        ends = e > Emissions.END / 2
        e[ends] -= Emissions.END
        starts, lengths = chains(ends, first)
        p = sigmoid(crf.logits(e, starts, lengths))
        log_sum, top = evidence(p, first, counts)
        spans = []
        for t, a, n, best in zip(texts, first, counts, top):
            if best < 0.5:
                spans.append([])
                continue
            at, own = 0, []
            for w, q in zip(words[len(spans)], p[a:a + n]):
                end = at + len(w)
                if q >= 0.5:
                    body = _WORD.search(w)
                    if body:
                        own.append({"start": at + body.start(), "end": at + body.end()})
                at = end if w.endswith("\n") else end + 1
            spans.append(own)
        return sigmoid(crf.document_logit(log_sum, top)), spans


SCORED = "score double, predicted int, toxic_spans array<struct<start:int,end:int>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def score_documents(docs: DataFrame, crf: Crf, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of every document with score, predicted and
    toxic_spans."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(crf)  # at most MAX_FEATURES weights
    wanted = list(dict.fromkeys([*keep, text_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(forget=True)  # a worker may still hold what another stage kept
        scorer = Scorer(model.value)
        for batch in slices(batches, text_col, UNIT_BYTES):
            score, spans = scorer(texts_of(batch.column(wanted.index(text_col))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(wanted.index(k)) for k in keep), pa.array(score),
                 pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, type=SPANS)],
                names=[*keep, "score", "predicted", "toxic_spans"])
        del scorer
        release()

    src = docs.select(*wanted)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for k in keep
                       for f in src.schema if f.name == k)
    return src.mapInArrow(run, f"{schema}, {SCORED}")


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
