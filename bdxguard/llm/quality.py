"""Quality classifier from weak labels: no given label is used.

1. Overlapping heuristic labellers look at each text and vote good, bad or abstain (``LABELLERS``).
2. Expectation-maximisation over the counts of vote patterns estimates, per labeller, how often it votes what on
   good and on bad texts, and the share of good texts (``estimate``).  The counts cover all documents; there are at
   most ``3 ** len(LABELLERS)`` patterns, however many documents.
3. The posterior of each document's pattern is a soft label.  A hashed linear scorer learns from the soft labels of a
   bounded sample (``TRAIN_DOCS``, by a hash of the ids) and generalises to what no labeller voted on.
4. It scores every whole text.

Texts without words: all labellers vote bad, the score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import binary_array, column, slices, text_view
from .words import mix, span_hashes, word_spans

BAD, GOOD, ABSTAIN = 0, 1, 2
HASH_BITS = 14
TRAIN_DOCS = 12000
EPOCHS = 6
BATCH = 64
THRESHOLD = 0.5
#: Re-used words are counted in equal blocks of at most so many words, as their share grows with the length of ordinary prose.
BLOCK_WORDS = 3000

_KIND = np.zeros(256, np.uint8)  # 0 other ASCII, 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 symbol, 6 beyond ASCII
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[np.frombuffer(b".,;:'\"-()?", np.uint8)] = 4
_KIND[np.frombuffer(b"!#$%&*+/<=>@[\\]^_`{|}~", np.uint8)] = 5
_KIND[128:] = 6


@dataclass
class Measures:
    """Figures of each text, from its whole text."""

    words: np.ndarray
    repeats: np.ndarray  # share of words equal to the one before
    again: np.ndarray  # share of words that occurred before in their block of the text
    upper: np.ndarray  # share of upper case among ASCII letters
    symbols: np.ndarray  # share of symbols among bytes that are not white space
    marked: np.ndarray  # share of words that end with a symbol or are one
    length: np.ndarray  # mean bytes of a word
    sentences: np.ndarray  # sentence marks per word


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def measure(data: np.ndarray, offsets: np.ndarray) -> tuple[Measures, dict[str, np.ndarray]]:
    """Measures of each text, and word by word what they were made of."""
    starts, ends, counts = word_spans(data, offsets)
    doc = np.repeat(np.arange(len(counts)), counts)
    hashes = span_hashes(data, starts, ends)
    kind = _KIND[data]
    first = np.zeros(len(starts), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    same = np.zeros(len(starts), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same &= ~first
    seen = np.ones(len(starts), bool)
    again = np.ones(len(starts), bool)
    if len(starts):
        order = np.lexsort((np.arange(len(starts)), hashes, doc))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        seen[order[fresh]] = False
        place = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
        block = (place * np.repeat(-(-counts // BLOCK_WORDS), counts) // counts[doc])[order]
        fresh[1:] |= block[1:] != block[:-1]
        again[order[fresh]] = False
    last, head = (kind[ends - 1], kind[starts]) if len(starts) else (np.zeros(0, np.uint8),) * 2
    n = np.maximum(counts, 1)
    by_doc = lambda flags: np.bincount(doc, flags, minlength=len(counts)) / n
    upper, lower, symbol = (_per_text(kind == k, offsets) for k in (2, 1, 5))
    solid = np.bincount(doc, ends - starts, minlength=len(counts))
    found = Measures(counts, by_doc(same), by_doc(again), upper / np.maximum(upper + lower, 1), symbol / np.maximum(solid, 1),
                     by_doc(last == 5), solid / n, by_doc(last == 4))
    return found, {"doc": doc, "hashes": hashes, "same": same, "seen": seen, "head": head, "last": last, "size": ends - starts}


def _none(m: Measures) -> np.ndarray:
    return np.zeros(len(m.words), bool)


#: Labellers: name -> (votes bad where, votes good where); elsewhere they abstain, and bad wins.  Most look for one
#: kind of fault and say nothing of a text without it; the last two know what ordinary prose looks like.
LABELLERS = {
    "stutter": (lambda m: m.repeats > 0.2, _none),
    "few_words_used": (lambda m: (m.again > 0.85) & (m.words >= 30), _none),
    "shouting": (lambda m: m.upper > 0.5, _none),
    "symbols": (lambda m: m.symbols > 0.08, _none),
    "marked_words": (lambda m: m.marked > 0.2, _none),
    "odd_words": (lambda m: (m.length > 14) | (m.length < 2), _none),
    "sentences": (lambda m: (m.sentences < 0.01) & (m.words >= 40), lambda m: (m.sentences > 0.04) & (m.sentences < 0.6) & (m.repeats < 0.05)),
    "plain": (_none, lambda m: (m.upper < 0.2) & (m.symbols < 0.02) & (m.marked < 0.05) & (m.repeats < 0.05)),
}
#: Prior of the estimate, as a share of all documents: a labeller calls this part of the good texts bad.
PRIOR_WEIGHT, PRIOR_WRONG = 0.2, 0.002


def votes(m: Measures) -> np.ndarray:
    """Votes of all labellers on each text (n x labellers); a text without words is bad to all."""
    out = np.full((len(m.words), len(LABELLERS)), ABSTAIN, np.uint8)
    for k, (bad, good) in enumerate(LABELLERS.values()):
        out[good(m), k] = GOOD
        out[bad(m) | (m.words == 0), k] = BAD
    return out


def pattern_codes(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


def pattern_votes(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(len(LABELLERS))[None]) % 3


@dataclass
class Weak:
    """What expectation-maximisation found: P(vote | class) per labeller and the share of each class."""

    table: np.ndarray  # (labellers, 2 classes, 3 votes)
    share: np.ndarray  # (bad, good)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """P(good | votes) of each row of votes."""
        logs = np.log(self.share)[None] + sum(np.log(self.table[k][:, v[:, k]]).T for k in range(v.shape[1]))
        return 1.0 / (1.0 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> Weak:
    """Accuracies of the labellers from counts of their vote patterns, started at the majority vote.

    A single bad vote outweighs good votes in the start, as a heuristic only looks for one kind of fault; for the
    same reason the prior holds that a labeller seldom calls a good text bad.
    """
    v = pattern_votes(codes)
    good = np.where((v == BAD).any(axis=1), 0.1, 0.9)
    model = Weak(np.full((len(LABELLERS), 2, 3), 1 / 3), np.array([0.5, 0.5]))
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        share = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        table = np.stack([[[weight[c, v[:, k] == x].sum() + 0.5 for x in range(3)] for c in (0, 1)] for k in range(v.shape[1])])
        sure = PRIOR_WEIGHT * counts.sum()
        rest = table[:, 1, 1:] / table[:, 1, 1:].sum(axis=1, keepdims=True)
        table[:, 1, BAD] += sure * PRIOR_WRONG
        table[:, 1, 1:] += sure * (1 - PRIOR_WRONG) * rest
        model = Weak(table / table.sum(axis=2, keepdims=True), share)
        new = model.posterior(v)
        if np.abs(new - good).max(initial=0) < 1e-6:
            break
        good = new
    return model


def features(m: Measures, w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of each text: text index, slot, value. Values of a text have length one."""
    n = len(m.words)
    size = np.minimum(w["size"], 31) // 2
    base = w["head"].astype(np.uint64) * np.uint64(7) + w["last"].astype(np.uint64)
    shape = (base * np.uint64(16) + size.astype(np.uint64)) * np.uint64(4) + w["same"].astype(np.uint64) * np.uint64(2) + w["seen"].astype(np.uint64)
    pair = np.zeros_like(base)
    pair[1:] = base[1:] * np.uint64(64) + base[:-1]
    parts = [(shape, 1), (base, 2), (w["same"].astype(np.uint64), 3), (w["seen"].astype(np.uint64), 4), (pair, 5)]
    codes = np.concatenate([mix(p, seed) >> np.uint64(64 - HASH_BITS) for p, seed in parts]) if n else np.zeros(0, np.uint64)
    cell, count = np.unique(np.tile(w["doc"].astype(np.uint64), len(parts)) << np.uint64(HASH_BITS) | codes, return_counts=True)
    doc, slot = (cell >> np.uint64(HASH_BITS)).astype(np.int64), (cell & np.uint64((1 << HASH_BITS) - 1)).astype(np.int32)
    value = count / np.maximum(m.words, 1)[doc]
    norm = np.sqrt(np.bincount(doc, value * value, minlength=n))
    return doc, slot, value / np.maximum(norm, 1e-12)[doc]


@dataclass
class Scorer:
    bias: float
    weights: np.ndarray

    def scores(self, doc: np.ndarray, slot: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        total = self.bias + np.bincount(doc, self.weights[slot] * value, minlength=n)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -60, 60)))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], soft: np.ndarray, seed: int = 3) -> Scorer:
    """Logistic regression on soft labels by AdaGrad; rows are (slots, values)."""
    rng = np.random.default_rng(seed)
    weights, g2, bias, b2 = np.zeros(1 << HASH_BITS), np.full(1 << HASH_BITS, 1e-6), 0.0, 1e-6
    for _ in range(EPOCHS if rows else 0):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            doc = np.repeat(np.arange(len(pick)), [len(rows[i][0]) for i in pick])
            slot, value = (np.concatenate([rows[i][k] for i in pick]) for k in (0, 1))
            total = bias + np.bincount(doc, weights[slot] * value, minlength=len(pick))
            error = 1.0 / (1.0 + np.exp(-np.clip(total, -60, 60))) - soft[pick]
            touched, back = np.unique(slot, return_inverse=True)
            g = np.bincount(back, error[doc] * value) / len(pick) + 1e-5 * weights[touched]
            g2[touched] += g * g
            weights[touched] -= 0.3 * g / np.sqrt(g2[touched])
            gb = error.mean()
            b2 += gb * gb
            bias -= 0.3 * gb / np.sqrt(b2)
    return Scorer(bias, weights)


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``score`` (0 to 1, good), ``predicted`` (1 good), ``kept`` and ``weak_label`` (posterior).

    Nulls and texts without words score 0.  Repeated rows score alike.  Labels, language, source and ids are no inputs.
    An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("__t"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__t"):
                m, _ = measure(*text_view(column(part, "__t")))
                yield pa.record_batch({"code": pa.array(pattern_codes(votes(m)), pa.int64())})

    patterns = sorted(tuple(r) for r in rows.select("__t").mapInArrow(vote, "code long").groupBy("code").count().collect())
    weak = estimate(np.array([p[0] for p in patterns], np.int64), np.array([p[1] for p in patterns], float))

    chosen = rows.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(31)), "doc_id").limit(TRAIN_DOCS)

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__t"):
                m, w = measure(*text_view(column(part, "__t")))
                doc, slot, value = features(m, w)
                per = np.bincount(doc, minlength=part.num_rows)
                yield pa.record_batch({"doc_id": column(part, "doc_id"), "soft": pa.array(weak.posterior(votes(m))),
                                       "slots": binary_array(slot, per), "values": binary_array(value.astype(np.float32), per)})

    kind = dict(docs.dtypes)["doc_id"]
    found = rows.join(F.broadcast(chosen), "doc_id", "left_semi").mapInArrow(examples, f"doc_id {kind}, soft double, slots binary, values binary")
    found = sorted((r["doc_id"], r["soft"], bytes(r["slots"]), bytes(r["values"])) for r in found.collect())
    scorer = fit_scorer([(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in found], np.array([r[1] for r in found]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__t"):
                m, w = measure(*text_view(column(part, "__t")))
                made = np.where(m.words > 0, scorer.scores(*features(m, w), part.num_rows), 0.0)
                yield pa.record_batch({"doc_id": column(part, "doc_id"), "score": pa.array(made), "predicted": pa.array((made >= threshold).astype(np.int32)),
                                       "kept": pa.array(made >= threshold), "weak_label": pa.array(weak.posterior(votes(m)))})

    return rows.mapInArrow(score, f"doc_id {kind}, score double, predicted int, kept boolean, weak_label double")
