"""Toxicity: a factorization machine over hashed terms.

Terms of a text: its distinct words and, so that endings do not hide a stem, the
first 4, 5 and 6 bytes of each word, hashed to ``2**HASH_BITS`` slots.  The score
is ``sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>)`` over the text's slots.  The
pair term learns combinations whose meaning is more (or less) than the sum of
their words, such as an insult next to the mention of a group.

Linear weights are learned by FTRL-proximal, whose L1 term keeps the thousands of
neutral terms of a long text at exactly zero; the factors by AdaGrad with L2.
Two kinds of slots take part: those found in ``MIN_DOCS`` training documents and more
(or less) often in toxic ones by ``MIN_Z`` standard errors, and those of pairs whose
combination tells more than both alone, by ``PAIR_Z`` standard errors, whatever each
does by itself (among the ``PAIR_SLOTS`` most frequent slots).  A slot without evidence
never moves a score, however long the text.

Training (see ``train``): at most ``TRAIN_POSITIVE`` toxic and ``TRAIN_NEGATIVE``
other labelled documents by a hash of their ids, weighted back to the shares
among all labelled documents.  Scoring reads the whole of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .arrow import binary_array, column, slices, text_view
from .words import span_hashes, word_spans

HASH_BITS = 20
PREFIXES = (4, 5, 6)
FACTORS = 6
TRAIN_POSITIVE = 3000
TRAIN_NEGATIVE = 5000
MIN_DOCS = 3
MIN_Z = 4.0
#: Pair test: standard errors, documents with each combination, least difference of rates, most frequent slots compared.
PAIR_Z, PAIR_DOCS, PAIR_EFFECT, PAIR_SLOTS = 7.0, 20, 0.2, 1024
#: Start of the factors of paired slots: large enough to leave the saddle that balanced terms start on.
PAIR_START = 0.3
EPOCHS = 25
BATCH = 64
THRESHOLD = 0.3
#: Bytes of text that a task hashes at once; its arrays take some forty times that.
TEXT_BYTES = 1 << 18
#: Bytes at the ends of words that are not part of a term (fixed values, ASCII punctuation).
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TRIM = np.zeros(256, bool)
_TRIM[np.frombuffer(PUNCTUATION, np.uint8)] = True


def _trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans without punctuation at their ends (a word of punctuation alone becomes empty)."""
    starts, ends = starts.copy(), ends.copy()
    move = np.flatnonzero(_TRIM[data[starts]]) if len(starts) else starts
    while len(move):
        starts[move] += 1
        move = move[starts[move] < ends[move]]
        move = move[_TRIM[data[starts[move]]]]
    move = np.flatnonzero((starts < ends) & _TRIM[data[np.maximum(ends - 1, 0)]]) if len(starts) else starts
    while len(move):
        ends[move] -= 1
        move = move[starts[move] < ends[move]]
        move = move[_TRIM[data[ends[move] - 1]]]
    return starts, ends


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct slots of every text, flat, and how many each has."""
    starts, ends, counts = word_spans(data, offsets)
    doc = np.repeat(np.arange(len(counts)), counts)
    starts, ends = _trimmed(data, starts, ends)
    some = starts < ends
    starts, ends, doc = starts[some], ends[some], doc[some]
    found, owner = [span_hashes(data, starts, ends)], [doc]
    for k in PREFIXES:
        longer = ends - starts >= k
        found.append(span_hashes(data, starts[longer], starts[longer] + k) * np.uint64(2 * k + 1))
        owner.append(doc[longer])
    code = (np.concatenate(owner).astype(np.uint64) << np.uint64(HASH_BITS)) | (np.concatenate(found) >> np.uint64(64 - HASH_BITS))
    code = np.unique(code)
    per = np.bincount((code >> np.uint64(HASH_BITS)).astype(np.int64), minlength=len(counts))
    return (code & np.uint64((1 << HASH_BITS) - 1)).astype(np.int32), per


@dataclass
class Machine:
    """Weights of the used slots only: ``slot[s]`` is the row of slot s, 0 for all unused ones."""

    bias: float
    slot: np.ndarray  # (2**HASH_BITS,) int32
    linear: np.ndarray  # (used + 1,)
    factors: np.ndarray  # (used + 1, FACTORS)

    def scores(self, flat: np.ndarray, per: np.ndarray) -> np.ndarray:
        rows = self.slot[flat]
        doc = np.repeat(np.arange(len(per)), per)
        used = rows > 0
        rows, doc = rows[used], doc[used]
        total = self.bias + np.bincount(doc, self.linear[rows], minlength=len(per))
        for k in range(self.factors.shape[1]):
            f = self.factors[rows, k]
            total += 0.5 * (np.bincount(doc, f, minlength=len(per)) ** 2 - np.bincount(doc, f * f, minlength=len(per)))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -60, 60)))


def associated(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Slots whose share among the toxic and the other documents differs by MIN_Z standard errors or more."""
    seen = [np.bincount(np.concatenate([*(d for d, y in zip(docs, labels, strict=True) if y == k), np.zeros(0, np.int32)]), minlength=1 << HASH_BITS)
            for k in (0, 1)]
    n = [max(int((labels == k).sum()), 1) for k in (0, 1)]
    both = (seen[0] + seen[1]) / (n[0] + n[1])
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n[0] + 1 / n[1]))
    return np.flatnonzero((seen[0] + seen[1] >= MIN_DOCS) & (np.abs(seen[1] / n[1] - seen[0] / n[0]) >= MIN_Z * error))


def paired(docs: list[np.ndarray], labels: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Slots among ``frequent`` in a pair that interacts: with the toxic rates of documents that hold both, one or none,

        both - first only - second only + none

    is not zero by PAIR_Z standard errors (and PAIR_EFFECT), though each slot may be as common in either class.
    """
    n = len(frequent)
    if not n or not len(docs):
        return np.zeros(0, np.int64)
    place = np.full(1 << HASH_BITS, -1)
    place[frequent] = np.arange(n)
    holds = np.zeros((len(docs), n), np.float32)
    for i, d in enumerate(docs):
        at = place[d]
        holds[i, at[at >= 0]] = 1
    y = labels.astype(np.float32)
    both, both_toxic = holds.T @ holds, (holds * y[:, None]).T @ holds
    one, one_toxic = np.diag(both), np.diag(both_toxic)
    cells = [(both, both_toxic), (one[:, None] - both, one_toxic[:, None] - both_toxic), (one[None] - both, one_toxic[None] - both_toxic),
             (len(docs) - one[:, None] - one[None] + both, y.sum() - one_toxic[:, None] - one_toxic[None] + both_toxic)]
    effect, spread, enough = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32), np.ones((n, n), bool)
    for (count, toxic), sign in zip(cells, (1, -1, -1, 1), strict=True):
        enough &= count >= PAIR_DOCS
        rate = (toxic + 0.5) / (np.maximum(count, 1) + 1)
        effect += sign * rate
        spread += rate * (1 - rate) / np.maximum(count, 1)
    hit = enough & (np.abs(effect) >= np.maximum(PAIR_Z * np.sqrt(spread), PAIR_EFFECT))
    return frequent[hit.any(axis=1)]


def fit(docs: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 11,
        used: np.ndarray | None = None, frequent: np.ndarray | None = None) -> Machine:
    """Learn from slot arrays, 0/1 labels and example weights.

    ``used``: the slots that take part by themselves, ``frequent``: those whose pairs are tested, if already known.
    """
    rng = np.random.default_rng(seed)
    used = associated(docs, labels) if used is None else used
    if frequent is None:
        seen = np.bincount(np.concatenate([*docs, np.zeros(0, np.int32)]), minlength=1 << HASH_BITS)
        frequent = np.sort(np.argsort(-seen, kind="stable")[:PAIR_SLOTS])
        frequent = frequent[seen[frequent] >= PAIR_DOCS]
    pairs = paired(docs, labels, np.asarray(frequent))
    used = np.union1d(used, pairs).astype(np.int64)
    slot = np.zeros(1 << HASH_BITS, np.int32)
    slot[used] = np.arange(1, len(used) + 1)
    rows = [r[r > 0] for r in (slot[d] for d in docs)]
    n = len(used) + 1
    share = float(np.clip((weights * labels).sum() / max(weights.sum(), 1e-9), 1e-4, 1 - 1e-4))
    bias = float(np.log(share / (1 - share)))
    linear, factors = np.zeros(n), rng.normal(0, 0.02, (n, FACTORS))
    factors[slot[pairs]] = rng.normal(0, PAIR_START, (len(pairs), FACTORS))
    factors[0] = 0
    alpha, beta, l1, l2 = 0.15, 1.0, 0.6, 0.5  # FTRL-proximal
    z, g2 = np.zeros(n), np.zeros(n)
    f2, bias2 = np.full((n, FACTORS), 1e-2), 1e-2
    for _ in range(epochs if len(docs) else 0):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            per = np.array([len(rows[i]) for i in pick])
            at = np.concatenate([rows[i] for i in pick])
            doc = np.repeat(np.arange(len(pick)), per)
            v = factors[at]
            sums = np.stack([np.bincount(doc, v[:, k], minlength=len(pick)) for k in range(FACTORS)], axis=1)
            squares = np.bincount(doc, (v * v).sum(axis=1), minlength=len(pick))
            total = bias + np.bincount(doc, linear[at], minlength=len(pick)) + 0.5 * ((sums ** 2).sum(axis=1) - squares)
            error = (1.0 / (1.0 + np.exp(-np.clip(total, -60, 60))) - labels[pick]) * weights[pick]
            touched, back = np.unique(at, return_inverse=True)
            g = np.bincount(back, error[doc])
            old = linear[touched]
            sigma = (np.sqrt(g2[touched] + g * g) - np.sqrt(g2[touched])) / alpha
            z[touched] += g - sigma * old
            g2[touched] += g * g
            zt = z[touched]
            linear[touched] = np.where(np.abs(zt) <= l1, 0.0, -(zt - np.sign(zt) * l1) / ((beta + np.sqrt(g2[touched])) / alpha + l2))
            gv = error[doc, None] * (sums[doc] - v)
            gv = np.stack([np.bincount(back, gv[:, k]) for k in range(FACTORS)], axis=1) + 2e-3 * factors[touched]
            f2[touched] += gv * gv
            factors[touched] -= 0.02 * gv / np.sqrt(f2[touched])
            gb = error.sum()
            bias2 += gb * gb
            bias -= 0.05 * gb / np.sqrt(bias2)
    linear[0], factors[0] = 0, 0
    return Machine(bias, slot, linear.astype(np.float32), factors.astype(np.float32))


def held_out():
    """Documents never learned from: crc32 of the id as text is 2 modulo 4 (a null id: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Learn from the labelled documents that are not held out; without any, every score is one half.

    A label is a row with an id and ``toxic`` 0 or 1; an id with several labels counts as toxic if any says so.
    The ids of the bounded sample are chosen from the labels table, and one row of each id is learned from (the
    smallest by its slots, if ids repeat).  Spark counts the slots of their texts, and only the slots that take part or
    whose pairs are tested reach the driver.
    """
    known = (labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id", F.lit(23))
    chosen = (known.where("toxic = 1").orderBy(order, "doc_id").limit(TRAIN_POSITIVE)
              .unionByName(known.where("toxic = 0").orderBy(order, "doc_id").limit(TRAIN_NEGATIVE)))
    texts = docs.select("doc_id", F.col("text").alias("__t")).join(F.broadcast(chosen), "doc_id")

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__t", TEXT_BYTES):
                flat, per = terms(*text_view(column(part, "__t")))
                ends = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
                yield pa.record_batch({"doc_id": column(part, "doc_id"), "toxic": column(part, "toxic"),
                                       "slots": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))})

    sample = texts.select("doc_id", "toxic", "__t").mapInArrow(slots, "doc_id long, toxic int, slots array<int>")
    sample = materialize(sample.groupBy("doc_id").agg(F.min(F.struct("toxic", "slots")).alias("x")).select("doc_id", "x.*"), "toxicity-sample")
    used, frequent = (np.array(x, np.int32) for x in _slots_of(sample))
    wanted = np.union1d(used, frequent)

    def only_used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "slots")
            flat = lists.flatten().to_numpy()
            keep = np.isin(flat, wanted)
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            yield pa.record_batch({"doc_id": column(batch, "doc_id"), "toxic": column(batch, "toxic"),
                                   "slots": binary_array(flat[keep], np.bincount(doc[keep], minlength=batch.num_rows))})

    found = sorted((r["doc_id"], r["toxic"], bytes(r["slots"])) for r in
                   sample.mapInArrow(only_used, "doc_id long, toxic int, slots binary").collect())
    y = np.array([r[1] for r in found], float)
    share = [(total.get(k, 0) / max(sum(total.values()), 1)) / max((y == k).mean(), 1e-9) if len(y) else 1.0 for k in (0, 1)]
    return fit([np.frombuffer(r[2], np.int32) for r in found], y, np.where(y == 1, share[1], share[0]), used=used, frequent=frequent)


def _slots_of(sample: DataFrame) -> tuple[list[int], list[int]]:
    """The slots ``associated`` finds and the PAIR_SLOTS most frequent ones, counted by Spark over the sample's (toxic, slots) rows."""
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = (float(max(n.get(k, 0), 1)) for k in (0, 1))
    seen = materialize(sample.select("toxic", F.explode("slots").alias("slot")).groupBy("slot")
                       .agg(F.count_if(F.col("toxic") == 0).alias("s0"), F.count_if(F.col("toxic") == 1).alias("s1")), "slots")
    total = F.col("s0") + F.col("s1")
    both = total / (n0 + n1)
    error = F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / n0 + 1 / n1))
    some = seen.where((total >= MIN_DOCS) & (F.abs(F.col("s1") / n1 - F.col("s0") / n0) >= MIN_Z * error))
    most = seen.where(total >= PAIR_DOCS).orderBy(total.desc(), "slot").limit(PAIR_SLOTS)
    return sorted(r[0] for r in some.select("slot").collect()), sorted(r[0] for r in most.select("slot").collect())


def score(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """Kept columns with ``score``; a null or empty text scores the bias alone, like a text without known terms."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.select(*keep).dtypes] + ["score double"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__t", TEXT_BYTES):
                made = shared.value.scores(*terms(*text_view(column(part, "__t"))))
                yield pa.RecordBatch.from_arrays([*[column(part, c) for c in keep], pa.array(made, pa.float64())], names=[*keep, "score"])

    return docs.select(*keep, F.col("text").cast("string").alias("__t")).mapInArrow(rows, schema)
