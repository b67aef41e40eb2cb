"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

A text is read as the bytes of its lower-cased UTF-8, in segments of at most
``SEGMENT`` bytes of about equal length; every segment is read in both
directions from a zero state.  At each byte both states give a distribution over
the languages, so every position is labelled; a document's probabilities are the
mean over all its positions.

Training (see ``train``): at most ``TRAIN_DOCS`` documents a language, chosen by
a hash of their id, each giving ``TRAIN_SEGMENTS`` segments of ``TRAIN_BYTES``
bytes.  This bounded sample fits the weights; prediction reads all of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .arrow import column, slices, text_view

SEGMENT = 128
STATE = 8
TRAIN_DOCS = 800
TRAIN_SEGMENTS = 4
TRAIN_BYTES = 64
TRAIN_STEPS = 500
BATCH = 128
SLICE = 1 << 19
UNDETERMINED = "und"


@dataclass
class Direction:
    """One reading direction: for update, reset and candidate a table over bytes (input weight + bias) and a state matrix."""

    table: list[np.ndarray]  # 3 of (256, STATE)
    state: list[np.ndarray]  # 3 of (STATE, STATE)


@dataclass
class Model:
    languages: list[str]
    reads: list[Direction]  # forwards, backwards
    out: np.ndarray  # (2 * STATE, languages)
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run_states(d: Direction, bytes_: np.ndarray, live: np.ndarray | None) -> np.ndarray:
    """States (T, N, STATE) after each byte of N segments (bytes_: T x N); where ``live`` is 0 the state stays zero."""
    steps, n = bytes_.shape
    out = np.empty((steps, n, STATE), np.float32)
    h = np.zeros((n, STATE), np.float32)
    z, r, c, w = (np.empty((n, STATE), np.float32) for _ in range(4))
    (tz, tr, tc), (uz, ur, uc) = d.table, d.state
    tz, tr, uz, ur = tz * 0.5, tr * 0.5, uz * np.float32(0.5), ur * np.float32(0.5)
    for t in range(steps):
        b = bytes_[t]
        for gate, table, u in ((z, tz, uz), (r, tr, ur)):
            np.take(table, b, axis=0, out=gate, mode="clip")
            np.matmul(h, u, out=w)
            gate += w
            np.tanh(gate, out=gate)
        r += 1.0
        r *= 0.5
        np.matmul(h, uc, out=w)
        w *= r
        np.take(tc, b, axis=0, out=c, mode="clip")
        c += w
        np.tanh(c, out=c)
        z += 1.0
        z *= 0.5
        np.subtract(h, c, out=w)
        w *= z
        h = np.add(c, w, out=out[t])
        if live is not None:
            h *= live[t][:, None]
    return out


def _probabilities(model: Model, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
    logits = ahead @ model.out[:STATE]
    logits += back @ model.out[STATE:]
    logits += model.bias
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


def label_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities of each text (n x languages) and how many of its positions each language wins."""
    n, k = len(offsets) - 1, len(model.languages)
    sums, wins = np.zeros((n, k)), np.zeros((n, k), np.int64)
    length = np.diff(offsets)
    pieces = -(-length // SEGMENT)
    doc = np.repeat(np.arange(n), pieces)
    part = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = offsets[doc] + part * length[doc] // np.maximum(pieces[doc], 1)
    size = offsets[doc] + (part + 1) * length[doc] // np.maximum(pieces[doc], 1) - begin
    width = max(1, SLICE // SEGMENT * 8 // max(k, 8))  # segments at once: fewer with many languages, so that memory stays the same
    for a in range(0, len(doc), width):
        d, s, m = doc[a:a + width], begin[a:a + width], size[a:a + width]
        steps = int(m.max())
        at = s[None] + np.arange(steps)[:, None]
        inside = np.arange(steps)[:, None] < m[None]
        bytes_ = data[np.minimum(at, len(data) - 1)].astype(np.intp)
        live = None if inside.all() else inside.astype(np.float32)
        ahead = run_states(model.reads[0], bytes_, live)
        back = run_states(model.reads[1], bytes_[::-1], None if live is None else live[::-1])[::-1]
        p = _probabilities(model, ahead.reshape(-1, STATE), np.ascontiguousarray(back).reshape(-1, STATE)).reshape(steps, len(d), k)
        best = p.argmax(axis=2)
        for c in range(k):
            sums[:, c] += np.bincount(d, (p[:, :, c] * inside).sum(axis=0), minlength=n)
            wins[:, c] += np.bincount(d, ((best == c) & inside).sum(axis=0), minlength=n).astype(np.int64)
    return sums / np.maximum(length, 1)[:, None], wins


# --- training -------------------------------------------------------------------------------------------------


def _forward(d: Direction, x: np.ndarray, live: np.ndarray) -> tuple:
    """States and what backpropagation needs, for x (T, N) bytes; where ``live`` is 0 the state stays zero."""
    steps, n = x.shape
    h = np.zeros((steps + 1, n, STATE))
    z, r, c, s = (np.zeros((steps, n, STATE)) for _ in range(4))
    for t in range(steps):
        z[t] = _sigmoid(d.table[0][x[t]] + h[t] @ d.state[0])
        r[t] = _sigmoid(d.table[1][x[t]] + h[t] @ d.state[1])
        s[t] = h[t] @ d.state[2]
        c[t] = np.tanh(d.table[2][x[t]] + r[t] * s[t])
        h[t + 1] = (c[t] + z[t] * (h[t] - c[t])) * live[t][:, None]
    return h, z, r, c, s


def _backward(d: Direction, x: np.ndarray, live: np.ndarray, saved: tuple, dh_out: np.ndarray) -> tuple[list, list]:
    """Gradients of tables and state matrices by backpropagation through time; dh_out: loss gradient of each state."""
    h, z, r, c, s = saved
    steps, n = x.shape
    pre = [np.zeros((steps, n, STATE)) for _ in range(3)]
    state = [np.zeros((STATE, STATE)) for _ in range(3)]
    dh = np.zeros((n, STATE))
    for t in range(steps - 1, -1, -1):
        dh = (dh + dh_out[t]) * live[t][:, None]
        dz = dh * (h[t] - c[t]) * z[t] * (1 - z[t])
        dc = dh * (1 - z[t]) * (1 - c[t] ** 2)
        ds = dc * r[t]
        dr = dc * s[t] * r[t] * (1 - r[t])
        for k, g in enumerate((dz, dr, dc)):
            pre[k][t] = g
        for k, g in enumerate((dz, dr, ds)):
            state[k] += h[t].T @ g
        dh = dh * z[t] + dz @ d.state[0].T + dr @ d.state[1].T + ds @ d.state[2].T
    tables = []
    flat = x.ravel()
    for g in pre:
        g = g.reshape(-1, STATE)
        tables.append(np.stack([np.bincount(flat, g[:, j], minlength=256) for j in range(STATE)], axis=1))
    return tables, state


def loss_and_gradients(model: Model, x: np.ndarray, y: np.ndarray, live: np.ndarray | None = None) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions of segments x (T, N) with labels y (N), and its gradients.

    ``live`` (T, N): 0 at the positions beyond the end of a shorter segment, which count for nothing.
    """
    steps, n = x.shape
    live = np.ones((steps, n)) if live is None else live
    ahead, back = _forward(model.reads[0], x, live), _forward(model.reads[1], x[::-1], live[::-1])
    both = np.concatenate([ahead[0][1:], back[0][1:][::-1]], axis=2)
    logits = both @ model.out + model.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    loss = -(np.log(p[:, np.arange(n), y] + 1e-12) * live).sum() / live.sum()
    p[:, np.arange(n), y] -= 1.0
    p *= live[:, :, None] / live.sum()
    g_out = np.tensordot(both, p, axes=([0, 1], [0, 1]))
    dh = p @ model.out.T
    t0, s0 = _backward(model.reads[0], x, live, ahead, dh[:, :, :STATE])
    t1, s1 = _backward(model.reads[1], x[::-1], live[::-1], back, dh[::-1, :, STATE:])
    return float(loss), [*t0, *s0, *t1, *s1, g_out, p.sum(axis=(0, 1))]


def weights(model: Model) -> list[np.ndarray]:
    return [*model.reads[0].table, *model.reads[0].state, *model.reads[1].table, *model.reads[1].state, model.out, model.bias]


def new_model(languages: list[str], rng: np.random.Generator) -> Model:
    def direction() -> Direction:
        tables = [rng.normal(0, 0.3, (256, STATE)) + (1.0 if k == 0 else 0.0) for k in range(3)]
        return Direction(tables, [rng.normal(0, 1 / np.sqrt(STATE), (STATE, STATE)) for _ in range(3)])

    return Model(languages, [direction(), direction()], rng.normal(0, 0.3, (2 * STATE, len(languages))), np.zeros(len(languages)))


def fit(segments: list[bytes], labels: list[str], steps: int = TRAIN_STEPS, seed: int = 7) -> Model:
    """Weights by Adam on balanced batches; shorter segments are masked beyond their end."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    size = np.array([len(s) for s in segments])
    longest = int(size.max())
    x = np.stack([np.frombuffer(s.ljust(longest, b"\0"), np.uint8) for s in segments]).astype(np.intp)
    y = np.array([languages.index(v) for v in labels])
    members = [np.flatnonzero(y == k) for k in range(len(languages))]
    model = new_model(languages, rng)
    params = weights(model)
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, (steps if len(languages) > 1 else 0) + 1):
        rows = np.concatenate([rng.choice(k, BATCH // len(members) + 1) for k in members])
        own = size[rows]
        _, grads = loss_and_gradients(model, x[rows, :own.max()].T, y[rows], (np.arange(own.max())[:, None] < own[None]).astype(float))
        norm = np.sqrt(sum((g * g).sum() for g in grads))
        rate = 0.02 * (0.5 * (1 + np.cos(np.pi * step / steps)) + 0.02)
        for i, (p, g) in enumerate(zip(params, grads, strict=True)):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    for d in model.reads:
        d.table, d.state = [t.astype(np.float32) for t in d.table], [u.astype(np.float32) for u in d.state]
    model.out, model.bias = model.out.astype(np.float32), model.bias.astype(np.float32)
    return model


def segments_of(raw: bytes) -> list[bytes]:
    """At most TRAIN_SEGMENTS segments of TRAIN_BYTES spread over a text; a shorter text is one segment."""
    room = len(raw) - TRAIN_BYTES
    if room < 0:
        return [raw] if raw else []
    at = range(0, room + 1, max(TRAIN_BYTES, room // TRAIN_SEGMENTS or 1))
    return [raw[a:a + TRAIN_BYTES] for a in list(at)[:TRAIN_SEGMENTS]]


def train(docs: DataFrame) -> Model | None:
    """Fit on documents with an id, a text that has a letter, and a language, whose crc32 of the id is not 0 modulo 5.

    None if there is no such document.  At most TRAIN_DOCS ids of each language are taken, by a hash of the id; one row
    of each (the smallest by language and segments, if ids repeat) gives segments, and only these reach the driver: at
    most TRAIN_DOCS * TRAIN_SEGMENTS * TRAIN_BYTES bytes a language.  The hash first thins each language to about twice
    that many, so ranking them needs no more rows, however many documents the language has.
    """
    able = docs.where("doc_id is not null and lang is not null").where(~held_out()).where(F.col("text").rlike(r"\p{L}"))
    order, parts = F.xxhash64("doc_id", F.lit(17)), 1 << 40
    counts = materialize(able.groupBy("lang").count(), "languages")
    thinned = (able.select("doc_id", "lang").join(counts, "lang")
               .where(F.pmod(order, F.lit(parts)) < F.least(F.lit(parts), F.lit(2 * TRAIN_DOCS) * (F.lit(parts) / F.col("count") + 1))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))
    chosen = thinned.select("lang", "doc_id").distinct().withColumn("r", rank).where(F.col("r") <= TRAIN_DOCS).select("doc_id").distinct()
    texts = (able.join(F.broadcast(chosen), "doc_id", "left_semi")
             .select("doc_id", "lang", F.lower("text").cast("binary").alias("bytes")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [segments_of(raw or b"") for raw in column(batch, "bytes").to_pylist()]
            yield pa.record_batch({"lang": column(batch, "lang"), "doc_id": column(batch, "doc_id"), "segments": pa.array(found, pa.list_(pa.binary()))})

    cuts = texts.mapInArrow(cut, "lang string, doc_id long, segments array<binary>").where(F.size("segments") > 0)
    kept = cuts.groupBy("doc_id").agg(F.min(F.struct("lang", "segments")).alias("x")).select("doc_id", "x.*")
    rows = sorted((r["lang"], r["doc_id"], [bytes(s) for s in r["segments"]]) for r in kept.collect())
    return fit([s for r in rows for s in r[2]], [r[0] for r in rows for _ in r[2]]) if rows else None


def held_out():
    """Documents never learned from: crc32 of the id as text is 0 modulo 5 (a null id: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """Kept columns with ``lang_pred``, ``score`` (its mean probability), ``share`` (of positions it wins) and ``positions``.

    ``lang_pred`` is ``und`` with score 0 where the text is null, has no letter, or no model could be trained.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    d = docs.select(*keep, F.when(letters, F.lower("text")).alias("__t"))
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.select(*keep).dtypes] + ["lang_pred string, score double, share double, positions long"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__t", SLICE):
                data, offsets = text_view(column(part, "__t"))
                length = np.diff(offsets)
                if model is None:
                    length = np.zeros_like(length)
                    p, wins, names = np.zeros((len(length), 1)), np.zeros((len(length), 1), np.int64), [UNDETERMINED]
                else:
                    p, wins = label_texts(model, data, offsets)
                    names = model.languages
                best = p.argmax(axis=1)
                one = np.arange(len(best))
                found = length > 0
                yield pa.RecordBatch.from_arrays(
                    [*[column(part, c) for c in keep],
                     pa.array([names[b] if f else UNDETERMINED for b, f in zip(best, found, strict=True)], pa.string()),
                     pa.array(np.where(found, np.clip(p[one, best], 0, 1), 0.0)),
                     pa.array(np.where(found, wins[one, best] / np.maximum(length, 1), 0.0)), pa.array(length)],
                    names=[*keep, "lang_pred", "score", "share", "positions"])

    return d.mapInArrow(rows, schema)
