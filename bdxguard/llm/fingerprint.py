"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low-order bits.

Every 5-word shingle is hashed once.  Its high bits choose one of ``BINS`` bins,
the rest compete for the bin's minimum.  An empty bin takes the minimum of
another bin, chosen by a hash of (bin, attempt) until that bin was not empty
(optimal densification), so two equal sets stay equal.  Of each minimum only the
lowest ``BITS`` bits are stored: one hex digit a bin.  Two unrelated minima then
agree with chance ``1 / 2**BITS``; ``likeness`` takes this bias out.

A text without words has the empty fingerprint ``""``.  Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import column, slices, text_view
from .words import mix, shingle_hashes, word_hashes

BINS = 512
BITS = 4
SHINGLE_WORDS = 5
_BIN_SHIFT = np.uint64(64 - (BINS - 1).bit_length())
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_CHANCE = 1.0 / (1 << BITS)
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def _densify(minima: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row (in place) from its filled ones."""
    empty = minima == _NONE
    filled = BINS - empty.sum(axis=1)
    for row in np.flatnonzero(filled == 1):
        minima[row] = minima[row, ~empty[row]][0]
    rows, bins = np.nonzero(empty & (filled > 1)[:, None])
    source = minima.copy() if len(rows) else minima
    attempt = 0
    while len(rows):
        attempt += 1
        pick = (mix(bins.astype(np.uint64), attempt) >> _BIN_SHIFT).astype(np.int64)
        value = source[rows, pick]
        ok = value != _NONE
        minima[rows[ok], bins[ok]] = value[ok]
        rows, bins = rows[~ok], bins[~ok]
    return minima


def sketches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low-order bits of every bin of every text (n x BINS, uint8), and whether the text has words."""
    words, counts = word_hashes(data, offsets)
    flat, per = shingle_hashes(words, counts, SHINGLE_WORDS)
    n = len(per)
    minima = np.full(n * BINS, _NONE)
    at = np.repeat(np.arange(n, dtype=np.int64) * BINS, per) + (flat >> _BIN_SHIFT).astype(np.int64)
    np.minimum.at(minima, at, flat & ((np.uint64(1) << _BIN_SHIFT) - np.uint64(1)))
    minima = _densify(minima.reshape(n, BINS)) if n else minima.reshape(0, BINS)
    return (minima & np.uint64((1 << BITS) - 1)).astype(np.uint8), per > 0


def as_text(bits: np.ndarray, some: np.ndarray) -> list[str]:
    return [d.tobytes().decode() if s else "" for d, s in zip(_DIGITS[bits], some, strict=True)]


def likeness(a: np.ndarray, some_a: np.ndarray, b: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of paired sketches, in [0, 1]; two texts without words are alike, one is not."""
    agree = (a == b).mean(axis=1)
    estimate = np.clip((agree - _CHANCE) / (1.0 - _CHANCE), 0.0, 1.0)
    return np.where(some_a & some_b, estimate, (some_a == some_b).astype(float))


def likeness_of(a: str, b: str) -> float:
    """Likeness of two fingerprints as stored."""
    x, y = (np.frombuffer((t or "0" * BINS).encode(), np.uint8)[None] for t in (a, b))
    return float(likeness(x, np.array([bool(a)]), y, np.array([bool(b)]))[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with a fingerprint column added (an existing column of that name is replaced)."""
    kept = [c for c in docs.columns if c != out]
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.select(*kept).dtypes] + [f"`{out}` string"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = as_text(*sketches(*text_view(column(part, text))))
                yield pa.RecordBatch.from_arrays([*[column(part, c) for c in kept], pa.array(made, pa.string())], names=[*kept, out])

    return docs.select(*kept).mapInArrow(rows, schema)


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """Ascending id bounds of about equal shares (a share's exact size does not matter)."""
    asked = [i / parts for i in range(1, parts)]
    return sorted({int(x) for x in docs.where("doc_id is not null").stat.approxQuantile("doc_id", asked, 0.5 / parts)}) if asked else []


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text, of its edited text, and likeness to that and to the next document.

    Order: descending ``doc_id``, null ids last, equal ids by text hash; after the last comes the first.  The
    edited text has its last floor(n/3) code points replaced by as many of the next document's first (or all).
    Repeated rows follow each other.  An empty table gives no rows.

    The table is dealt by ranges of the order; a range also gets the row that follows its last one, so no task
    holds more than its range and no row waits for another task.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, parts)
    ordered = docs.select(F.col("doc_id").isNull().alias("k0"), F.bitwise_not(F.col("doc_id").cast("long")).alias("k1"),
                          F.xxhash64("text").alias("k2"), "doc_id", "text")
    share = _share_of(sorted(~b for b in bounds))
    ordered = ordered.withColumn("share", F.when(F.col("k0"), len(bounds) + 1).otherwise(share("k1")))
    first = F.min(F.struct("k0", "k1", "k2")).alias("first")
    heads = sorted((r["share"], *r["first"]) for r in ordered.groupBy("share").agg(first).collect())
    follows = [(heads[i - 1][0], h[1], h[2], h[3]) for i, h in enumerate(heads)]
    heads = F.broadcast(spark.createDataFrame(follows, "before int, h0 boolean, h1 long, h2 long"))
    same = (F.col("k0") == F.col("h0")) & F.col("k1").eqNullSafe(F.col("h1")) & (F.col("k2") == F.col("h2"))
    own = F.struct("share", F.lit(False).alias("ahead"))
    look_ahead = F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("share"), F.lit(True).alias("ahead")))
    dealt = (ordered.join(heads, same, "left").withColumn("at", F.explode(F.array_compact(F.array(own, look_ahead))))
             .select("at.share", "at.ahead", "k0", "k1", "k2", "doc_id", "text"))
    dealt = dealt.repartition(max(1, parts // 4), "share").sortWithinPartitions("share", "ahead", "k0", "k1", "k2")
    return dealt.select("ahead", "doc_id", "text").mapInArrow(
        _edited, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")


def _share_of(bounds: list[int]):
    """Arrow function: how many of the ascending bounds are at or below a value."""
    held = np.array(bounds, np.int64)

    @F.arrow_udf("int")
    def share(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(held, pc.fill_null(values, 0).to_numpy(zero_copy_only=False), "right"), pa.int32())

    return share


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts() -> Iterator[tuple]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield (column(part, "ahead").to_pylist(), column(part, "doc_id").to_pylist(), column(part, "text").to_pylist(),
                       *sketches(*text_view(column(part, "text"))))

    held = None
    for now in parts():
        if held is not None:
            yield _emit(held, now)
        held = now
    if held is not None:
        yield _emit(held, None)


def _emit(held: tuple, after: tuple | None) -> pa.RecordBatch:
    """Rows of one slice; its last row is followed by the first of ``after`` (or is itself a look-ahead row)."""
    ahead, ids, texts, bits, some = held
    if after is not None:
        texts, bits, some = [*texts, after[2][0]], np.concatenate([bits, after[3][:1]]), np.concatenate([some, after[4][:1]])
    at = np.flatnonzero(~np.array(ahead, bool))
    edited = [texts[i][:len(texts[i]) - len(texts[i]) // 3] + texts[i + 1][:len(texts[i]) // 3] for i in at]
    made = pa.array(edited, pa.string())
    ebits, esome = sketches(*text_view(made))
    return pa.record_batch({
        "doc_id": pa.array([ids[i] for i in at], pa.int64()),
        "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        "fingerprint": pa.array(as_text(bits[at], some[at]), pa.string()),
        "edited_fingerprint": pa.array(as_text(ebits, esome), pa.string()),
        "near_edited": pa.array(likeness(bits[at], some[at], ebits, esome), pa.float64()),
        "near_next": pa.array(likeness(bits[at], some[at], bits[at + 1], some[at + 1]), pa.float64()),
    })
