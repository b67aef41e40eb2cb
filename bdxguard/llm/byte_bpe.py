"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary is a file of ranks (``base64 rank`` lines).  Each byte is written
as one printable character (the byte-to-character table), the merges are derived
from the ranks, and a ``tokenizers`` BPE model encodes every distinct piece of a
batch once; a text's ids are those of its pieces in order.  Pieces are the
matches of the usual byte-level pattern, found for a whole batch in numpy.  No special tokens, no dropped text.

Each id covers known bytes, so an id's offsets in the text follow from the
lengths; a character split over several ids gives each of them its span.
Decoding reverses the byte table: ids to bytes, and bytes to text only at the
end, so split characters come out whole.

``tokenizers`` is created once per Python worker.  The piece cache is emptied
when it holds CACHE_PIECES pieces; that bounds memory and drops nothing.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import column, slices, text_view
from .words import span_hashes

#: White space as Unicode's property has it (fixed values).
SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Contractions that are pieces of their own after a piece's end (fixed values of the pattern).
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
CACHE_PIECES = 500_000


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[SPACES] = SPACE
    return table


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points that start at the byte positions ``at`` of valid UTF-8."""
    lead = data[at].astype(np.int32)
    point = lead.copy()
    for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        rows = np.flatnonzero((lead >= low) & (lead < {2: 0xE0, 3: 0xF0, 4: 0x100}[size]))
        if len(rows):
            value = lead[rows] & mask
            for k in range(1, size):
                value = (value << 6) | (data[at[rows] + k] & 0x3F)
            point[rows] = value
    return point


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where the pieces of all texts start.

    The pieces are the matches of the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^sLN]+|s+(?!S)|s+`` (L letters,
    N numbers, s white space), found for all texts at once: a run of one class is a piece, a space before a run
    belongs to it, other white space before a run keeps its last character to itself, and a contraction that
    starts a piece ends it.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    point = _code_points(data, at)
    kind = _classes()[point]
    n = len(at)
    begin = np.zeros(n + 1, bool)  # a text begins here (or the table ends)
    begin[np.searchsorted(at, offsets)] = True
    start = np.ones(n, bool)
    start[1:] = (kind[1:] != kind[:-1]) | begin[1:n]
    blank = kind == SPACE
    last = blank & ~begin[1:] & np.append(~blank[1:], False)  # a white space with a run after it
    start |= last
    joined = np.flatnonzero(last & (point == 0x20)) + 1
    start[joined] = False
    quotes = np.flatnonzero((point == 0x27) & start)
    if len(quotes):
        end = np.append(np.flatnonzero(begin), n)
        room = end[np.searchsorted(end, quotes, "right")] - quotes
        padded = np.append(point, [0, 0, 0])
        for c in CONTRACTIONS:
            hit = quotes[room >= len(c)]
            for k, ch in enumerate(c[1:], 1):
                hit = hit[padded[hit + k] == ord(ch)]
            start[hit + 1] = False
            after = hit + len(c)
            start[after[after < n]] = True
    return at[start]


def byte_characters() -> list[str]:
    """Character of each byte: itself where it is printable, else the next free one from code point 256."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


def read_ranks(lines: Iterator[str]) -> dict[bytes, int]:
    pairs = (line.split() for line in lines)
    return {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``: merge by rank, with lower ranks only, until two are left."""
    parts = [token[i:i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        best = min(range(len(parts) - 1), key=lambda i: r if (r := ranks.get(parts[i] + parts[i + 1], limit)) < limit else limit)
        if ranks.get(parts[best] + parts[best + 1], limit) >= limit:
            raise ValueError(f"rank {limit} is not a merge of lower ranks")
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts[0], parts[1]


class ByteBpe:
    """Encoder and decoder for one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        chars = byte_characters()
        spell = {t: "".join(chars[b] for b in t) for t in ranks}
        merges = [tuple(spell[h] for h in _halves(t, ranks)) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
        self.tokenizer = Tokenizer(BPE({spell[t]: r for t, r in ranks.items()}, merges, cache_capacity=0))
        self.tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        back = {c: b for b, c in enumerate(chars)}
        size = max(ranks.values()) + 1
        spelled = [bytes(back[c] for c in self.tokenizer.id_to_token(i) or "") for i in range(size)]
        self.length = np.array([len(s) for s in spelled], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.known: dict[int, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.known.clear()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.first, self.count, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0

    def _learn(self, hashes: list[int], pieces: list[str]) -> None:
        """Encode pieces met for the first time and keep their ids."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        base, n = len(self.known), len(pieces)
        sizes = np.array([len(i) for i in ids], np.int64)
        while len(self.first) < base + n:
            self.first, self.count = np.resize(self.first, 2 * len(self.first)), np.resize(self.count, 2 * len(self.count))
        total = int(sizes.sum())
        while len(self.flat) < self.used + total:
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.count[base:base + n] = sizes
        self.first[base:base + n] = self.used + np.cumsum(sizes) - sizes
        self.used += total
        self.known.update(zip(hashes, range(base, base + n), strict=True))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids (uint32) of all texts (UTF-8 bytes and offsets) and the number of ids of each.

        Pieces are looked up by a 64-bit hash; the ids are decoded again, and if that does not give the input
        (two pieces with one hash), every piece is encoded by itself.
        """
        if len(self.known) > CACHE_PIECES:
            self._clear()
        starts = piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data))[:len(starts)]
        hashes, index, back = np.unique(span_hashes(data, starts, ends, cased=True), return_index=True, return_inverse=True)
        codes = [self.known.get(h, -1) for h in hashes.tolist()]
        new = [i for i, c in enumerate(codes) if c < 0]
        if new:
            where = index[new]
            self._learn(hashes[new].tolist(), [data[a:b].tobytes().decode() for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            codes = [self.known[h] for h in hashes.tolist()]
        at = np.array(codes, np.int64)[back]
        per = self.count[at]
        flat = ragged(self.flat, self.first[at], per)
        if not np.array_equal(self.decode(flat), data):
            ids = [self.tokenizer.encode(data[a:b].tobytes().decode(), add_special_tokens=False).ids for a, b in zip(starts, ends, strict=True)]
            per, flat = np.array([len(i) for i in ids], np.int64), np.fromiter(chain.from_iterable(ids), np.uint32)
        total = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(per, out=total[1:])
        return flat, np.diff(total[np.searchsorted(starts, offsets)])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, joined."""
        return ragged(self.bytes, self.begin[ids], self.length[ids])

    def offsets(self, ids: np.ndarray, text: str) -> list[tuple[int, int]]:
        """Code-point span of each id; ids that share a character share its span."""
        ends = np.cumsum(self.length[ids])
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # code point of every byte
        return [(int(char[e - n]), int(char[e - 1]) + 1) for e, n in zip(ends, self.length[ids], strict=True)]


def ragged(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``values[first[i]:first[i] + count[i]]``, joined."""
    total = int(count.sum())
    if not total:
        return values[:0]
    step = np.ones(total, np.int64)
    some = count > 0
    first, count = first[some], count[some]
    starts = np.cumsum(count) - count
    step[0] = first[0]
    step[starts[1:]] = first[1:] - (first[:-1] + count[:-1] - 1)
    return values[np.cumsum(step)]


@lru_cache(maxsize=2)
def _coder(name: str) -> ByteBpe:
    """The coder of a file shipped with ``SparkContext.addFile``, once per Python worker."""
    with open(SparkFiles.get(name)) as lines:
        return ByteBpe(read_ranks(lines))


def round_trip(docs: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """Kept columns with ``ids`` (little-endian unsigned 32-bit integers), ``n_tokens`` and ``decoded`` (bytes of the ids).

    ``vocabulary``: path of the rank file on the driver; Spark ships it to the executors.  A null text is empty.
    """
    sc = docs.sparkSession.sparkContext
    sc.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.select(*keep).dtypes] + ["n_tokens long, ids binary, decoded binary"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(name)
        for ids, per, part in _encoded(batches, coder):
            starts = np.cumsum(per) - per
            own = [ids[s:s + n] for s, n in zip(starts, per, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[column(part, c) for c in keep], pa.array(per, pa.int64()), pa.array([i.astype("<u4").tobytes() for i in own], pa.binary()),
                 pa.array([coder.decode(i).tobytes() for i in own], pa.binary())], names=[*keep, "n_tokens", "ids", "decoded"])

    return docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__t")).mapInArrow(rows, schema)


def digests(docs: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """Like ``round_trip`` with SHA-256 digests of ids and decoded bytes in place of both."""
    sc = docs.sparkSession.sparkContext
    sc.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.select(*keep).dtypes] + ["n_tokens long, ids_sha256 string, decoded_sha256 string"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(name)
        for ids, per, part in _encoded(batches, coder):
            ends = np.cumsum(per)
            out = coder.decode(ids)
            at = np.concatenate([[0], np.cumsum(coder.length[ids])])
            little = np.ascontiguousarray(ids.astype("<u4"))
            spans = [(int(e - n), int(e)) for e, n in zip(ends, per, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[column(part, c) for c in keep], pa.array(per, pa.int64()),
                 pa.array([hashlib.sha256(little[s:e]).hexdigest() for s, e in spans], pa.string()),
                 pa.array([hashlib.sha256(out[at[s]:at[e]]).hexdigest() for s, e in spans], pa.string())],
                names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__t")).mapInArrow(rows, schema)


def _encoded(batches: Iterator[pa.RecordBatch], coder: ByteBpe) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    for batch in batches:
        for part in slices(batch, "__t"):
            ids, per = coder.encode(*text_view(column(part, "__t")))
            yield ids, per, part
