"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Side A is a byte-level BPE of the ``tokenizers`` library over a space and the
text, side B a ``sentencepiece`` model over the text (it puts the space before
it itself).  Both sides then tile the same bytes.  Texts whose joined token
bytes differ from space and text on either side are not aligned.

Overlaps come from ``pandas.merge_asof`` over a batch of documents, keyed by
document: the start of each token finds the other side's token that covers it.
Two tokens overlap exactly if the later of their starts lies in the other
token, so the union of both directions gives every overlap.  Ends that both
sides share cut the tokens into groups.

Counting the id pairs of a corpus: documents are taken in blocks of up to
BLOCK_BYTES of text.  A block has one dictionary row of its distinct pairs with
the number of its documents that hold each, and its documents refer to places
in it.  Only these dictionaries are joined by pair, so a pair that every
document holds comes once a block and not once a document; what the pairs count
over the whole corpus goes back to the blocks by one shuffle.

Both libraries are created once per Python worker and encode every distinct
piece once: pieces of side A are the matches of the byte-level pattern, pieces
of side B runs of spaces and what follows, which no entry of its vocabulary
crosses (this is checked when it is loaded; a vocabulary that does not hold it
encodes whole texts).  Texts whose bytes do not come back are encoded whole
before they are given up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .arrow import column, slices, text_view
from .byte_bpe import byte_characters, piece_starts, ragged
from .words import span_hashes

BLOCK_BYTES = 1 << 24
CACHE_PIECES = 500_000
SPACE = 0x20


class Pieces:
    """Ids of many texts by one library, each distinct piece encoded once.

    ``spell``: bytes of every id; ``encode``: ids of a list of pieces; ``cut``: where the pieces of texts start
    (None: whole texts are the pieces).
    """

    def __init__(self, spell: list[bytes], encode: Callable[[list[str]], list[list[int]]], cut: Callable | None):
        self.encode, self.cut = encode, cut
        self.length = np.array([len(s) for s in spell], np.int64)
        self.first_byte = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spell), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.first, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.bytes, self.first_byte[ids], self.length[ids])

    def _learn(self, hashes: list[int], pieces: list[str]) -> None:
        ids = self.encode(pieces)
        base, sizes = len(self.known), np.array([len(i) for i in ids], np.int64)
        total = int(sizes.sum())
        while len(self.first) < base + len(ids):
            self.first, self.count = np.resize(self.first, 2 * len(self.first)), np.resize(self.count, 2 * len(self.count))
        while len(self.flat) < self.used + total:
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), np.int32, total)
        self.first[base:base + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.count[base:base + len(ids)] = sizes
        self.used += total
        self.known.update(zip(hashes, range(base, base + len(ids)), strict=True))

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of the texts, the number of ids of each, and which texts' bytes they give back."""
        n = len(offsets) - 1
        if len(self.known) > CACHE_PIECES:
            self._clear()
        if self.cut is None or not n:
            ids, per = self._whole(data, offsets, np.arange(n))
        else:
            starts = self.cut(data, offsets)
            ends = np.append(starts[1:], len(data))[:len(starts)]
            hashes, index, back = np.unique(span_hashes(data, starts, ends, cased=True), return_index=True, return_inverse=True)
            code = np.fromiter(map(self.known.get, hashes.tolist(), repeat(-1)), np.int64, len(hashes))
            new = np.flatnonzero(code < 0)
            if len(new):
                code[new] = len(self.known) + np.arange(len(new))
                spans = zip(starts[index[new]].tolist(), ends[index[new]].tolist(), strict=True)
                self._learn(hashes[new].tolist(), [data[a:b].tobytes().decode() for a, b in spans])
            at = code[back]
            ids = ragged(self.flat, self.first[at], self.count[at])
            total = np.concatenate([[0], np.cumsum(self.count[at])])
            per = np.diff(total[np.searchsorted(starts, offsets)])
        right = self._right(ids, per, data, offsets)
        if self.cut is not None and not right.all():  # two pieces with one hash, or bytes the vocabulary does not keep
            wrong = np.flatnonzero(~right)
            again, sizes = self._whole(data, offsets, wrong)
            parts, new_parts = _split(ids, per), _split(again, sizes)
            for d, part in zip(wrong.tolist(), new_parts, strict=True):
                parts[d] = part
            ids, per = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
            right = self._right(ids, per, data, offsets)
        return ids, per, right

    def _whole(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = self.encode([data[offsets[d]:offsets[d + 1]].tobytes().decode() for d in rows.tolist()]) if len(rows) else []
        per = np.array([len(i) for i in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(per.sum())), per

    def _right(self, ids: np.ndarray, per: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = self.decode(ids)
        ends = np.concatenate([[0], np.cumsum(self.length[ids])])[np.concatenate([[0], np.cumsum(per)])]
        if np.array_equal(ends, offsets) and np.array_equal(out, data):
            return np.ones(len(per), bool)
        return np.array([np.array_equal(out[a:b], data[c:d]) for a, b, c, d in zip(
            ends[:-1].tolist(), ends[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], bool)


def _split(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum(counts)
    return [values[e - c:e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]


def space_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a run of spaces starts; every text here starts with a space."""
    blank = data == SPACE
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    start[offsets[:-1]] = True
    return np.flatnonzero(start)


def byte_side(path: str) -> Pieces:
    """Side A: a byte-level BPE file of ``tokenizers``; strings of special tokens are plain text."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    back = {c: b for b, c in enumerate(byte_characters())}
    spell = [bytes(back[c] for c in t) if all(c in back for c in t) else b""
             for t in (model.id_to_token(i) or "" for i in range(model.get_vocab_size()))]
    return Pieces(spell, lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)], piece_starts)


def piece_side(path: str) -> Pieces:
    """Side B: a sentencepiece model, which writes a space as U+2581 and puts one before every text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    spell = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    crossing = any("▁" in p.lstrip("▁") for p in names)

    def encode(texts: list[str]) -> list[list[int]]:
        return model.encode([t[1:] for t in texts], num_threads=1)  # the model adds the first space itself

    return Pieces(spell, encode, None if crossing else space_starts)


class Sides:
    """Both tokenizers of a worker."""

    def __init__(self, a: str, b: str):
        self.a, self.b = byte_side(a), piece_side(b)
        self.pairs = len(self.b.length)  # an id pair is a * pairs + b


@lru_cache(maxsize=1)
def _sides(a: str, b: str) -> Sides:
    return Sides(SparkFiles.get(a), SparkFiles.get(b))


class Aligned:
    """Tokens, overlaps and groups of the texts of one slice; positions run over all its aligned texts."""

    def __init__(self, sides: Sides, texts: pa.Array):
        data, offsets = text_view(texts)
        n = np.diff(offsets)
        self.rows = np.flatnonzero(n > 0)
        offsets = np.concatenate([[0], np.cumsum(n[self.rows])])
        data = np.insert(data, offsets[:-1], SPACE) if len(self.rows) else data
        offsets = offsets + np.arange(len(offsets))
        a, per_a, right_a = sides.a.of(data, offsets)
        b, per_b, right_b = sides.b.of(data, offsets)
        right = right_a & right_b
        if not right.all():
            a, b = a[np.repeat(right, per_a)], b[np.repeat(right, per_b)]
            self.rows, per_a, per_b = self.rows[right], per_a[right], per_b[right]
        self.a, self.b, self.per_a, self.per_b = a.astype(np.int64), b.astype(np.int64), per_a, per_b
        self.ends_a, self.ends_b = np.cumsum(sides.a.length[a]), np.cumsum(sides.b.length[b])
        starts_a, starts_b = self.ends_a - sides.a.length[a], self.ends_b - sides.b.length[b]
        self.doc_a, self.doc_b = np.repeat(np.arange(len(per_a)), per_a), np.repeat(np.arange(len(per_b)), per_b)
        if not len(a):
            self.link_a = self.link_b = self.cuts = self.group_a = self.group_b = np.zeros(0, np.int64)
            return
        of_a = pd.DataFrame({"at": starts_a, "doc": self.doc_a, "i": np.arange(len(a))})
        of_b = pd.DataFrame({"at": starts_b, "doc": self.doc_b, "j": np.arange(len(b))})
        down = pd.merge_asof(of_a, of_b, on="at", by="doc")  # the token of B that covers the start of each token of A
        up = pd.merge_asof(of_b, of_a, on="at", by="doc")
        i, j = up["i"].to_numpy(np.int64), up["j"].to_numpy(np.int64)
        more = starts_a[i] != starts_b[j]                       # equal starts are in both directions
        self.link_a = np.concatenate([down["i"].to_numpy(np.int64), i[more]])
        self.link_b = np.concatenate([down["j"].to_numpy(np.int64), j[more]])
        self.cuts = np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(self.cuts, self.ends_a), np.searchsorted(self.cuts, self.ends_b)

    def per_doc(self, at: np.ndarray) -> np.ndarray:
        return np.bincount(at, minlength=len(self.rows))

    def spelled(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text: decimal ids of A and B, group by group."""
        if not len(self.a):
            return []
        na, nb = self.per_doc_groups()
        place_a = np.arange(len(self.a)) + nb[self.group_a]              # tokens of B in earlier groups
        place_b = np.arange(len(self.b)) + na[self.group_b + 1]          # tokens of A up to this group
        total = len(self.a) + len(self.b)
        ids, sep = np.empty(total, np.int64), np.empty(total, np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        sep[place_a] = np.where(np.append(self.group_a[1:] != self.group_a[:-1], True), ord("|"), ord(","))
        sep[place_b] = np.where(np.append(self.group_b[1:] != self.group_b[:-1], True), ord(";"), ord(","))
        digits, size = _decimals(int(ids.max()))
        length = size[ids] + 1
        ends = np.cumsum(length)
        flat = np.empty(int(ends[-1]), np.uint8)
        width = digits.shape[1]
        for k in range(width):
            some = np.flatnonzero(size[ids] > k)
            flat[ends[some] - length[some] + k] = digits[ids[some], k]
        flat[ends - 1] = sep
        last = np.concatenate([[0], ends[np.cumsum(self.per_a + self.per_b) - 1]])
        raw = flat.tobytes()
        return [raw[s:e - 1] for s, e in zip(last[:-1].tolist(), last[1:].tolist(), strict=True)]

    def per_doc_groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of A and of B in all groups before each group."""
        n = len(self.cuts)
        return tuple(np.concatenate([[0], np.cumsum(np.bincount(g, minlength=n))]) for g in (self.group_a, self.group_b))


@lru_cache(maxsize=4)
def _table(size: int) -> tuple[np.ndarray, np.ndarray]:
    text = [str(i).encode() for i in range(size)]
    width = len(text[-1])
    return (np.frombuffer(b"".join(t.ljust(width, b"\0") for t in text), np.uint8).reshape(size, width),
            np.array([len(t) for t in text], np.int64))


def _decimals(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 .. ``largest`` and their numbers; tables grow by powers of two."""
    return _table(1 << largest.bit_length())


def _shipped(docs: DataFrame, *paths: str) -> list[str]:
    for p in paths:
        docs.sparkSession.sparkContext.addFile(p)
    return [p.rsplit("/", 1)[-1] for p in paths]


def _kept(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, str]:
    kept = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__t"))
    return kept, "".join(f"`{c}` {t}, " for c, t in kept.drop("__t").dtypes)


def aligned(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, keep: list[str]) -> DataFrame:
    """Kept columns with the tokens of both sides, their byte ends, all links and the group ends.

    ``a_ids``, ``b_ids``: ids; ``a_ends``, ``b_ends``: where each token ends, in bytes of the text with a space before
    it; ``links``: (place in ``a_ids``, place in ``b_ids``) of each pair whose byte ranges overlap, in that order;
    ``group_ends``: byte ends common to both sides.  All are empty arrays for texts without tokens (null, empty, or
    not given back by one side).  ``vocabulary_a``, ``vocabulary_b``: paths on the driver; Spark ships the files.
    """
    names = _shipped(docs, vocabulary_a, vocabulary_b)
    kept, schema = _kept(docs, keep)
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    link = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(*names)
        for batch in batches:
            for part in slices(batch, "__t"):
                x = Aligned(sides, column(part, "__t"))
                out = {k: [[] for _ in range(part.num_rows)] for k in ("a_ids", "a_ends", "b_ids", "b_ends", "links", "group_ends")}
                first_a, first_b = np.cumsum(x.per_a) - x.per_a, np.cumsum(x.per_b) - x.per_b
                order = np.lexsort((x.link_b, x.link_a))
                la, lb = x.link_a[order], x.link_b[order]
                for d, row in enumerate(x.rows.tolist()):
                    a, b = slice(first_a[d], first_a[d] + x.per_a[d]), slice(first_b[d], first_b[d] + x.per_b[d])
                    zero = x.ends_a[a.start - 1] if a.start else 0
                    l = slice(*np.searchsorted(la, [a.start, a.stop]))
                    g = slice(*np.searchsorted(x.cuts, [zero, x.ends_a[a.stop - 1]], "right"))
                    out["a_ids"][row], out["a_ends"][row] = x.a[a], x.ends_a[a] - zero
                    out["b_ids"][row], out["b_ends"][row] = x.b[b], x.ends_b[b] - zero
                    out["links"][row] = [{"a": i, "b": j} for i, j in zip((la[l] - a.start).tolist(), (lb[l] - b.start).tolist(), strict=True)]
                    out["group_ends"][row] = x.cuts[g] - zero
                kinds = {"a_ids": ints, "b_ids": ints, "a_ends": longs, "b_ends": longs, "links": link, "group_ends": longs}
                yield pa.RecordBatch.from_arrays([*[column(part, c) for c in keep], *[pa.array(v, kinds[k]) for k, v in out.items()]],
                                                 names=[*keep, *out])

    return kept.mapInArrow(rows, schema + "a_ids array<int>, a_ends array<long>, b_ids array<int>, b_ends array<long>, "
                           "links array<struct<a: int, b: int>>, group_ends array<long>")


def _packed(places: np.ndarray, times: np.ndarray) -> bytes:
    """Rising places and how often each is linked, as differences by byte planes, compressed."""
    both = np.concatenate([np.diff(places, prepend=0), times]).astype("<u4")
    return pa.compress(np.ascontiguousarray(both.view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(raw, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    return np.cumsum(both[:n]), both[n:]


_COUNTS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]


class _Block:
    """Documents of one task until they hold BLOCK_BYTES of text."""

    def __init__(self, keep: list[str]):
        self.keep, self.parts, self.pairs, self.times, self.sizes, self.bytes = keep, [], [], [], [], 0

    def add(self, part: pa.RecordBatch, x: Aligned, width: int) -> None:
        n = part.num_rows
        filled = [np.zeros(n, np.int64) for _ in range(4)]
        filled[0][x.rows], filled[1][x.rows] = x.per_a, x.per_b
        ends = np.concatenate([[0], x.ends_a])[np.cumsum(x.per_a)] if len(x.rows) else np.zeros(0, np.int64)
        filled[2][x.rows] = np.diff(np.searchsorted(x.cuts, ends, "right"), prepend=0)
        doc = x.doc_a[x.link_a]
        filled[3][x.rows] = x.per_doc(doc)
        digest = [""] * n
        for row, text in zip(x.rows.tolist(), x.spelled(), strict=True):
            digest[row] = hashlib.sha256(text).hexdigest()
        span = width * (int(x.a.max()) + 1) if len(x.a) else 1
        keys, times = np.unique(doc * span + x.a[x.link_a] * width + x.b[x.link_b], return_counts=True)
        sizes = np.zeros(n, np.int64)
        sizes[x.rows] = x.per_doc(keys // span)
        self.pairs.append(keys % span)
        self.times.append(times)
        self.sizes.append(sizes)
        self.parts.append(pa.RecordBatch.from_arrays(
            [*[column(part, c) for c in self.keep], *[pa.array(f) for f in filled], pa.array(digest, pa.string())],
            names=[*self.keep, *[k for k, _ in _COUNTS]]))
        self.bytes += int(column(part, "__t").nbytes)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """The documents' rows, then the dictionary of the block."""
        found, place, docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        at, times = 0, np.concatenate(self.times)
        for part, sizes in zip(self.parts, self.sizes, strict=True):
            links = []
            for n in sizes.tolist():
                links.append(_packed(place[at:at + n], times[at:at + n]) if n else b"")
                at += n
            yield pa.RecordBatch.from_arrays(
                [pa.StructArray.from_arrays(part.columns, names=part.schema.names), pa.array(np.full(part.num_rows, block)),
                 pa.array(sizes), pa.array(links, pa.binary()), pa.nulls(part.num_rows, pa.list_(pa.int64())), pa.nulls(part.num_rows, pa.list_(pa.int32()))],
                names=["doc", "block", "n", "links", "pairs", "docs"])
        shape = pa.struct([pa.field(f.name, f.type) for f in self.parts[0].schema])
        one = pa.array([0, len(found)], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, shape), pa.array([block]), pa.array([0]), pa.nulls(1, pa.binary()), pa.ListArray.from_arrays(one, pa.array(found, pa.int64())),
             pa.ListArray.from_arrays(one, pa.array(docs.astype(np.int32)))], names=["doc", "block", "n", "links", "pairs", "docs"])


def alignment_counts(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, keep: list[str]) -> DataFrame:
    """Kept columns with ``n_a, n_b, n_groups, n_links, n_best, count_sum`` (long) and ``groups_sha256``.

    ``count_sum`` sums over a document's links in how many documents of the whole frame their id pair is linked,
    ``n_best`` counts the links whose pair has the highest such count of its A id (ties included).  Every row is a
    document, also repeated ones.  Texts without tokens (null, empty, not given back by one side) have zeros and ''.
    Columns of ``docs`` that are not kept play no part, whatever their names.
    """
    names = _shipped(docs, vocabulary_a, vocabulary_b)
    kept, schema = _kept(docs, keep)
    inner = schema + "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    width = _vocabulary_size(vocabulary_b)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(*names)
        number = TaskContext.get().partitionId() << 32
        block = _Block(keep)
        for batch in batches:
            for part in slices(batch, "__t"):
                block.add(part, Aligned(sides, column(part, "__t")), sides.pairs)
                if block.bytes >= BLOCK_BYTES:
                    yield from block.rows(number)
                    block, number = _Block(keep), number + 1
        if block.parts:
            yield from block.rows(number)

    table = materialize(kept.mapInArrow(
        tokens, f"doc struct<{inner}>, block long, n long, links binary, pairs array<long>, docs array<int>"), "aligned")
    # every pair of every block, dealt once by pair; the dictionary of a block holds a pair once
    pairs = (table.where(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "x"))
             .select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs")).repartition("pair"))
    per = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    first = F.expr(f"pair div {width}").alias("a")
    best = per.groupBy(first).agg(F.max("count").alias("most"))  # one row per id of A: its vocabulary bounds the broadcast
    counts = per.withColumn("a", first).join(F.broadcast(best), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    looked = pairs.select("block", "place", "pair").join(counts, "pair").select("block", "place", "count", "best")
    result = schema + "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def sums(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        count, best_ = np.zeros(theirs.num_rows, np.int64), np.zeros(theirs.num_rows, np.int64)
        place = theirs["place"].to_numpy()
        count[place], best_[place] = theirs["count"].to_numpy(), theirs["best"].to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for n, raw in zip(mine["n"].to_pylist(), mine["links"].to_pylist(), strict=True):
            at, times = _unpacked(raw, n) if n else (np.zeros(0, np.int64),) * 2
            n_best.append(int((best_[at] * times).sum()))
            count_sum.append(int((count[at] * times).sum()))
        doc = mine["doc"].combine_chunks()
        doc = pa.concat_arrays(doc.chunks) if isinstance(doc, pa.ChunkedArray) else doc
        flat = dict(zip([f.name for f in doc.type], doc.flatten(), strict=True))
        flat |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        order = [*keep, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return pa.table([flat[k] for k in order], names=order)

    mine = table.where(F.col("doc").isNotNull()).select("doc", F.col("block").alias("owner"), "n", "links")
    return mine.groupBy("owner").cogroup(looked.groupBy("block")).applyInArrow(sums, result)


def _vocabulary_size(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
