"""Best-fit packing with conflicts: documents into bins of a fixed number of tokens.

Documents are dealt by a hash into groups of about ``GROUP_DOCS`` (any number of groups side by side, so neither a
hot source nor a hot cluster gathers in one task), and each group is packed by itself: longest first, each into the
bin with the least room that still fits and does not conflict.

A bin carries bitmaps: one of hashed duplicate clusters, so that copies never share a bin, and ``source_limit``
planes of hashed sources, so that no more documents of one source than that share one.  Two clusters or sources on
one bit conflict too, which only costs another bin.  Open bins are kept in order of their residual room; the search
starts at the first that fits and goes from successor to successor until one is compatible.

With ``near`` the duplicate clusters of a group also join near copies: texts whose word shingles overlap by that percentage.
Only documents of one group can share a bin, so they are found in the group: two such texts share a leading shingle of
one common order, and their sizes, the place of that shingle and their parity bitmaps leave room for the overlap (see
``ngram_join``).  The bounds are not followed by an intersection: no pair is missed, and a pair that passes them
without being near only costs another bin.

A document longer than a bin fills bins of its own with its leading pieces; only its rest is packed with others.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import groups
from .ngram_join import describe, fold, frequent_shingles
from .words import mix

CAPACITY = 16384
SOURCE_LIMIT = 2
GROUP_DOCS = 4096
CLUSTER_BITS = 512
SOURCE_BITS = 64
#: Words of a shingle of near copies, and the overlap (percent) of op 1.
SHINGLE = 5
NEAR = 80


class Bins:
    """The open bins of one group, ordered by residual room."""

    def __init__(self, capacity: int, source_limit: int):
        self.capacity, self.limit = capacity, source_limit
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and start of an item; ``source`` and ``cluster`` are single bits (0: no constraint)."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not (self.clusters[b] & cluster or self.sources[b][-1] & source):
                del self.order[at]
                break
            at += 1
        else:
            residual, b = self.capacity, len(self.clusters)
            self.clusters.append(0)
            self.sources.append([0] * self.limit)
        self.clusters[b] |= cluster
        planes = self.sources[b]
        for k in range(self.limit):
            if not planes[k] & source:
                planes[k] |= source
                break
        if residual > size:
            insort(self.order, (residual - size, b))
        return b, self.capacity - residual


def _bits(hashes: np.ndarray, valid: np.ndarray, width: int, seed: int) -> list[int]:
    at = (mix(hashes.astype(np.uint64), seed) % np.uint64(width)).tolist()
    return [1 << a if v else 0 for a, v in zip(at, valid.tolist(), strict=True)]


def pack(docs: DataFrame, size: Column | None = None, cluster: Column | None = None, capacity: int = CAPACITY,
         source_limit: int = SOURCE_LIMIT, near: int | None = None) -> DataFrame:
    """Where every token of every row of ``docs`` (doc_id, text, source, ...) goes.

    Rows ``(doc_id, source, piece, bin_id, bin_start, doc_start, n_tokens)``: tokens ``doc_start`` and on of the
    document stand at ``bin_start`` of the bin.  ``size``: tokens of a row (default: UTF-8 bytes, the byte-level
    vocabulary); ``cluster``: its duplicate cluster (default: a hash of the lower-cased text; null: none);
    ``near``: percentage of shingles from which two texts count as copies too (default: only the clusters count).

    A row without tokens (null or empty text) has one row with a null ``bin_id``.  A null source is no constraint.
    Repeated rows are packed each (as copies, into different bins).  An empty table gives no rows.
    """
    text = F.col("text").cast("string")
    size = F.octet_length(text) if size is None else size
    cluster = F.xxhash64(F.lower(text)) if cluster is None else cluster
    shares = max(1, -(-docs.count() // GROUP_DOCS))
    base = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("tokens"),
                       cluster.cast("long").alias("cluster"), text.alias("text"))
    extra = []
    if near is None:
        items = base.withColumn("th", F.xxhash64("text"))
    else:
        items = describe(base, "text", SHINGLE, near, frequent_shingles(base, "text", SHINGLE), ["doc_id", "source", "tokens", "cluster"])
        extra = ["key", F.col("n").alias("shingles"), "bitmap", "lead"]
    items = items.withColumn("share", F.pmod(F.xxhash64("doc_id", "th"), F.lit(shares)))
    items = items.select("share", "doc_id", "source", F.col("tokens").alias("n"), F.xxhash64("source").alias("sh"), "cluster",
                         "th", (F.col("tokens") % capacity).alias("rest"), *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["share"]):
            yield from _pack_group(group, capacity, source_limit, near)

    spread = items.repartition("share").sortWithinPartitions("share", F.desc("rest"), "doc_id", "th")
    kind = dict(docs.dtypes)["doc_id"]
    return spread.mapInArrow(run, f"doc_id {kind}, source string, piece int, bin_id string, bin_start long, doc_start long, n_tokens long")


def _overlap_bound(bits: list[np.ndarray]):
    """A function of two arrays of set numbers: differing bits of their bitmaps, folded to the smaller width of each pair."""
    width = np.array([len(x) for x in bits])
    at, stacked = {}, {}
    for w in np.unique(width).tolist():
        wide = np.flatnonzero(width >= w)
        at[w] = np.zeros(len(bits), np.int64)
        at[w][wide] = np.arange(len(wide))
        stacked[w] = np.concatenate([fold(bits[i][None], w) for i in wide])

    def differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        least = np.minimum(width[a], width[b])
        for w in np.unique(least).tolist():
            pairs = np.flatnonzero(least == w)
            step = max(1, (1 << 20) // w)
            for s in range(0, len(pairs), step):
                some = pairs[s:s + step]
                out[some] = np.bitwise_count(stacked[w][at[w][a[some]]] ^ stacked[w][at[w][b[some]]]).sum(axis=1)
        return out

    return differ


def _near_sets(n: np.ndarray, bits: list[np.ndarray], lead: list[np.ndarray], percent: int) -> np.ndarray:
    """Class of each of the distinct sets: those whose bounds let them overlap by ``percent``, and what these join."""
    comp = np.arange(len(n))
    owner = np.repeat(comp, [len(x) for x in lead])
    if not len(owner):
        return comp
    shingle = np.concatenate(lead)
    after = n[owner] - np.concatenate([np.arange(len(x)) for x in lead])  # shingles from this one on, in the common order
    order = np.lexsort((owner, shingle))
    shingle, owner, after = shingle[order], owner[order], after[order]
    differ = _overlap_bound(bits)
    distance = 0
    while len(shingle):
        distance += 1
        if distance & (distance - 1) == 0:  # lists whose sets are one class already have no pair left
            start = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
            size = np.diff(np.r_[start, len(shingle)])
            own = comp[owner]
            live = (np.minimum.reduceat(own, start) != np.maximum.reduceat(own, start)) & (size > distance)
            live = np.repeat(live, size)
            shingle, owner, after = shingle[live], owner[live], after[live]
        if len(shingle) <= distance:
            break
        i = np.flatnonzero((shingle[distance:] == shingle[:-distance]) & (comp[owner[distance:]] != comp[owner[:-distance]]))
        a, b = owner[i], owner[i + distance]
        both = n[a] + n[b]
        may = (np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * percent)
        may &= (100 + percent) * np.minimum(after[i], after[i + distance]) >= percent * both
        pairs = np.unique(np.stack([a[may], b[may]]), axis=1)
        a, b = pairs
        both = n[a] + n[b]
        close = (100 + percent) * ((both - differ(a, b)) // 2) >= percent * both
        for x, y in zip(a[close].tolist(), b[close].tolist(), strict=True):
            if comp[x] != comp[y]:
                lo, hi = sorted((comp[x], comp[y]))
                comp[comp == hi] = lo
    return comp


def _clusters(group: pa.Table, percent: int) -> np.ndarray:
    """Class of each row of a group: rows of one cluster or of near texts, and what these join."""
    key, n = group.column("key").to_numpy(), group.column("shingles").to_numpy().astype(np.int64)
    full = np.flatnonzero(n)
    label = np.arange(len(n))
    if len(full):
        _, first, again = np.unique(key[full], return_index=True, return_inverse=True)
        sets = group.select(["bitmap", "lead"]).take(pa.array(full[first]))
        bits = [np.frombuffer(x, np.uint64) for x in sets.column("bitmap").to_pylist()]
        lists = sets.column("lead").combine_chunks()
        lead = [x.values.to_numpy() for x in lists]
        label[full] = full[first][_near_sets(n[full[first]], bits, lead, percent)[again]]
    known = np.flatnonzero(group.column("cluster").is_valid().to_numpy())
    _, given = np.unique(group.column("cluster").combine_chunks().fill_null(0).to_numpy()[known], return_inverse=True)
    least = np.zeros(len(n), np.int64)
    while True:  # the smallest class over each cluster, then over each class, until nothing changes
        least[:] = len(n)
        np.minimum.at(least, given, label[known])
        moved = np.arange(len(n))
        np.minimum.at(moved, label[known], least[given])
        after = moved[label]
        if (after == label).all():
            return label
        label = after


def _pack_group(group: pa.Table, capacity: int, source_limit: int, near: int | None = None) -> Iterator[pa.RecordBatch]:
    share = group.column("share")[0].as_py()
    bins = Bins(capacity, source_limit)
    numbers = lambda c: group.column(c).combine_chunks().fill_null(0).to_numpy()
    sources = _bits(numbers("sh"), group.column("source").is_valid().to_numpy(), SOURCE_BITS, 1)
    if near is None:
        clusters = _bits(numbers("cluster"), group.column("cluster").is_valid().to_numpy(), CLUSTER_BITS, 2)
    else:
        clusters = _bits(_clusters(group, near), np.ones(group.num_rows, bool), CLUSTER_BITS, 2)
    total = numbers("n").tolist()
    row, piece, name, bin_start, doc_start, length = [], [], [], [], [], []

    def add(*values) -> None:
        for out, v in zip((row, piece, name, bin_start, doc_start, length), values, strict=True):
            out.append(v)

    def batch() -> pa.RecordBatch:
        take = pa.array(row, pa.int64())
        return pa.RecordBatch.from_arrays(
            [group.column("doc_id").combine_chunks().take(take), group.column("source").combine_chunks().take(take), pa.array(piece, pa.int32()),
             pa.array(name, pa.string()), pa.array(bin_start, pa.int64()), pa.array(doc_start, pa.int64()), pa.array(length, pa.int64())],
            names=["doc_id", "source", "piece", "bin_id", "bin_start", "doc_start", "n_tokens"])

    whole = 0
    for i, n in enumerate(total):
        full, rest = divmod(n, capacity)
        for k in range(full):
            add(i, k, f"{share}-w{whole}", 0, k * capacity, capacity)
            whole += 1
            if len(row) >= 50_000:
                yield batch()
                for out in (row, piece, name, bin_start, doc_start, length):
                    out.clear()
        if rest:
            b, start = bins.place(rest, sources[i], clusters[i])
            add(i, full, f"{share}-{b}", start, full * capacity, rest)
        elif not n:
            add(i, 0, None, 0, 0, 0)
    yield batch()
