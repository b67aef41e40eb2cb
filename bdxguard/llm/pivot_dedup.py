"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are vectors of the table, a bounded sample chosen by a hash.  Each vector is described by
the ordered list of its ``NEAREST`` nearest pivots; two vectors at a small angle see the pivots in nearly the same
order.  An inverted list holds, per label and pivot, the vectors that name the pivot.  Candidates are the pairs of
a list that share at least ``SHARED`` pivots; each is verified by the cosine in double precision, so no link below
the threshold is ever reported.  A pair is taken in the list of its smallest shared pivot only.

Pivots keep an angle of ``APART`` times the linking angle from each other, so a group of near copies cannot own many.
In a crowded neighbourhood (a *hot* pivot, nearest to ``HOT`` classes or more) the order of the pivots tells members
apart by noise only, so there the shared pivots are not asked.  A class within ``COVERED`` linking angles of its
nearest hot pivot belongs to the exact list of that pivot, and every class that may link with a member visits the list;
members are compared with all of it.  No link of a member is missed: with p and q the nearest hot pivots of a member x
and of a class y, y links with x only if its angle to p is within the linking angle of the member's bound and y lies no
farther than the linking angle beyond the plane that halves p and q.  Only classes without a hot pivot near them enter
the inverted lists, and only pairs of these can be missed.

Equal vectors of a label are one class and enter once.  A long list is cut into block pairs, so one task never holds
more than two blocks.  In a block, links are counted per vector and only the smallest linked vector is passed on:
the number of rows that leave a block is at most the number of its vectors.  Components follow from these: they
join every vector of a block to the others it links with, through a spanning forest of the block's links.

Vectors that are null, zero or hold null or non-finite components, and rows with a null label, link with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .arrow import binary_array, column, groups
from .components import connected_components

THRESHOLD = 0.98
#: Nearest pivots that describe a vector, how many of them are looked up, and how many two candidates must share.
NEAREST = 12
LOOKED_UP = 6
SHARED = 3
#: In linking angles: the least angle of two pivots, and how far the members of an exact list may be from its pivot.  COVERED
#: is APART + 1, so a class that links with a sampled vector is within it.
APART = 2.5
COVERED = 3.5
#: A pivot that is the nearest of so many classes is hot.
HOT = 256
#: Pivots: about one for so many vectors, within these bounds.
VECTORS_EACH = 64
PIVOTS_MIN = 32
PIVOTS_MAX = 2048
BLOCK_ROWS = 1024
#: Vectors that are compared with the pivots at a time.
SLICE_ROWS = 2048


def spread_out(rows: np.ndarray, wanted: int, angle: float) -> np.ndarray:
    """The first ``wanted`` rows, in order, that keep ``angle`` from all taken before."""
    most = np.cos(min(angle, np.pi))
    free = np.ones(len(rows), bool)
    taken: list[int] = []
    for i in range(len(rows)):
        if free[i]:
            taken.append(i)
            if len(taken) == wanted:
                break
            free &= rows @ rows[i] < most
    return rows[taken]


def sample_of(vectors: DataFrame) -> DataFrame:
    """``(size, key, hash, wanted)``: rows of small hash of each dimension, about ``4 * PIVOTS_MAX`` where it has more; wanted: its pivots.

    A ranking by the hash needs the first ``2 * PIVOTS_MAX`` at most; without the rest no task ranks the whole table.
    """
    hashed = vectors.select(F.octet_length("v").alias("size"), "key", F.xxhash64("v", F.lit(5)).alias("hash"))
    total = hashed.groupBy("size").agg(F.count("*").alias("n"))
    wanted = F.greatest(F.lit(PIVOTS_MIN), F.least(F.lit(PIVOTS_MAX), F.col("n") / VECTORS_EACH)).cast("int")
    low = F.col("hash") / F.lit(2.0 ** 64) + 0.5 <= F.lit(4.0 * PIVOTS_MAX) / F.col("n")
    return hashed.join(total, "size").where(low).select("size", "key", "hash", wanted.alias("wanted"))


def pivots_of(vectors: DataFrame, threshold: float = THRESHOLD) -> dict[int, np.ndarray]:
    """Reference points (n x dimension, unit length) of each dimension, ``APART`` from each other.

    They come from a bounded sample of the distinct vectors, by a hash of their values, of twice as many.
    """
    rank = F.row_number().over(Window.partitionBy("size").orderBy("hash", "key"))
    few = sample_of(vectors).withColumn("rank", rank).where("rank <= 2 * wanted").select("key", "rank", "wanted")
    found: dict[int, list] = {}
    wanted: dict[int, int] = {}
    for r in vectors.select("key", "v").join(few, "key").orderBy(F.octet_length("v"), "rank").select("v", "wanted").collect():
        found.setdefault(len(r[0]) // 8, []).append(np.frombuffer(r[0], np.float64))
        wanted[len(r[0]) // 8] = r[1]
    return {d: spread_out(np.stack(rows), wanted[d], APART * np.arccos(threshold)) for d, rows in found.items()}


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimension, row numbers and vectors (n x dimension) of the rows of a batch, for each dimension in it."""
    raw = [np.frombuffer(x, np.float64) for x in column(batch, "v").to_pylist()]
    sizes = np.array([len(x) for x in raw])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, np.stack([raw[i] for i in at])


def hot_pivots(classes: DataFrame, pivots: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Numbers of the pivots, of each dimension, that are the nearest of at least ``HOT`` classes."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                for size, _, v in _by_size(batch.slice(start, SLICE_ROWS)):
                    pivot, n = np.unique((v @ shared.value[size].T).argmax(axis=1), return_counts=True)
                    yield pa.record_batch({"size": pa.array([size] * len(n), pa.int32()), "pivot": pa.array(pivot, pa.int32()), "n": pa.array(n, pa.int64())})

    counts = classes.select("v").mapInArrow(rows, "size int, pivot int, n long").groupBy("size", "pivot").agg(F.sum("n").alias("n"))
    found: dict[int, list] = {size: [] for size in pivots}
    for r in counts.where(F.col("n") >= HOT).orderBy("size", "pivot").collect():
        found[r[0]].append(r[1])
    return {size: np.array(p, np.int64) for size, p in found.items()}


def unit_vectors(table: DataFrame) -> DataFrame:
    """``(vec_id, label, key, v)`` for rows that can link: v is the unit vector in double precision, key names its class.

    ``key`` is a hash of the label and the vector's values; equal vectors of a label share it.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "embedding")
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            sizes = np.array(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            ends = np.cumsum(sizes)
            out, keep = [], []
            for i, (e, n) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
                x = flat[e - n:e]
                if not n or not np.isfinite(x).all():  # a null component reads as NaN
                    continue
                top = np.abs(x).max()
                if top == 0:
                    continue
                x = x / top
                out.append(x / np.sqrt(x @ x))
                keep.append(i)
            part = batch.take(pa.array(keep, pa.int64()))
            values = np.concatenate(out) if out else np.zeros(0)
            yield pa.record_batch({"vec_id": column(part, "vec_id"), "label": column(part, "label"),
                                   "v": binary_array(values, [len(x) for x in out])})

    clean = table.where("label is not null and embedding is not null").select(
        "vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    made = clean.mapInArrow(rows, "vec_id long, label string, v binary")
    return made.withColumn("key", F.xxhash64("label", "v"))


def described(classes: DataFrame, pivots: dict[int, np.ndarray], hot: dict[int, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """``(label, key, weight, v, pivot, near, home)``, a row for each list a class enters.

    An exact list has the number -1 - p of its hot pivot p; home: the class is a member, not a visitor.  An inverted list
    has the number of its pivot; near: the pivots of the class, nearest first.
    """
    shared = classes.sparkSession.sparkContext.broadcast((pivots, hot))
    angle = np.arccos(threshold)
    inside, around = np.cos(min(COVERED * angle, np.pi)), np.cos(min((COVERED + 1) * angle, np.pi)) - 1e-9
    beyond = np.sin(min(angle, np.pi / 2))

    def lists_of(v: np.ndarray, size: int, gaps: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, list, near and home of every entry."""
        points, busy = (x[size] for x in shared.value)
        like = v @ points.T
        rest = np.arange(len(v))
        row, place, home = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        if len(busy):
            crowd = like[:, busy]
            first = crowd.argmax(axis=1)
            best = crowd[rest, first]
            member = best >= inside
            enters = (crowd >= around) & (best[:, None] - crowd <= beyond * gaps[first] + 1e-9)
            enters &= ~member[:, None] | (np.arange(len(busy))[None] < first[:, None])  # of two members the smaller list takes the pair
            enters[member, first[member]] = True
            row, place = np.nonzero(enters)
            home = member[row] & (place == first[row])
            rest = np.flatnonzero(~member)
        order = np.argsort(-like[rest], axis=1, kind="stable")[:, :NEAREST]
        near = np.full((len(v), NEAREST), -1, np.int16)  # -1: the dimension has fewer pivots
        near[rest[:, None], np.arange(order.shape[1])] = order
        again, at = np.nonzero(near[:, :LOOKED_UP] >= 0)
        numbers = np.concatenate([-1 - busy[place], near[again, at]]) if len(busy) else near[again, at]
        return np.concatenate([row, again]), numbers, near, np.concatenate([home, np.ones(len(again), bool)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps: dict[int, np.ndarray] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                for size, at, v in _by_size(batch):
                    if size not in gaps:
                        busy = shared.value[0][size][shared.value[1][size]]
                        gaps[size] = np.sqrt(np.maximum(2 - 2 * (busy @ busy.T), 0))
                    row, pivot, near, home = lists_of(v, size, gaps[size])
                    for cut in range(0, len(row), 4 * SLICE_ROWS):
                        part = slice(cut, cut + 4 * SLICE_ROWS)
                        again = pa.array(at[row[part]])
                        yield pa.RecordBatch.from_arrays(
                            [*[column(batch, c).take(again) for c in ("label", "key", "weight", "v")], pa.array(pivot[part].astype(np.int32)),
                             binary_array(near[row[part]].ravel(), [NEAREST] * len(again)), pa.array(home[part])],
                            names=["label", "key", "weight", "v", "pivot", "near", "home"])

    return classes.select("label", "key", "weight", "v").mapInArrow(
        rows, "label string, key long, weight long, v binary, pivot int, near binary, home boolean")


def list_links(block: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Of one block pair: keys that have links, how many rows each links with, and a spanning forest of the links."""
    pivot, p, q = block.column("pivot")[0].as_py(), block.column("p")[0].as_py(), block.column("q")[0].as_py()
    key, weight, own = (block.column(c).to_numpy() for c in ("key", "weight", "own"))
    near = np.stack([np.frombuffer(x, np.int16) for x in block.column("near").to_pylist()])
    home = block.column("home").to_numpy()
    raw = block.column("v").to_pylist()
    n = len(key)
    size = np.array([len(x) for x in raw])  # vectors of different dimensions do not link
    counts = np.zeros(n, np.int64)
    edges: list[tuple[int, int]] = []
    for length in np.unique(size):
        rows = np.flatnonzero(size == length)
        v = np.stack([np.frombuffer(raw[i], np.float64) for i in rows])
        root = np.arange(len(rows))
        if pivot >= 0:
            named = near[rows]
            pivots = int(named.max()) + 1
            shared = min(SHARED, int((named >= 0).sum(axis=1).max()))  # a dimension may have fewer pivots
            member = np.zeros((len(rows), pivots + 1), np.float32)
            member[np.arange(len(rows))[:, None], named] = 1.0
            member[:, -1] = 0.0  # -1: no pivot
            looked = np.zeros((len(rows), pivots + 1), np.float32)
            looked[np.arange(len(rows))[:, None], named[:, :LOOKED_UP]] = 1.0
            looked[:, -1] = 0.0
        for a in range(0, len(rows), 256):
            left = slice(a, a + 256)
            if pivot < 0:
                may = home[rows[left]][:, None] | home[rows][None]
            else:
                may = member[left] @ member.T >= shared
                may &= looked[left, :pivot] @ looked[:, :pivot].T == 0  # the list of the smallest shared pivot takes the pair
            if p != q:
                may &= own[rows[left]][:, None] < own[rows][None]
            else:
                may &= np.arange(len(rows))[left, None] < np.arange(len(rows))[None]
            like = v[left] @ v.T
            may &= like >= threshold - 1e-9
            i, j = np.nonzero(may & (like < threshold + 1e-9))  # too near to the threshold for the order of a product's sums
            may[i, j] = np.einsum("ij,ij->i", v[a + i], v[j]) >= threshold
            counts[rows[left]] += may @ weight[rows]
            counts[rows] += may.T @ weight[rows[left]]
            for x in np.flatnonzero(may.any(axis=1)):
                linked = np.flatnonzero(may[x])
                roots, first = np.unique(root[linked], return_index=True)
                mine = root[a + x]
                if len(roots) == 1 and roots[0] == mine:
                    continue
                edges += [(int(rows[a + x]), int(rows[linked[f]])) for r, f in zip(roots, first, strict=True) if r != mine]
                root[np.isin(root, roots) | (root == mine)] = min(mine, roots[0])
    some = np.flatnonzero(counts)
    return key[some], counts[some], key, edges


def links_of(lists: DataFrame, threshold: float) -> DataFrame:
    """``(key, n, other)``: link counts of classes per block (other null), and spanning links (n 0)."""
    size = lists.groupBy("label", "pivot").agg(F.count("*").alias("m"), F.max("home").alias("any")).where("m > 1 and `any`").drop("any")
    blocks = F.ceil(F.col("m") / BLOCK_ROWS).cast("int")
    rows = lists.join(size, ["label", "pivot"]).withColumn("own", F.pmod(F.xxhash64("key"), blocks).cast("int"))
    rows = (rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other")).drop("other", "m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, ["label", "pivot", "p", "q"]):
            keys, counts, key, edges = list_links(block, threshold)
            x, y = ([key[e[k]] for e in edges] for k in (0, 1))
            yield pa.record_batch({"key": pa.array([*keys.tolist(), *x], pa.int64()), "n": pa.array([*counts.tolist(), *[0] * len(x)], pa.int64()),
                                   "other": pa.array([*[None] * len(keys), *y], pa.int64())})

    spread = rows.repartition("label", "pivot", "p", "q").sortWithinPartitions("label", "pivot", "p", "q", "key")
    return spread.mapInArrow(run, "key long, n long, other long")


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``table`` (vec_id, embedding, label): ``n_links``, ``component_id`` and ``kept``.

    Equal rows (same id and values) are different rows and link.  Components go over rows; a component's id is its
    smallest non-null ``vec_id``; rows that link with nothing have their own.  An empty table gives no rows.
    """
    table = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    vectors = materialize(unit_vectors(table), "pivot-vectors")
    classes = vectors.groupBy("key").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    distinct = materialize(vectors.dropDuplicates(["key"]).select("key", "label", "v").join(classes, "key"), "pivot-classes")
    pivots = pivots_of(distinct, threshold)
    lists = described(distinct, pivots, hot_pivots(distinct, pivots), threshold)
    found = materialize(links_of(lists, threshold), "pivot-links")
    comps = connected_components(found.where("other is not null"), "key", "other").withColumnRenamed("node", "key")
    counts = found.where("n > 0").groupBy("key").agg(F.sum("n").alias("n"))
    told = (distinct.select("key", "weight", "least").join(counts, "key", "left").join(comps, "key", "left")
            .select("key", "least", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "key").alias("comp")))
    told = materialize(told, "pivot-told")
    smallest = told.groupBy("comp").agg(F.min("least").alias("component_id"))
    per_key = told.join(smallest, "comp").select("key", "n_links", "component_id")
    linked = vectors.select("vec_id", "key").join(per_key, "key").select("vec_id", "n_links", "component_id")
    whole = F.coalesce(F.forall(F.col("embedding"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    zero = F.coalesce(~F.exists(F.col("embedding"), lambda x: x != 0), F.lit(True))
    doubles = table.withColumn("embedding", F.col("embedding").cast("array<double>"))
    alone = (doubles.where(F.col("label").isNull() | ~whole | zero)
             .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    rows = linked.unionByName(alone)
    return rows.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
