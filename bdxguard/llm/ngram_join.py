"""N-gram Jaccard join: links every two texts whose sets of word shingles overlap enough.

Two texts link when ``100 * |A & B| >= percent * |A | B|`` over their distinct
5-word shingles (64-bit hashes of the lower-cased words; a shorter text is one
shingle).  The join is exact up to collisions of those hashes.

1. Each text gives its sorted shingle set, its size band, a parity bitmap of
   hashed shingles whose width follows the size, and its *leading* shingles:
   in one order shared by all texts, the first ``|A| - ceil(p|A|) + 1``.  Two
   texts that link share a leading shingle, whatever the order.  The order puts
   shingles that a sample shows to be frequent last, so a passage that many
   texts repeat leads almost none of them; the sample changes cost, not results.
2. A leading shingle met in two different sets opens tiles ``(shingle, band)``.
   A text stands in the tile of its own band and visits the one below, so each
   pair of compatible sizes meets there; a crowded tile is cut into block pairs.
3. In a tile, bit counts of the XOR of two bitmaps bound the overlap from above:
   ``|A & B| <= (|A| + |B| - bits) / 2``.  So does the place of the shingle: at the first
   one two sets share, both must still have the overlap they need ahead.  Pairs that
   fail a bound end there.
4. The rest is decided by intersecting the sorted arrays.

Large groups of near copies would fill their tiles with pairs that all link.
So first each set is tried against a hub of its tiles (twice); what links there
is one component already, and tiles only compare sets of different components.
Results are classes: equal sets, and components over all links.

Nulls: a null or blank text has an empty set and links with nothing.  Rows with
a null ``doc_id`` take part; a component's id is its smallest non-null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .arrow import binary_array, column, groups, slices, text_view
from .components import connected_components
from .words import mix, shingle_hashes, split, word_hashes

#: Below this number of rows a table of ids is broadcast; above it the join shuffles.
BROADCAST_IDS = 500_000
#: At most so many frequent shingles are kept for the order (8 bytes each); fewer only cost time.
FREQUENT_MAX = 131_072
#: One in so many texts is looked at to find them; a shingle in FREQUENT_MIN of those texts counts as frequent.
SAMPLE_ONE_IN = 32
FREQUENT_MIN = 4
#: Rows of a tile above which it is cut into blocks of about this size.
BLOCK_ROWS = 2048
#: Bytes of text that a task hashes at once; its arrays take some forty times that.
TEXT_BYTES = 1 << 18
#: Pairs of a tile looked at side by side, and words of their bitmaps compared side by side: bound a task's memory.
TILE_PAIRS = 1 << 18
TILE_WORDS = 1 << 19


def sets_of(batch: pa.RecordBatch, text: str, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a batch."""
    data, offsets = text_view(column(batch, text))
    words, counts = word_hashes(data, offsets)
    flat, per = shingle_hashes(words, counts, size)
    return [np.unique(s) for s in split(flat, per)]


def set_key(s: np.ndarray) -> int:
    """64-bit key of a set; equal sets have equal keys, 0 is the empty set."""
    if not len(s):
        return 0
    h = mix(np.array([mix(s).sum(dtype=np.uint64), len(s)], np.uint64), 3)
    return int((h[0] ^ (h[1] << np.uint64(1))).view(np.int64)) or 1


def bitmap_width(n: int) -> int:
    """Bits of the parity bitmap of a set of n shingles: a power of two of 2n or more, 256 at least."""
    return max(256, 1 << (2 * n - 1).bit_length())


def parity_bitmap(s: np.ndarray, width: int) -> np.ndarray:
    """Bit i is the parity of the number of shingles hashed to i; halves XOR into the bitmap of half the width."""
    odd = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little")


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of bitmaps (uint64 words) folded to a smaller width."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def leading_count(n: int, percent: int) -> int:
    """Number of leading shingles needed so that linked sets share one."""
    return n - -(-percent * n // 100) + 1


def _leading(s: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    k = leading_count(len(s), percent)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        common = frequent[at] == s
        rare = s[~common]
        return rare[:k] if len(rare) >= k else np.concatenate([rare, s[common][:k - len(rare)]])
    return s[:k]


def frequent_shingles(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """Sorted hashes of shingles found in several of the sampled texts; at most FREQUENT_MAX.

    Only orders the shingles: any outcome gives the same links.
    """
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", TEXT_BYTES):
                sets = sets_of(part, "t", size)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.record_batch({"shingle": pa.array(flat.view(np.int64))})

    sample = docs.select(F.col(text).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(SAMPLE_ONE_IN)) == 0)
    counts = sample.distinct().mapInArrow(shingles, "shingle long").groupBy("shingle").count()
    top = (counts.where(F.col("count") >= FREQUENT_MIN).orderBy(F.desc("count"), "shingle").limit(FREQUENT_MAX)
           .select("shingle").collect())
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def describe(docs: DataFrame, text: str, size: int, percent: int, frequent: np.ndarray, keep: list[str]) -> DataFrame:
    """Per text: kept columns, ``th`` (hash of the text), key, n, bitmap and leading shingles of its set."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__t", TEXT_BYTES):
                sets = sets_of(part, "__t", size)
                lead = [_leading(s, shared.value, percent) if len(s) else s for s in sets]
                bits = [parity_bitmap(s, bitmap_width(len(s))) if len(s) else np.zeros(0, np.uint8) for s in sets]
                ends = np.zeros(len(lead) + 1, np.int32)
                np.cumsum([len(x) for x in lead], out=ends[1:])
                values = np.concatenate(lead).view(np.int64) if lead else np.zeros(0, np.int64)
                out = {c: column(part, c) for c in keep}
                out["th"] = column(part, "th")
                out["key"] = pa.array([set_key(s) for s in sets], pa.int64())
                out["n"] = pa.array([len(s) for s in sets], pa.int32())
                out["bitmap"] = binary_array(np.concatenate(bits) if bits else np.zeros(0, np.uint8), [len(b) for b in bits])
                out["lead"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.record_batch(out)

    d = docs.select(*keep, F.col(text).alias("__t"), F.xxhash64(text).alias("th"))
    kept = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    return d.mapInArrow(rows, f"{kept}, th long, key long, n int, bitmap binary, lead array<long>")


def _ids(df: DataFrame) -> DataFrame:
    """A table of ids, broadcast only when its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


class _Join:
    """The steps of one join over a table of texts."""

    def __init__(self, docs: DataFrame, text: str, size: int, percent: int, keep: list[str]):
        self.docs, self.text, self.size, self.percent = docs, text, size, percent
        frequent = frequent_shingles(docs, text, size)
        self.sets = materialize(describe(docs, text, size, percent, frequent, keep), "ngram-sets")
        self.bitmaps = materialize(self.sets.where("n > 0").select("key", "n", "bitmap").dropDuplicates(["key"]), "ngram-bitmaps")

    def postings(self) -> DataFrame:
        """``(shingle, key, n, pos)`` for leading shingles that two different sets share, each once; pos: place in the order."""
        rows = self.sets.where("n > 0").select(F.posexplode("lead").alias("pos", "shingle"), "key", "n")
        met = rows.groupBy("shingle").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi")
        met = materialize(met.select("shingle"), "ngram-met")
        return rows.join(met, "shingle", "left_semi").distinct()

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs of keys whose bitmaps leave room for the overlap they need, with the most they may share (``room``)."""
        percent = self.percent
        left = self.bitmaps.toDF("a", "na", "ba")
        right = self.bitmaps.toDF("b", "nb", "bb")

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                both = column(batch, "na").to_numpy().astype(np.int64) + column(batch, "nb").to_numpy()
                bits = np.zeros(batch.num_rows, np.int64)
                for i, (x, y) in enumerate(zip(column(batch, "ba"), column(batch, "bb"), strict=True)):
                    x, y = np.frombuffer(x.as_py(), np.uint64)[None], np.frombuffer(y.as_py(), np.uint64)[None]
                    w = min(x.shape[1], y.shape[1])
                    bits[i] = np.bitwise_count(fold(x, w) ^ fold(y, w)).sum()
                most = (both - bits) // 2
                keep = (100 + percent) * most >= percent * both
                out = batch.select(["a", "b"]).add_column(2, "room", pa.array(most / np.maximum(both - most, 1)))
                yield out.filter(pa.array(keep))

        joined = pairs.join(left, "a").join(right, "b")
        return joined.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(test, "a long, b long, room double")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs of keys whose sets link, by intersecting the sorted arrays. Sets are recomputed from the texts."""
        size, percent = self.size, self.percent
        pairs = materialize(pairs, "ngram-pairs")
        needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        texts = (self.sets.join(needed, "key", "left_semi").groupBy("key").agg(F.min("th").alias("th")))
        texts = materialize(texts.select("th").distinct(), "ngram-texts")

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "t", TEXT_BYTES):
                    found = sets_of(part, "t", size)
                    flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
                    yield pa.record_batch({"key": pa.array([set_key(s) for s in found], pa.int64()),
                                           "s": binary_array(flat, [len(s) for s in found])})

        def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.zeros(batch.num_rows, bool)
                for i, (x, y) in enumerate(zip(column(batch, "sa"), column(batch, "sb"), strict=True)):
                    x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                    if len(x) > len(y):
                        x, y = y, x
                    at = np.searchsorted(y, x)
                    both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                    keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

        source = self.docs.select(F.col(self.text).alias("t"), F.xxhash64(self.text).alias("th"))
        arrays = (source.join(_ids(texts), "th", "left_semi").select("t").mapInArrow(sets, "key long, s binary")
                  .dropDuplicates(["key"]))
        joined = pairs.join(arrays.toDF("a", "sa"), "a").join(arrays.toDF("b", "sb"), "b")
        return joined.select("a", "b", "sa", "sb").mapInArrow(intersect, "a long, b long")

    def hub_pairs(self, rows: DataFrame, first: bool) -> DataFrame:
        """For each set one set of another component: of the hubs of its tiles, the one it may overlap most.

        A tile's hubs are two of its sets: at first any, later one of its smallest and one of its largest component.
        """
        percent = self.percent
        rows = rows.withColumn("band", self.band())
        order = [F.xxhash64("key", "shingle").alias("any"), "comp"]  # another set in each tile
        member = F.struct(*(order if first else order[::-1]), "key", "n", "pos")
        hubs = rows.groupBy("shingle", "band").agg(F.min(member).alias("lo"), F.max(member).alias("hi")).where("lo.comp != hi.comp")
        hub = F.when(F.col("comp") != F.col("lo.comp"), F.col("lo")).otherwise(F.col("hi"))
        met = rows.join(hubs, ["shingle", "band"]).withColumn("hub", hub)
        need = (F.col("n") + F.col("hub.n")) * percent
        met = met.where((F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * percent)
                        & (F.least(F.col("n") - F.col("pos"), F.col("hub.n") - F.col("hub.pos")) * (100 + percent) >= need))
        pairs = self.bounded(met.select(F.col("key").alias("a"), F.col("hub.key").alias("b")).distinct())
        best = pairs.groupBy("a").agg(F.max(F.struct("room", "b")).alias("best"))
        return best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()

    def band(self) -> Column:
        """Size band of a row with ``n``: sizes that can link are in the same or in neighbouring bands."""
        return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / self.percent)) + 1e-9).cast("int")

    def tile_pairs(self, rows: DataFrame) -> DataFrame:
        """All pairs of sets of different components that meet in a tile and pass the bound."""
        percent = self.percent
        live = rows.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
        rows = rows.join(live.select("shingle"), "shingle", "left_semi")
        band = self.band()
        rows = rows.withColumn("band", band).withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
        rows = rows.withColumn("home", F.col("band") == band)
        tiles = (rows.groupBy("shingle", "band").agg(F.count("*").alias("m"), F.min("comp").alias("lo"),
                                                     F.max("comp").alias("hi"), F.max("home").alias("any"))
                 .where("`any` and lo < hi").select("shingle", "band", "m"))
        rows = rows.join(tiles, ["shingle", "band"])
        blocks = F.ceil(F.col("m") / BLOCK_ROWS).cast("int")
        own = F.pmod(F.xxhash64("key"), blocks).cast("int")
        rows = (rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                .select("shingle", "band", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                        "own", "home", "key", "n", "pos", "comp"))
        rows = rows.join(self.bitmaps.select("key", "bitmap"), "key")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for tile in groups(batches, ["shingle", "band", "p", "q"]):
                a, b = tile_candidates(tile, percent)
                if len(a):
                    yield pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

        spread = rows.repartition("shingle", "band", "p", "q").sortWithinPartitions("shingle", "band", "p", "q", "n", "key")
        return spread.mapInArrow(compare, "a long, b long").distinct()

    def links(self) -> DataFrame:
        """Pairs of keys of different sets that link; with equal sets they give all components."""
        spark = self.docs.sparkSession
        postings = materialize(self.postings(), "ngram-postings")
        found = spark.createDataFrame([], "a long, b long")
        comps = spark.createDataFrame([], "node long, component long")
        for turn in range(2):
            new = self.verified(self.hub_pairs(_with_component(postings, comps), turn == 0))
            found = materialize(found.unionByName(new), "ngram-links")
            comps = materialize(connected_components(found), "ngram-comps")
        rest = self.verified(self.tile_pairs(_with_component(postings, comps)))
        return materialize(found.unionByName(rest), "ngram-links")


def _with_component(rows: DataFrame, comps: DataFrame) -> DataFrame:
    comps = comps.select(F.col("node").alias("key"), "component")
    return rows.join(comps, "key", "left").select(*rows.columns, F.coalesce("component", "key").alias("comp"))


def tile_candidates(tile: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pairs of a tile that may link: other component, sizes and bitmaps allow it, one at home at least."""
    get = lambda c: tile.column(c).to_numpy()
    key, n, comp = get("key"), get("n").astype(np.int64), get("comp")
    after = n - get("pos")  # shingles from this one on, in the common order
    home, own, p, q = get("home").astype(bool), get("own"), get("p")[0], get("q")[0]
    raw = [np.frombuffer(x, np.uint64) for x in tile.column("bitmap").to_pylist()]
    width = np.array([len(x) for x in raw])
    bits = {int(w): np.stack([raw[i] for i in np.flatnonzero(width == w)]) for w in np.unique(width)}
    rows = {w: np.flatnonzero(width == w) for w in bits}
    out_a, out_b = [], []
    widths = sorted(bits)
    for w in widths:
        for v in (x for x in widths if x >= w):
            right, ri = fold(bits[v], w), rows[v]
            many, most = max(1, TILE_PAIRS // len(ri)), max(1, TILE_WORDS // w)
            for c in range(0, len(rows[w]), many):
                li = rows[w][c:c + many]
                lo, hi = np.minimum(n[li, None], n[None, ri]), np.maximum(n[li, None], n[None, ri])
                may = (comp[li, None] != comp[None, ri]) & (lo * 100 >= hi * percent) & (home[li, None] | home[None, ri])
                may &= (100 + percent) * np.minimum(after[li, None], after[None, ri]) >= percent * (lo + hi)
                if v == w:
                    may &= li[:, None] < ri[None]
                if p != q:
                    may &= own[li, None] != own[None, ri]
                i, j = np.nonzero(may)
                for s in range(0, len(i), most):
                    x, y = i[s:s + most], j[s:s + most]
                    left = bits[w][c:c + many]
                    differ = np.bitwise_count(left[x] ^ right[y]).sum(axis=1, dtype=np.int64)
                    both = n[li[x]] + n[ri[y]]
                    ok = (100 + percent) * ((both - differ) // 2) >= percent * both
                    out_a.append(key[li[x[ok]]])
                    out_b.append(key[ri[y[ok]]])
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_a) if out_a else none), (np.concatenate(out_b) if out_b else none)


def _placed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row: doc_id, th (hash of the text), n, key of its set and node (its component of sets)."""
    join = _Join(docs, "text", size, percent, ["doc_id"])
    comps = connected_components(join.links()).withColumnRenamed("node", "key")
    rows = join.sets.select("doc_id", "th", "n", "key").join(comps, "key", "left")
    return materialize(rows.select("doc_id", "th", "n", "key", F.coalesce("component", "key").alias("node")), "ngram-placed")


def ngram_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: its id, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``set_key``.

    Empty table: no rows.  Equal rows are equal sets and link.  A row with an empty set is its own component.
    Further columns of ``docs`` are not read, whatever their names.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    placed = _placed(docs, size, percent)
    least = placed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    linked = placed.where("n > 0").join(least, "node")
    alone = placed.where("n = 0").withColumn("least", F.col("doc_id"))
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("least").alias("component_id"),
               F.col("key").alias("set_key")]
    return linked.select(*columns).unionByName(alone.select(*columns))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (columns ``doc_id``, ``text`` and any others) that stay when one row of each component is kept.

    The row with the smallest non-null ``doc_id`` stays, then the smallest text hash, and one of equal rows.
    Rows with an empty set all stay: they link with nothing.
    """
    placed = _placed(docs.select("doc_id", F.col("text").cast("string").alias("text")), size, percent).where("n > 0")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")
    first = placed.groupBy("node").agg(F.min(rank).alias("first"))
    told = (placed.groupBy("node", "doc_id", "th").agg(F.count("*").alias("copies")).join(first, "node")
            .select("doc_id", "th", "copies", (rank == F.col("first")).alias("stays")))
    told = materialize(told.where("not stays or copies > 1"), "ngram-told")
    gone, twice = told.where("not stays").select("doc_id", "th"), told.where("stays").select("doc_id", "th")

    def matched(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = _ids(keys.toDF("gone_id", "gone_th"))
        return rows.join(keys, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("th") == F.col("gone_th")), how)

    # every row as one column: no column of docs can clash with those the joins need
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                       F.xxhash64(F.col("text").cast("string")).alias("th"))
    single = matched(matched(rows, gone, "left_anti"), twice, "left_anti")
    repeated = matched(rows, twice, "left_semi").dropDuplicates(["id", "th"])
    return single.unionByName(repeated).select("row.*")
