"""Token ids in training order: fixed-stride binary shards, read sequentially and resumed at any slot.

Every document's ids are cut into sequences of ``length`` ids.  All sequences get a dense index (documents in order
of share, id and text hash; pieces in order), and a keyed Feistel permutation of the indexes, with cycle-walking to
stay within their number, gives each its slot in the training order.  Shard k holds the slots from ``k * per_shard``
on, one record after the other, each of ``stride`` bytes:

    doc_id  int64 | piece int32 | n int32 | n ids, zeros up to length          (little-endian)

so slot s lies at byte ``(s % per_shard) * stride`` of shard ``s // per_shard``: a reader that stopped at a slot
goes on there, without an index.

The permutation is a function of index and key, so nothing is sorted globally to shuffle: the slot is computed where
the text is, and rows are dealt to ranges of slots once.  On that way each sequence is compressed by zstd with one
dictionary, trained on the sequences of at most ``SAMPLE_DOCS`` documents; it changes the size of the shuffle and
nothing else.  A shard is written under a temporary name and then renamed; its bytes depend on its slots only, so a
task that runs twice writes the same file.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.tables import materialize
from .arrow import column, groups, text_view
from .words import mix

LENGTH = 512
PER_SHARD = 16384
KEY = 0x5EED
ROUNDS = 4
SHARE_DOCS = 4096
#: Documents up to which the table of their first indexes is broadcast; beyond it the join shuffles.
BROADCAST_DOCS = 500_000
SAMPLE_DOCS = 256
DICTIONARY_BYTES = 1 << 15
LEVEL = 3
#: Bytes of shards that a task reads back.
READ_BYTES = 1 << 27
_HEAD = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("n", "<i4")])


def feistel(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """A permutation of ``range(total)``, evaluated at each index."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left, right = x >> shift, x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (mix(right, (key * ROUNDS + r) & 0xFFFFFFFF) & mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= np.uint64(total)]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """What a reader needs to know of a folder of shards."""

    folder: str
    total: int
    length: int
    per_shard: int
    itemsize: int

    @property
    def stride(self) -> int:
        return _HEAD.itemsize + self.length * self.itemsize

    def path(self, shard: int) -> str:
        return f"{self.folder.rstrip('/')}/shard-{shard:08d}.bin"

    def place(self, slot: int) -> tuple[str, int]:
        """File and byte offset of a slot."""
        return self.path(slot // self.per_shard), slot % self.per_shard * self.stride


def byte_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte-level vocabulary: id = byte."""
    return data, np.diff(offsets)


Encoder = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _file_system(folder: str):
    fs, path = pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "", 1))
    return fs, path


def write_shards(docs: DataFrame, folder: str, encode: Encoder = byte_ids, n_ids: Column | None = None, itemsize: int = 1,
                 length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> tuple[Layout, DataFrame]:
    """Write the ids of all rows of ``docs`` (doc_id, text) as shards into ``folder``, a URI all executors share.

    ``encode`` gives the ids of many texts (bytes and offsets) and ``n_ids`` the number of ids of a row; both must
    agree.  ``itemsize``: bytes of a stored id.  Returns the layout and the manifest (shard, first_slot, records, sha256).

    Rows without ids (null or empty text) have no sequence.  A null ``doc_id`` is stored as the smallest int64.
    Repeated rows have sequences of their own.  An empty table gives no shard.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    count = F.octet_length(text) if n_ids is None else n_ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.coalesce(count, F.lit(0)).cast("long").alias("n"), text.alias("text"))
    light = rows.where("n > 0").groupBy("doc_id", "th").agg(F.count("*").alias("copies"), F.first("n").alias("n"))
    pieces = F.ceil(F.col("n") / length).cast("long")
    shares = max(1, -(-docs.count() // SHARE_DOCS))
    light = light.withColumn("pieces", pieces).withColumn("share", F.pmod(F.xxhash64("doc_id", "th"), F.lit(shares)).cast("int"))
    before = Window.partitionBy("share").orderBy("doc_id", "th").rowsBetween(Window.unboundedPreceding, -1)
    light = light.withColumn("at", F.coalesce(F.sum(F.col("pieces") * F.col("copies")).over(before), F.lit(0)))
    light = materialize(light.select("doc_id", "th", "copies", "pieces", "share", "at"), "slots-light")
    # Totals of the shares, one row for 4096 documents, summed up in order by a window over those few rows.
    sums = light.groupBy("share").agg(F.sum(F.col("pieces") * F.col("copies")).alias("total"))
    bases = sums.withColumn("base", F.coalesce(F.sum("total").over(Window.orderBy("share").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = sums.agg(F.sum("total")).first()[0] or 0
    layout = Layout(folder, int(total), length, per_shard, itemsize)
    indexed = materialize(light.join(bases.select("share", "base"), "share")
                          .select(F.col("doc_id").alias("i"), F.col("th").alias("h"), "copies", "pieces", (F.col("base") + F.col("at")).alias("first")), "slots-index")

    def joined(only: str) -> DataFrame:
        keys = indexed.where(only)
        keys = F.broadcast(keys) if keys.count() <= BROADCAST_DOCS else keys
        return rows.join(keys, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("h")))

    once = joined("copies = 1").select("doc_id", "text", "first")
    nth = F.row_number().over(Window.partitionBy("i", "h").orderBy("n")) - 1  # equal rows: any order is the same
    again = joined("copies > 1").withColumn("first", F.col("first") + nth * F.col("pieces")).select("doc_id", "text", "first")
    least = F.lit(-(1 << 63)).cast("long")
    few = indexed.orderBy(F.xxhash64("i", "h"), "i").limit(SAMPLE_DOCS).select(F.col("h").alias("th")).distinct()
    dictionary = _dictionary(rows.join(F.broadcast(few), "th", "left_semi").select("text"), encode, layout)
    sequences = once.unionByName(again).select(F.coalesce("doc_id", least).alias("doc_id"), "text", "first").mapInArrow(
        lambda batches: _sequences(batches, encode, layout, key, dictionary), "shard int, slot long, doc_id long, piece int, ids binary")
    spread = sequences.repartition("shard").sortWithinPartitions("shard", "slot")
    written = spread.mapInArrow(lambda batches: _write(batches, layout, dictionary), "shard int, first_slot long, records int, sha256 string")
    # One small file, not one for each task: on a plain file system every file costs a few processes started by its executor.
    return layout, materialize(written.hint("rebalance"), "slots-manifest")


def _dictionary(texts: DataFrame, encode: Encoder, layout: Layout) -> bytes:
    """A zstd dictionary for sequences like those of the given few texts; empty if they are too few to train on."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = layout.length * layout.itemsize
        for batch in batches:
            ids, per = encode(*text_view(column(batch, "text")))
            ends = np.cumsum(per).tolist()
            raw = [np.ascontiguousarray(ids[e - n:e].astype(f"<u{layout.itemsize}")).tobytes() for e, n in zip(ends, per.tolist(), strict=True)]
            some = [r[a:a + step] for r in raw for a in range(0, min(len(r), 32 * step), step)]
            yield pa.record_batch({"ids": pa.array(some, pa.binary())})

    samples = sorted(bytes(r[0]) for r in texts.mapInArrow(cut, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _shared(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def _sequences(batches: Iterator[pa.RecordBatch], encode: Encoder, layout: Layout, key: int, dictionary: bytes) -> Iterator[pa.RecordBatch]:
    from .arrow import slices

    kind = np.dtype(f"<u{layout.itemsize}")
    packer = zstandard.ZstdCompressor(LEVEL, write_dict_id=False, **_shared(dictionary))
    for batch in batches:
        for part in slices(batch, "text"):
            ids, per = encode(*text_view(column(part, "text")))
            ids = ids.astype(kind, copy=False)
            pieces = -(-per // layout.length)
            doc = np.repeat(np.arange(len(per)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            size = np.minimum(per[doc] - piece * layout.length, layout.length)
            slot = feistel(column(part, "first").to_numpy()[doc] + piece, layout.total, key)
            raw, ends = memoryview(np.ascontiguousarray(ids).view(np.uint8)), np.cumsum(size * layout.itemsize)
            packed = [packer.compress(raw[e - n:e]) for e, n in zip(ends.tolist(), (size * layout.itemsize).tolist(), strict=True)]
            yield pa.record_batch({
                "shard": pa.array((slot // layout.per_shard).astype(np.int32)), "slot": pa.array(slot),
                "doc_id": column(part, "doc_id").take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)),
                "ids": pa.array(packed, pa.binary())})


def _write(batches: Iterator[pa.RecordBatch], layout: Layout, dictionary: bytes) -> Iterator[pa.RecordBatch]:
    fs, _ = _file_system(layout.folder)
    unpacker = zstandard.ZstdDecompressor(**_shared(dictionary))
    for group in groups(batches, ["shard"]):
        shard = group.column("shard")[0].as_py()
        first = shard * layout.per_shard
        slots = group.column("slot").to_numpy()
        if not np.array_equal(slots, np.arange(first, min(first + layout.per_shard, layout.total))):
            raise ValueError(f"shard {shard} does not hold each of its slots once")
        parts = [unpacker.decompress(p) for p in group.column("ids").to_pylist()]
        data, size = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts], np.int64)
        out = np.zeros((len(slots), layout.stride), np.uint8)
        head = np.zeros(len(slots), _HEAD)
        head["doc_id"], head["piece"], head["n"] = group.column("doc_id").to_numpy(), group.column("piece").to_numpy(), size // layout.itemsize
        out[:, :_HEAD.itemsize] = head.view(np.uint8).reshape(len(slots), -1)
        body = out[:, _HEAD.itemsize:]
        body[np.arange(body.shape[1])[None] < size[:, None]] = data
        _, final = _file_system(layout.path(shard))
        temporary = f"{final}.{uuid.uuid4().hex}.tmp"
        fs.create_dir(final.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(temporary) as f:
            f.write(out)
        fs.move(temporary, final)
        yield pa.record_batch({"shard": pa.array([shard], pa.int32()), "first_slot": pa.array([first], pa.int64()),
                               "records": pa.array([len(slots)], pa.int32()), "sha256": pa.array([hashlib.sha256(out).hexdigest()])})


def read_slots(layout: Layout, start: int = 0, stop: int | None = None, batch: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slots ``start`` to ``stop`` in order, as ``(slots, heads, ids)`` of up to ``batch`` records; opens one shard at a time."""
    stop = layout.total if stop is None else min(stop, layout.total)
    kind = np.dtype(f"<u{layout.itemsize}")
    while start < stop:
        shard = start // layout.per_shard
        fs, path = _file_system(layout.path(shard))
        end = min(stop, (shard + 1) * layout.per_shard)
        with fs.open_input_file(path) as f:
            f.seek(layout.place(start)[1])
            while start < end:
                n = min(batch, end - start)
                raw = np.frombuffer(f.read(n * layout.stride), np.uint8).reshape(n, layout.stride)
                heads = np.ascontiguousarray(raw[:, :_HEAD.itemsize]).view(_HEAD).ravel()
                yield np.arange(start, start + n), heads, np.ascontiguousarray(raw[:, _HEAD.itemsize:]).view(kind)
                start += n


def read_back(spark: SparkSession, layout: Layout, manifest: DataFrame) -> DataFrame:
    """Every record of the shards, read back: slot, shard, byte offset, doc_id, piece, number of ids and their SHA-256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, records in zip(column(batch, "first_slot").to_pylist(), column(batch, "records").to_pylist(), strict=True):
                for slots, heads, ids in read_slots(layout, first, first + records, 4096):
                    raw = ids.view(np.uint8)
                    yield pa.record_batch({
                        "slot": pa.array(slots), "shard": pa.array((slots // layout.per_shard).astype(np.int32)),
                        "byte_offset": pa.array(slots % layout.per_shard * layout.stride), "doc_id": pa.array(heads["doc_id"].copy()),
                        "piece": pa.array(heads["piece"].copy()), "n_tokens": pa.array(heads["n"].copy()),
                        "ids_sha256": pa.array([hashlib.sha256(r[:n * layout.itemsize]).hexdigest() for r, n in zip(raw, heads["n"].tolist(), strict=True)], pa.string())})

    # A given number of partitions: by size the few rows of the manifest would all be joined into one task.
    tasks = max(1, -(-layout.total * layout.stride // READ_BYTES))
    spread = manifest.select("shard", "first_slot", "records").repartition(tasks)
    out = spread.mapInArrow(run, "slot long, shard int, byte_offset long, doc_id long, piece int, n_tokens int, ids_sha256 string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)).cast("long"), F.col("doc_id")))


def new_folder(spark: SparkSession) -> str:
    """A new folder for shards below the shared folder of the session."""
    return scratch_dir(spark, f"shards-{uuid.uuid4().hex[:12]}")
