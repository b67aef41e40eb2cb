"""Content digest of large files by byte ranges.

``binaryFile`` reads a file as one value, which ends at 2 GB and puts a file in
one task.  Larger files are read by a Python data source whose partitions are
byte ranges: each task opens its file through ``pyarrow.fs``, seeks, and hashes
leaves of LEAF_BYTES one after another, so it holds one leaf at a time.

The digest of a file is a tree over its leaves in their order: FAN digests in a
row make one of the next level, always LEVELS times.  It depends on the bytes
only, not on how they were cut into ranges, and no row ever holds more than FAN
digests.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LEAF_BYTES = 1 << 20
RANGE_BYTES = 1 << 27
#: 1024^3 leaves of 1 MB: far beyond any file.
FAN, LEVELS = 1024, 3


def _open(path: str):
    """File system and path for ``pyarrow.fs``: local folders, HDFS, S3 and GCS by their addresses."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    path = re.sub(r"^s3[an]://", "s3://", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass
class _Range(InputPartition):
    path: str
    length: int
    first: int
    leaves: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.least = options["path"], int(options.get("least", 0))
        self.leaf, self.range = int(options.get("leafbytes", LEAF_BYTES)), int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = _open(self.root)
        per = max(1, self.range // self.leaf)
        out: list[InputPartition] = []
        for f in store.get_file_info(fs.FileSelector(root, recursive=True)):
            hidden = any(part.startswith((".", "_")) for part in f.path[len(root):].split("/"))
            if f.type == fs.FileType.File and f.size >= max(self.least, 1) and not hidden:
                leaves = -(-f.size // self.leaf)
                out += [_Range(f.path, f.size, k, min(per, leaves - k)) for k in range(0, leaves, per)]
        return out or [_Range("", 0, 0, 0)]

    def read(self, part: _Range) -> Iterator[tuple]:
        if not part.leaves:
            return
        store, _ = _open(self.root)
        with store.open_input_file(part.path) as f:
            f.seek(part.first * self.leaf)
            for k in range(part.first, part.first + part.leaves):
                data = f.read(self.leaf)
                head = data.split(b"\n", 1)[0].decode(errors="replace") if k == 0 else None
                yield part.path, part.length, k, hashlib.md5(data).hexdigest(), head


class ByteRanges(DataSource):
    """Rows ``(path, length, leaf, digest, head)`` of all files below ``path`` with at least ``least`` bytes.

    Options: ``least``, ``leafBytes``, ``rangeBytes``.  ``head``: first line, with leaf 0.
    """

    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return "path string, length long, leaf long, digest string, head string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def plain_path(path) -> F.Column:
    """A path without scheme and doubled slashes: what ``binaryFile`` and ``pyarrow.fs`` name alike."""
    return F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z0-9+.-]+:(//[^/]*(?=/))?", ""), "^/+", "/")


def content_digests(spark: SparkSession, root: str, least: int, leaf_bytes: int = LEAF_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(plain_path, file_hash, head)`` of every file below ``root`` with at least ``least`` bytes."""
    spark.dataSource.register(ByteRanges)
    leaves = (spark.read.format("byte_ranges").option("least", least).option("leafBytes", leaf_bytes)
              .option("rangeBytes", range_bytes).load(root))
    return tree_digests(leaves, leaf_bytes)


def tree_digests(leaves: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """One digest per path from its leaves, level by level."""
    nodes = leaves.select("path", "length", F.col("leaf").alias("node"), "digest", "head")
    for _ in range(LEVELS):
        row = F.array_sort(F.collect_list(F.struct("node", "digest")))      # at most FAN
        nodes = nodes.groupBy("path", "length", F.expr(f"node div {FAN}").alias("node_")).agg(
            F.md5(F.array_join(F.transform(row, lambda x: x["digest"]), "")).alias("digest"), F.max("head").alias("head")).withColumnRenamed("node_", "node")
    whole = F.md5(F.concat_ws(":", F.lit("tree"), F.lit(leaf_bytes), "length", "digest"))
    return nodes.select(plain_path("path").alias("plain_path"), whole.alias("file_hash"), "head")
