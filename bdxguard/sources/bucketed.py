"""Tables laid out by key (S6, S9): bucketed Parquet whose joins and aggregates on the key need no shuffle of the table.

The layout (keys, number of buckets, schema) is a property of the table: it is kept in a hidden file of the table's folder,
so any session can read it again without a shared catalog.  A reader registers the folder under a name made from its path.

Bucketing fixes which task reads a key.  A table in which one key holds a large part of the rows would give one task all
of them, so ``read_bucketed`` compares the bucket sizes and hands out a plain scan of the same rows where one bucket is
far above the others: the join then shuffles, and the skew join splits the key.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import _hadoop, folders

LAYOUT = "_layout.json"
#: Compressed bytes of a bucket: a task holds the groups of a whole bucket, many times as large in memory.
BUCKET_BYTES = 16 << 20
#: A bucket is too large for one task if it is above both this many times the mean and BUCKET_BYTES.
SKEW_FACTOR = 5


def buckets_for(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for an expected table size: a power of two, so a later layout can be split or merged evenly."""
    return 1 << max(0, (max(size, 1) - 1) // bucket_bytes).bit_length()


def layout(spark: SparkSession, path: str) -> dict:
    """Keys, number of buckets and schema of a bucketed table."""
    fs, p = _hadoop(spark, f"{path.rstrip('/')}/{LAYOUT}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _register(spark: SparkSession, path: str, found: dict) -> str:
    name = "bucketed_" + hashlib.sha256(f"{path}\n{json.dumps(found, sort_keys=True)}".encode()).hexdigest()[:24]
    if not spark.catalog.tableExists(name):
        ddl = spark._jvm.org.apache.spark.sql.types.StructType.fromJson(json.dumps(found["schema"])).toDDL()
        keys = ", ".join(f"`{k}`" for k in found["keys"])
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({keys}) INTO {found['buckets']} BUCKETS LOCATION '{where}'")
    return name


def append_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Append rows to a bucketed table; the first call fixes its keys, buckets and columns.

    Later calls must give the same columns (in any order) and use the stored layout whatever ``buckets`` says; other keys
    raise.  Rows are brought together by bucket before the write, and a bucket that holds far more than the others is
    written by several tasks.  Rows with null keys are kept.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if LAYOUT in folders(spark, path):
        found = layout(spark, path)
        if found["keys"] != list(keys):
            raise ValueError(f"{path} is laid out by {found['keys']}, not {list(keys)}")
    else:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        found = {"keys": list(keys), "buckets": buckets, "schema": json.loads(schema.json())}
        fs, p = _hadoop(spark, f"{path}/{LAYOUT}")
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps(found).encode()))
        finally:
            out.close()
    name = _register(spark, path, found)
    columns = [f["name"] for f in found["schema"]["fields"]]
    df.select(*columns).hint("rebalance", found["buckets"], *found["keys"]).write.insertInto(name)


def bucket_sizes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes per bucket, from the names of the files that Spark's writer gives them."""
    fs, p = _hadoop(spark, path)
    sizes: dict[int, int] = {}
    for s in fs.listStatus(p):
        m = re.search(r"_(\d{5,})(?:\.c\d+)?(?:\..*)?$", s.getPath().getName())
        if m and s.getPath().getName().startswith("part-"):
            sizes[int(m.group(1))] = sizes.get(int(m.group(1)), 0) + s.getLen()
    return sizes


def read_bucketed(spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Scan of a bucketed table: bucketed, or plain where one bucket is too large for one task; the rows are the same."""
    path = path.rstrip("/")
    found = layout(spark, path)
    sizes = bucket_sizes(spark, path)
    largest, mean = max(sizes.values(), default=0), sum(sizes.values()) / found["buckets"]
    if largest > bucket_bytes and largest > SKEW_FACTOR * mean:
        return spark.read.schema(T.StructType.fromJson(found["schema"])).parquet(path)
    name = _register(spark, path, found)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def aligned(df: DataFrame, path: str) -> DataFrame:
    """The other side of a join with a bucketed table, shuffled as its buckets are.

    Without it the planner takes the wider of the two partitionings, and shuffles a table with fewer buckets than
    ``spark.sql.shuffle.partitions``.
    """
    found = layout(df.sparkSession, path)
    return df.repartition(found["buckets"], *found["keys"])


def restrict_to_keys(spark: SparkSession, path: str, wanted: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """S6 on a bucketed table: its rows with one of the wanted keys; only the keys are shuffled.  Null keys match nothing."""
    keys = layout(spark, path)["keys"]
    return read_bucketed(spark, path, bucket_bytes).join(aligned(wanted.select(*keys).distinct(), path), keys, "left_semi")
