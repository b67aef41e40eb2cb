"""Table sources and sinks: parquet tables, written intermediate tables.

``materialize`` writes a frame as a Parquet table under the shared checkpoint
folder (``spark.checkpoint.dir``) and reads it back: it cuts lineage the way a
pipeline stage boundary does (silver staging -> silver validation), survives
executor loss (the data is on shared storage, not in executor memory) and lets
several branches of the next plan scan it instead of recomputing it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir


def _hadoop(spark: SparkSession, path: str):
    """Spark's own file system for a path, and the path: the driver's local folders are not asked."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder of a table is there and holds anything but hidden entries; errors of the store rise.

    As in Spark's own listing, ``_SUCCESS`` is hidden and a partition folder such as ``_bucket=3`` is not.
    """
    return any("=" in n or not n.startswith("_") for n in folders(spark, path) if not n.startswith("."))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none where it does not exist."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def try_read(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame | None:
    """Scan of a Parquet table, or None when it provably does not exist (yet).

    Only an absent folder is "no table"; any error in reading one that is there rises.
    """
    return read_table(spark, path, merge_schema) if table_exists(spark, path) else None


#: Types of the partition columns of the library's tables that are not text.
PARTITION_TYPES = {"year": T.IntegerType(), "_clean": T.IntegerType(), "_bucket": T.IntegerType(), "batch_id": T.LongType()}


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a table folder, outermost first, from the names of its first folders."""
    found = []
    while True:
        names = [n for n in folders(spark, path) if "=" in n and not n.startswith((".", "_SUCCESS"))]
        if not names:
            return found
        found.append(names[0].split("=", 1)[0])
        path = f"{path.rstrip('/')}/{names[0]}"


def read_table(spark: SparkSession, path: str, merge_schema: bool = False, types: dict[str, T.DataType] = PARTITION_TYPES) -> DataFrame:
    """Parquet table scan; filters and projections on the result are pushed into the scan.

    Partition values are never guessed from folder names: a run id ``007``, a period ``01`` and ``1e3`` stay the text
    that was written, and a table whose values are all null keeps its type.  Partition columns have the type that
    ``types`` gives, else text.
    """
    r = spark.read
    if merge_schema:
        r = r.option("mergeSchema", "true")
    parts = partition_columns(spark, path)
    found = r.parquet(path)
    if not parts:
        return found
    fields = [T.StructField(f.name, types.get(f.name, T.StringType())) if f.name in parts else f for f in found.schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def restrict_to_files(df: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the given file hashes (semi-join; a small hash list becomes a broadcast / IN filter)."""
    return df.join(files.select("file_hash").distinct(), "file_hash", "left_semi")


#: Partitions of a written table that a task keeps open side by side; a task that meets more sorts the rest of its rows.
OPEN_PARTITIONS = 8


def write_scratch(df: DataFrame, name: str, partition_by: Sequence[str] = (), compression: str = "lz4") -> str:
    """Write ``df`` as a Parquet table under the shared checkpoint folder; return its path.

    Few partitions are written side by side: without that, every task sorts all its rows by the partition columns and
    holds them for it, which takes memory in proportion to the rows of the task.
    """
    path = scratch_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    w = df.write.mode("overwrite").option("compression", compression)
    if not partition_by:
        w.parquet(path)
        return path
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, str(OPEN_PARTITIONS))
    try:
        w.partitionBy(*partition_by).parquet(path)
    finally:
        conf.set(key, before)
    return path


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps deleted now, those of the steps before a written table above all.

    Spark deletes them once the driver's collector has met the plan that made them, at the latest after
    ``spark.cleaner.periodicGC.interval`` (30 minutes): until then all steps of a run lie on the disks together.  Only
    shuffles that no frame refers to any more are affected.  The event of a step's end still refers to its plan, so it is
    waited for first; where that takes long, the next call finds them.
    """
    try:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(2000)
    except Py4JJavaError:
        pass
    spark._jvm.System.gc()


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and return a scan of it, with the columns and types of ``df``."""
    path = write_scratch(df, name, partition_by)
    if not partition_by:
        return df.sparkSession.read.parquet(path)
    return read_table(df.sparkSession, path, types={f.name: f.dataType for f in df.schema})


def boundary(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` as the end of a step: the shuffles behind the table are let go."""
    out = materialize(df, name)
    release_shuffles(df.sparkSession)
    return out


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append with the partition layout of the table; readers merge evolving schemas."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def export_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ("file_hash",), run_id: str | None = None,
               tag_col: str = "dq_reasons") -> None:
    """Quarantine export as CSV, one folder per file, helper columns dropped, tags pipe-joined."""
    out = df.drop(*[c for c in df.columns if c.startswith("_")])
    if tag_col in out.columns:
        out = out.withColumn(tag_col, F.array_join(tag_col, "|"))
    if run_id is not None:
        out = out.withColumn("validation_run_id", F.lit(run_id))
    out = out.withColumn("quarantine_timestamp", F.current_timestamp())
    out.write.mode("overwrite").option("header", True).partitionBy(*partition_by).csv(path)


def ensure_parallelism(df: DataFrame, factor: int = 1) -> DataFrame:
    """Round-robin repartition only when a scan yields fewer partitions than the cluster's cores.

    A few large Parquet row groups give a few scan tasks; CPU-heavy per-row work
    (parsing, hashing) then runs on a few cores.  On a cluster reading many row
    groups this is a no-op.  Rows are not reordered within their identity
    (``_row_id`` is assigned before this step).
    """
    target = df.sparkSession.sparkContext.defaultParallelism * factor
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
