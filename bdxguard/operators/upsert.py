"""Keyed upsert without a transaction log.

``upsert(target, source, keys)`` = target rows with no source match on the
keys, plus every source row: the result a ``MERGE ... WHEN MATCHED UPDATE ALL
WHEN NOT MATCHED INSERT ALL`` produces.  NULL keys never match (plain
equality), as in MERGE.  Delta refuses a merge in which several source rows
hit one target row; we keep the rows and report those keys with
``ambiguous_keys`` instead of failing.

``write_upsert`` materialises the result and replaces only the touched
partitions (dynamic partition overwrite), never overwriting a path that the
same plan still reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Merge keys per category (without the partition keys year, period).
MERGE_KEYS = {
    "premium": ("policy_number", "benefit_id", "valuation_date", "policy_effective_date"),
    "premium_adj": ("policy_number", "benefit_id", "valuation_date", "policy_effective_date"),
    "claims": ("claim_id", "policy_number", "benefit_id", "policy_effective_date"),
    "claims_adj": ("claim_id", "policy_number", "benefit_id", "policy_effective_date"),
}
PARTITION_KEYS = ("year", "period")


def merge_keys(category: str, partition_keys: Sequence[str] = PARTITION_KEYS) -> list[str]:
    return list(MERGE_KEYS[category]) + list(partition_keys)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE semantics as a left-anti join + union by name (schema may evolve)."""
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys where more than one source row would update the same target row."""
    multi = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows")).filter(F.col("source_rows") > 1)
    return multi.join(target.select(*keys).distinct(), list(keys), "left_semi")


def empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Empty target of the source's schema: the create path (S11) is the same upsert."""
    return spark.createDataFrame([], df.schema)


def write_upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                 partition_by: Sequence[str] = PARTITION_KEYS, staging_path: str | None = None) -> None:
    """Upsert ``source`` into the Parquet table at ``path``, rewriting only touched partitions.

    The touched partitions of the target are read, merged and written to a
    pending folder beside the table (so the plan no longer reads ``path``), then
    swapped in with dynamic partition overwrite.  The pending folder is removed
    only after the swap: a crash in between is finished by ``recover_upserts``,
    which every upsert calls first.
    """
    from ..sources.tables import read_table, table_exists

    recover_upserts(spark, path)
    exists = table_exists(spark, path)
    if exists:
        target = read_table(spark, path, merge_schema=True, types={f.name: f.dataType for f in source.schema})
        part_target = touched_rows(target, source, partition_by)
    else:                              # create path (S11): same upsert against an empty target
        part_target = empty_like(spark, source)
    replace_partitions(spark, upsert(part_target, source, keys), path, partition_by, staging_path)


def replace_partitions(spark: SparkSession, rows: DataFrame, path: str, partition_by: Sequence[str],
                       staging_path: str | None = None) -> None:
    """Replace the partitions that ``rows`` holds; ``rows`` may read the table itself.  Written beside it, then swapped in."""
    from ..sources.tables import remove_folder

    stage = staging_path or f"{pending_folder(path)}/{uuid.uuid4().hex}"
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(stage)
    _swap(spark, stage, path, partition_by)
    if staging_path is None:
        remove_folder(spark, stage)


def touched_rows(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the target in partitions that the source writes to.  A null partition value is a partition like any
    other: its keys never match (S10), but its folder is replaced as a whole, so its rows have to be carried over."""
    t, s = target.alias("t"), source.select(*partition_by).distinct().alias("s")
    same = [F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in partition_by]
    return t.join(s, same, "left_semi")


def pending_folder(path: str) -> str:
    """Where completed merges wait until they are swapped in: beside the table, in the same store."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_pending_{name}"


def _swap(spark: SparkSession, stage: str, path: str, partition_by: Sequence[str]) -> None:
    from ..sources.tables import read_table

    (read_table(spark, stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def recover_upserts(spark: SparkSession, path: str, partition_by: Sequence[str] = PARTITION_KEYS) -> int:
    """Finish swaps that a crash cut off.  A merge is complete when its ``_SUCCESS`` mark is there; swapping it in
    again gives the same partitions.  Incomplete ones are removed: their source was never taken as done."""
    from ..sources.tables import folders, remove_folder

    done = 0
    for name in folders(spark, pending_folder(path)):
        stage = f"{pending_folder(path)}/{name}"
        if "_SUCCESS" in folders(spark, stage):
            _swap(spark, stage, path, partition_by)
            done += 1
        remove_folder(spark, stage)
    return done
