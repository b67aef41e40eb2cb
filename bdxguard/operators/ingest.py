"""File inventory, registration, duplicate/collision status, retry skip set, staging queue.

SURVEY S3, S4, S16, S17, P4, G1, G16, A1-A4, U1, J1, J2, J9, S15.  All files
of a landing scan are one frame; nothing is looped over on the driver.  Per
content hash we only ever aggregate (partial aggregation first), so a hash
uploaded a million times costs a counter, not a list in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import UNKNOWN_CLIENT, classify_category, file_name_part

# Fixed values from the reference.
MAX_RETRIES = 3
WRITTEN_STATUSES = ("SUCCESS", "DUPLICATE", "CROSS_CLIENT_DUP", "UNKNOWN_CATEGORY")


def client_from_relative_path(rel_path) -> F.Column:
    """Client = parent folder below the landing root; files at the root -> UNKNOWN_CLIENT."""
    parts = F.split(F.col(rel_path), "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise(F.lit(UNKNOWN_CLIENT))


def file_inventory(files: DataFrame, name_col: str = "file_name", rel_path_col: str | None = "rel_path") -> DataFrame:
    """S3 + P4 + S17: name pattern (category_yyyy_Qn), classification, client, accept/reject reason.

    Non-matching names are kept with a reason instead of being silently dropped.
    ``name_category`` is the regex group (``premium_adj_2023_Q1`` -> ``adj``);
    ``category`` is the name classification the pipeline routes on.
    """
    name = F.col(name_col)
    is_csv = name.endswith(".csv")
    ncat = F.lower(file_name_part(name, 1))
    year = file_name_part(name, 2).cast("int")
    quarter = file_name_part(name, 3)
    reason = F.when(~is_csv, F.lit("NOT_CSV")).when(year.isNull(), F.lit("NAME_PATTERN"))
    out = files.select(
        "*", ncat.alias("name_category"), year.alias("year"), quarter.alias("quarter"),
        classify_category(name).alias("category"),
        reason.isNull().alias("accepted"), reason.alias("reject_reason"))
    if rel_path_col and rel_path_col in files.columns and "client_id" not in files.columns:
        out = out.withColumn("client_id", client_from_relative_path(rel_path_col))
    return out


def register_files(candidates: DataFrame, tracking: DataFrame | None, order: Sequence[str],
                   payload: Sequence[str]) -> DataFrame:
    """Idempotent registration — the first candidate per hash (by ``order``) wins,
    hashes already tracked are skipped.  ``min(struct(order, payload))`` per hash
    is a partial aggregate, so a hot hash never lands in one task as a group."""
    first = (candidates.groupBy("file_hash")
             .agg(F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                                 *[F.col(c) for c in payload])).alias("_first"))
             .select("file_hash", *[F.col(f"_first.{c}").alias(c) for c in payload if c != "file_hash"]))
    if tracking is not None:
        first = first.join(tracking.select("file_hash").distinct(), "file_hash", "left_anti")
    return first


def file_status(tracking: DataFrame) -> DataFrame:
    """G1: CROSS_CLIENT_DUP > DUPLICATE > UNKNOWN_CATEGORY > SUCCESS for every tracked file.

    duplicate_count: clients for a cross-client collision, files for a duplicate, else 1.
    The member list is a separate frame (``duplicate_members``), not a string.
    """
    per_hash = tracking.groupBy("file_hash").agg(
        F.count(F.lit(1)).alias("_n_files"), F.count_distinct("client_id").alias("_n_clients"))
    j = tracking.join(per_hash, "file_hash")
    status = (F.when(F.col("_n_clients") > 1, "CROSS_CLIENT_DUP").when(F.col("_n_files") > 1, "DUPLICATE")
              .when(F.col("category") == "others", "UNKNOWN_CATEGORY").otherwise("SUCCESS"))
    count = (F.when(F.col("_n_clients") > 1, F.col("_n_clients")).when(F.col("_n_files") > 1, F.col("_n_files"))
             .otherwise(F.lit(1)))
    return (j.withColumn("status", status).withColumn("duplicate_count", count.cast("bigint"))
            .withColumn("is_duplicate", F.col("status").isin("CROSS_CLIENT_DUP", "DUPLICATE"))
            .drop("_n_files", "_n_clients"))


def duplicate_members(tracking: DataFrame) -> DataFrame:
    """A2/A3 list form: one row per (hash, client, file) for hashes tracked more than once."""
    multi = tracking.groupBy("file_hash").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return tracking.join(multi.select("file_hash"), "file_hash", "left_semi").select("file_hash", "client_id", "file_name").distinct()


def skip_set(log: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """(client, hash) pairs already written or whose failures reached ``max_retries``."""
    written = log.filter(F.col("status").isin(*WRITTEN_STATUSES)).select("client_id", "file_hash")
    exhausted = (log.filter(F.col("status") == "FAILED").groupBy("client_id", "file_hash")
                 .agg(F.count(F.lit(1)).alias("fail_count")).filter(F.col("fail_count") >= max_retries)
                 .select("client_id", "file_hash"))
    return written.union(exhausted).distinct()


def files_to_ingest(tracking: DataFrame, log: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Tracked files minus the skip set."""
    return tracking.join(skip_set(log, max_retries), ["client_id", "file_hash"], "left_anti")


def latest_staging_status(staging_log: DataFrame, order: Sequence[str] = ("run_id",)) -> DataFrame:
    """Latest staging status per hash by sortable run id (T14), as a partial aggregate."""
    return staging_log.groupBy("file_hash").agg(
        F.max_by("status", F.struct(*[F.col(c) for c in order])).alias("last_staging_status"))


def staging_candidates(bronze_log: DataFrame, staging_log: DataFrame, queue: DataFrame | None = None,
                       order: Sequence[str] = ("run_id",)) -> DataFrame:
    """J2 + J9 + S15: bronze SUCCESS files never staged or whose *latest* staging run failed,
    not already queued; one queue row per hash (conflict-ignore insert)."""
    last = latest_staging_status(staging_log, order)
    c = (bronze_log.filter(F.col("status") == "SUCCESS").join(last, "file_hash", "left")
         .filter(F.col("last_staging_status").isNull() | (F.col("last_staging_status") == "FAILED")))
    cols = ["client_id", "file_name", "category", "year", "quarter"]
    c = register_files(c, queue, order=["client_id", "file_name"], payload=["file_hash", *cols])
    return c.withColumn("period", F.col("quarter")).withColumn("period_type", F.lit("quarterly"))


def dequeue(queue: DataFrame, done: DataFrame) -> DataFrame:
    """Remove processed hashes from the queue."""
    return queue.join(done.select("file_hash").distinct(), "file_hash", "left_anti")
