"""Monitoring reports over the check and staging audit frames.

Limits appear only where they are the feature (last 10 runs, last 100
failures) and always over a total order, so the rows kept are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Display order of check names (unknown names sort last, rank 999).
CHECK_ORDER = (
    "TREATY_MAPPING", "SOA_RECONCILIATION_PREMIUM", "SOA_RECONCILIATION_CLAIMS",
    "DUPLICATE_PREMIUM", "DUPLICATE_CLAIMS", "NEW_BUSINESS_FLAG",
    "RISAR_VALIDATION", "EFFECTIVE_DATE", "AGE_RANGE", "PRODUCT_CODE",
    "RATE_TABLE", "PREMIUM_EXISTS", "RISAR_GTE_CLAIM", "DOL_COVERAGE",
    "LAPSE_CHECK", "NO_ZERO_NEGATIVE", "CAL_CHECK",
)
UNKNOWN_RANK = 999


def run_summary(checks: DataFrame, last_n: int | None = 10) -> DataFrame:
    """Per run, first check time and counts by status; newest ``last_n`` runs."""
    st = F.col("status")
    out = checks.groupBy("run_id").agg(
        F.min("checked_at").alias("run_date"), F.count(F.lit(1)).alias("total_checks"),
        F.count_if(st == "PASS").alias("passed"), F.count_if(st == "FAIL").alias("failed"),
        F.count_if(st == "WARN").alias("warned"), F.count_if(st == "SKIPPED").alias("skipped"))
    if last_n is not None:
        out = out.orderBy(F.col("run_date").desc(), F.col("run_id").desc()).limit(last_n)
    return out


def open_failures(checks: DataFrame, last_n: int = 100) -> DataFrame:
    """O3: the newest ``last_n`` FAIL rows (total order: time desc, client, file, check)."""
    return (checks.filter(F.col("status") == "FAIL")
            .select("client_id", "file_name", "check_name", "failed_count", "total_count", "run_id", "checked_at")
            .orderBy(F.col("checked_at").desc(), "client_id", "file_name", "check_name").limit(last_n))


def check_rank(col: str = "check_name") -> F.Column:
    """Position in CHECK_ORDER, 999 for unknown names."""
    pos = F.array_position(F.array(*[F.lit(c) for c in CHECK_ORDER]), F.col(col))
    return F.when(pos > 0, pos).otherwise(F.lit(UNKNOWN_RANK)).cast("int")


def run_detail(checks: DataFrame, run_id: str) -> DataFrame:
    """One run's checks grouped by file, in display order of the check names."""
    return (checks.filter(F.col("run_id") == run_id).withColumn("check_rank", check_rank())
            .orderBy("client_id", "file_name", "category", "check_rank", "check_name"))


def latest_successful_run(log: DataFrame) -> DataFrame:
    """O1: latest SUCCESS run id (sortable ``yyyyMMdd_HHmmssZ``)."""
    return log.filter(F.col("status") == "SUCCESS").agg(F.max("run_id").alias("run_id"))
