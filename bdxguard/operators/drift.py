"""Schema drift, mapping gate, review queue and mapping versions.

Headers are data: one row per (file, raw column name).  Drift and the gate are
anti-joins between header rows, expected columns and the active mapping, for
all files of all clients at once.  Names are normalised on both sides (T7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import normalize_name_col
from .joins import bounded_broadcast, range_join

FILE_KEYS = ("client_id", "file_hash", "file_name", "category")
OPEN_STATUSES = ("PENDING", "AFFECTS_CALCULATIONS")

# The reference's minimum expected column set per category, in canonical names.
EXPECTED_COLUMNS = {
    "premium": ("policy_number", "premium_amount", "valuation_date"),
    "premium_adj": ("policy_number", "premium_amount", "valuation_date"),
    "claims": ("claim_id", "claim_amount", "reported_date"),
    "claims_adj": ("claim_id", "claim_amount", "reported_date"),
}


def expected_frame(spark: SparkSession, expected: dict[str, Sequence[str]] = EXPECTED_COLUMNS) -> DataFrame:
    """Expected columns as a (category, column_name) frame: data, not code."""
    rows = [(cat, col) for cat, cols in expected.items() for col in cols]
    return spark.createDataFrame(rows, "category string, column_name string")


def normalized_headers(headers: DataFrame, raw_col: str = "raw_col_name") -> DataFrame:
    """(file keys, column_name) with normalised names, de-duplicated."""
    return headers.select(*FILE_KEYS, normalize_name_col(raw_col).alias("column_name")).distinct()


def canonical_headers(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Header names translated to canonical names by the client's active mapping (unmapped names kept)."""
    h, keys = normalized_headers(headers), _mapping_keys(mapping)
    m = (active_mapping(mapping)
         .select(*keys, normalize_name_col("raw_col_name").alias("column_name"), "canonical_name")
         .dropDuplicates([*keys, "column_name"]))
    return (h.join(m, [*keys, "column_name"], "left")
            .select(*FILE_KEYS, F.coalesce("canonical_name", "column_name").alias("column_name")).distinct())


def schema_drift(headers: DataFrame, expected: DataFrame, run_id: str = "run",
                 mapping: DataFrame | None = None) -> DataFrame:
    """NEW_COLUMN (header not expected) and MISSING_COLUMN (expected not in header); not for 'others'.

    With ``mapping``, header names are compared after translation to canonical
    names, so expected sets are written once in the canonical vocabulary.
    """
    h = (normalized_headers(headers) if mapping is None else canonical_headers(headers, mapping))
    h = h.filter(F.col("category") != "others")
    files = h.select(*FILE_KEYS).distinct()
    exp = files.join(bounded_broadcast(expected), "category")  # expected: a few rows per category
    new = h.join(exp.select("file_hash", "column_name"), ["file_hash", "column_name"], "left_anti")
    missing = exp.join(h.select("file_hash", "column_name"), ["file_hash", "column_name"], "left_anti")
    return (new.withColumn("issue_type", F.lit("NEW_COLUMN"))
            .unionByName(missing.withColumn("issue_type", F.lit("MISSING_COLUMN")))
            .withColumn("run_id", F.lit(run_id)))


def active_mapping(mapping: DataFrame) -> DataFrame:
    """Current mapping version rows (effective_to IS NULL)."""
    return mapping.filter(F.col("effective_to").isNull())


def _mapping_keys(mapping: DataFrame) -> list[str]:
    """What a mapping row holds for: the files of a client and category, or one file (``mapping_as_of``)."""
    return ["client_id", "category", *(["file_hash"] if "file_hash" in mapping.columns else [])]


MAPPING_LOG = ("client_id string, category string, raw_col_name string, canonical_name string, is_pii boolean, action string, decided_at timestamp")


def mapping_intervals(log: DataFrame) -> DataFrame:
    """The decisions on each raw column as slowly changing rows ``[effective_from, effective_to)``.

    ``log``: MAPPING_LOG rows.  approve and affects_calculations open a row, and the next of these or a retire on the
    column closes it; a reject changes no row.  Of decisions at the same instant the last by canonical name holds.
    ``mapping_version`` counts the rows of a (client, category) by time.  A column's decisions are few; the window is per
    column, and versions come from one per client and category over its decisions.
    """
    act, key = F.lower("action"), ["client_id", "category", "_raw"]
    d = log.where(act.isin("approve", "affects_calculations", "retire")).where("decided_at IS NOT NULL").withColumn("_raw", normalize_name_col("raw_col_name")).withColumn("_opens", act.isin("approve", "affects_calculations"))
    last = F.max_by(F.struct("raw_col_name", "canonical_name", "is_pii", "_opens"), F.struct(F.coalesce("canonical_name", F.lit("")), "_opens"))
    d = d.groupBy(*key, "decided_at").agg(last.alias("x"))
    d = d.withColumn("effective_to", F.lead("decided_at").over(Window.partitionBy(*key).orderBy("decided_at"))).where("x._opens")
    version = F.row_number().over(Window.partitionBy("client_id", "category").orderBy("decided_at", "_raw")).cast("int")
    return d.select("client_id", "category", F.col("x.raw_col_name").alias("raw_col_name"), F.col("x.canonical_name").alias("canonical_name"),
                    F.coalesce("x.is_pii", F.lit(False)).alias("is_pii"), version.alias("mapping_version"), F.col("decided_at").alias("effective_from"), "effective_to")


def mapping_as_of(files: DataFrame, intervals: DataFrame, at: str = "uploaded_at") -> DataFrame:
    """The mapping of each file as it was when the file came in: rows per file, with ``file_hash`` as part of their scope.

    ``files``: file_hash, client_id, category and the time ``at``.  A decision between two uploads changes only the later
    file, however late either is processed.
    """
    own = files.select("file_hash", "client_id", "category", F.col(at).alias("_at")).distinct()
    found = range_join(own, intervals, ["client_id", "category"], "_at", "effective_from", "effective_to", "inner", half_open=True)
    return found.select("file_hash", "client_id", "category", "raw_col_name", "canonical_name", "is_pii", "mapping_version",
                        F.lit(None).cast("timestamp").alias("effective_to"))


def unmapped_columns(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """U4: header columns without an active mapping for the file's (client, category)."""
    h, keys = normalized_headers(headers), _mapping_keys(mapping)
    m = active_mapping(mapping).select(*keys, normalize_name_col("raw_col_name").alias("column_name")).distinct()
    return h.join(m, [*keys, "column_name"], "left_anti")


def mapping_gate(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per file, QUEUED when every column is mapped, else BLOCKED with the unmapped count."""
    h = normalized_headers(headers)
    un = unmapped_columns(headers, mapping).groupBy("file_hash").agg(F.count(F.lit(1)).alias("unmapped"))
    per = h.groupBy(*FILE_KEYS).agg(F.count(F.lit(1)).alias("columns"))
    j = per.join(un, "file_hash", "left").withColumn("unmapped", F.coalesce("unmapped", F.lit(0)).cast("bigint"))
    return j.withColumn("status", F.when(F.col("unmapped") > 0, "BLOCKED").otherwise("QUEUED"))


def review_queue_inserts(unmapped: DataFrame, queue: DataFrame) -> DataFrame:
    """One PENDING item per (client, category, column) unless an open item exists.

    The reference inserts file by file; the first file (by name) is kept.
    """
    open_items = queue.filter(F.col("status").isin(*OPEN_STATUSES)).select("client_id", "category", "raw_col_name").distinct()
    items = (unmapped.groupBy("client_id", "category", F.col("column_name").alias("raw_col_name"))
             .agg(F.min("file_name").alias("file_name")))
    return (items.join(open_items, ["client_id", "category", "raw_col_name"], "left_anti")
            .withColumn("status", F.lit("PENDING")))


def apply_review_decisions(queue: DataFrame, decisions: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Approve / affects_calculations -> new mapping row with the next version; reject -> status only.

    Next version per (client, category) = coalesce(max(existing), 0) + rank in the batch (A10).
    Returns (new mapping rows, queue status updates).
    """
    d = decisions.join(queue.select("client_id", "category", "raw_col_name"), ["client_id", "category", "raw_col_name"], "left_semi")
    act = F.lower(F.col("action"))
    status = F.when(act == "approve", "APPROVED").when(act == "affects_calculations", "AFFECTS_CALCULATIONS").when(act == "reject", "REJECTED")
    updates = d.withColumn("status", status).filter(F.col("status").isNotNull())
    adds = updates.filter(F.col("status") != "REJECTED")
    mx = mapping.groupBy("client_id", "category").agg(F.max("mapping_version").alias("_maxv"))
    w = Window.partitionBy("client_id", "category").orderBy("raw_col_name", "canonical_name")
    rows = (adds.join(mx, ["client_id", "category"], "left")
            .withColumn("mapping_version", (F.coalesce("_maxv", F.lit(0)) + F.row_number().over(w)).cast("int"))
            .select("client_id", "category", "raw_col_name", "canonical_name", "is_critical", "is_pii", "mapping_version",
                    F.lit(None).cast("date").alias("effective_to"), "status"))
    return rows, updates


def resolve(queue: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Mark AFFECTS_CALCULATIONS items resolved by a data engineer (update = join + coalesce)."""
    r = resolutions.select("client_id", "category", "raw_col_name", F.lit(True).alias("_res"), F.col("resolved_by").alias("_by"))
    j = queue.join(r, ["client_id", "category", "raw_col_name"], "left")
    return (j.withColumn("de_resolved", F.coalesce("_res", "de_resolved", F.lit(False)))
            .withColumn("de_resolved_by", F.coalesce("_by", "de_resolved_by")).drop("_res", "_by"))


def open_review_items(queue: DataFrame) -> DataFrame:
    """PENDING items and unresolved AFFECTS_CALCULATIONS items."""
    return queue.filter((F.col("status") == "PENDING")
                        | ((F.col("status") == "AFFECTS_CALCULATIONS") & ~F.coalesce("de_resolved", F.lit(False))))


def review_list(queue: DataFrame, statuses: Sequence[str] = ("PENDING",)) -> DataFrame:
    """Review items of the given statuses, newest first (then by client, category and column)."""
    return queue.filter(F.col("status").isin(*statuses)).orderBy(F.col("created_at").desc(), "client_id", "category", "raw_col_name")


def review_item(queue: DataFrame, client_id: str, category: str, raw_col_name: str) -> DataFrame:
    """The items of one column of one client and category; the filters reach the scan."""
    return queue.filter((F.col("client_id") == client_id) & (F.col("category") == category) & (F.col("raw_col_name") == raw_col_name))


def pending_digest(queue: DataFrame) -> DataFrame:
    """Per client, pending items and files (counts; the item rows stay a frame)."""
    p = queue.filter(F.col("status") == "PENDING")
    return p.groupBy("client_id").agg(F.count(F.lit(1)).alias("pending_items"),
                                      F.count_distinct("file_name").alias("files"))
