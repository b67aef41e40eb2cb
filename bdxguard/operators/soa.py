"""Statement-of-Account work lists and decisions.

These are the table operations behind the reference's SOA screens and daily
action mail, re-aimed as DataFrame functions over all periods at once: one
join to the latest version per period instead of one query per period.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY
from .recon import latest_version

ITEM_SCHEMA = "array<struct<label:string,amount:decimal(18,2),direction:string>>"
PERIOD_KEYS = ("client_id", "year", "period")
# SOA statuses and the action texts of the reference.
READY = "READY_FOR_SOA_ENTRY"
RESUBMIT = "REJECTED - RESUBMISSION REQUIRED"


def parse_items(col: str = "additional_items") -> Column:
    """JSON array of {label, amount, direction} -> array<struct> (NULL/blank -> empty)."""
    return F.coalesce(F.from_json(F.col(col), ITEM_SCHEMA), F.array().cast(ITEM_SCHEMA))


def item_issues(items: Column) -> Column:
    """label present, direction credit/debit, amount >= 0 (any item failing flags the entry)."""
    d = lambda x: F.lower(F.trim(x["direction"]))
    arr = F.array(
        F.when(F.exists(items, lambda x: F.coalesce(F.trim(x["label"]), F.lit("")) == ""), F.lit("ITEM_LABEL_MISSING")),
        F.when(F.exists(items, lambda x: ~F.coalesce(d(x).isin("credit", "debit"), F.lit(False))), F.lit("ITEM_DIRECTION_INVALID")),
        F.when(F.exists(items, lambda x: x["amount"] < 0), F.lit("ITEM_AMOUNT_NEGATIVE")),
    )
    return F.filter(arr, lambda x: x.isNotNull())


def net_soa(premium, claims, commission, tax, items: Column) -> Column:
    """premium - claims - commission - tax + credits - debits (exact decimal)."""
    zero = F.lit(Decimal("0.00")).cast("decimal(38,2)")
    adj = F.aggregate(items, zero, lambda acc, x: (acc + F.when(F.lower(F.trim(x["direction"])) == "credit", x["amount"])
                                                         .otherwise(-x["amount"])).cast("decimal(38,2)"))
    return (F.col(premium) - F.col(claims) - F.col(commission) - F.col(tax) + adj).cast(MONEY)


def soa_entry_batch(entries: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Validate new SOA entries, compute net and next version per period (A10).

    Versions: ``coalesce(max(existing version), 0) + row_number()`` inside the
    batch per period, so a batch of several entries for one period stays
    consistent.  Entries with issues get status INVALID and no version.
    """
    items = parse_items()
    required = ["client_id", "year", "period", "premium_soa", "claims_soa", "commission_soa", "tax_soa", "entered_by"]
    missing = F.exists(F.array(*[F.col(c).cast("string") for c in required]),
                       lambda x: F.coalesce(F.trim(x), F.lit("")) == "")
    issues = F.concat(F.filter(F.array(F.when(missing, F.lit("FIELDS_REQUIRED"))), lambda x: x.isNotNull()),
                      item_issues(items))
    e = entries.withColumn("issues", issues).withColumn("net_soa", net_soa("premium_soa", "claims_soa", "commission_soa", "tax_soa", items))
    ok = F.size("issues") == 0
    if existing is not None:
        mx = existing.groupBy(*PERIOD_KEYS).agg(F.max("version").alias("_maxv"))
        e = e.join(mx, list(PERIOD_KEYS), "left")
    else:
        e = e.withColumn("_maxv", F.lit(None).cast("int"))
    w = Window.partitionBy(*PERIOD_KEYS, ok).orderBy(F.col("entered_at").asc_nulls_last(), F.col("entered_by"))
    return (e.withColumn("version", F.when(ok, F.coalesce(F.col("_maxv"), F.lit(0)) + F.row_number().over(w)))
            .withColumn("status", F.when(ok, F.lit("PENDING_APPROVAL")).otherwise(F.lit("INVALID"))).drop("_maxv"))


def uploaded_periods(tracking: DataFrame, report_date: str, ts_col: str = "uploaded_at") -> DataFrame:
    """Distinct (client, year, period) uploaded on ``report_date`` (half-open day, P14)."""
    day = F.lit(report_date).cast("date")
    t = F.col(ts_col)
    return (tracking.filter((t >= day.cast("timestamp")) & (t < F.date_add(day, 1).cast("timestamp")))
            .select("client_id", "year", F.col("quarter").alias("period")).distinct())


def soa_worklist(periods: DataFrame, soa: DataFrame) -> DataFrame:
    """Per uploaded period, the latest SOA decides: none -> ready for entry, REJECTED -> resubmit."""
    last = latest_version(soa, list(PERIOD_KEYS)).select(*PERIOD_KEYS, F.col("status").alias("_st"))
    j = periods.join(last, list(PERIOD_KEYS), "left")
    action = F.when(F.col("_st").isNull(), F.lit(READY)).when(F.col("_st") == "REJECTED", F.lit(RESUBMIT))
    return j.withColumn("action", action).filter(F.col("action").isNotNull()).select(*PERIOD_KEYS, "action")


def soa_board(periods: DataFrame, soa: DataFrame) -> DataFrame:
    """Dashboard bucket of every uploaded period from its latest SOA version."""
    last = latest_version(soa, list(PERIOD_KEYS)).select(*PERIOD_KEYS, "version", "status")
    j = periods.join(last, list(PERIOD_KEYS), "left")
    st = F.col("status")
    bucket = (F.when(st.isNull() | (st == "REJECTED"), "action_required")
              .when(st == "PENDING_APPROVAL", "pending_approval").when(st == "APPROVED", "approved")
              .when(st == "RECONCILED", "reconciled"))
    return (j.withColumn("bucket", bucket).filter(F.col("bucket").isNotNull())
            .withColumn("adjustment_candidate", st == "RECONCILED")
            .withColumn("status", F.coalesce(st, F.lit(READY))))


def apply_decisions(entries: DataFrame, decisions: DataFrame, keys: Sequence[str] = (*PERIOD_KEYS, "version")) -> DataFrame:
    """Approve / reject / duplicate with approver required, approver != enterer,
    reason mandatory for a reject.  Violations leave the status unchanged and are reported."""
    j = decisions.join(entries.select(*keys, "entered_by", F.col("status").alias("old_status")), list(keys), "left")
    a, by = F.lower(F.trim("action")), F.trim("approved_by")
    issues = F.filter(F.array(
        F.when(F.col("old_status").isNull(), F.lit("ENTRY_NOT_FOUND")),
        F.when(~a.isin("approve", "reject", "duplicate"), F.lit("UNKNOWN_ACTION")),
        F.when(a.isin("approve", "reject") & (F.coalesce(by, F.lit("")) == ""), F.lit("APPROVER_REQUIRED")),
        F.when((a == "approve") & (by == F.trim("entered_by")), F.lit("SEGREGATION_OF_DUTIES")),
        F.when((a == "reject") & (F.coalesce(F.trim("rejection_reason"), F.lit("")) == ""), F.lit("REASON_REQUIRED")),
    ), lambda x: x.isNotNull())
    new = F.when(a == "approve", "APPROVED").when(a == "reject", "REJECTED").when(a == "duplicate", "DUPLICATE")
    return (j.withColumn("issues", issues)
            .withColumn("new_status", F.when(F.size("issues") == 0, new).otherwise(F.col("old_status"))))
