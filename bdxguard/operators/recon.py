"""Reconciliation of period totals against approved Statements of Account.

One ``groupBy`` computes the amount of every (client, category, year, period)
group of the run at once; one join to the latest approved SOA version per
(client, year, period) decides every status.  The reference loops over groups
on the driver and runs one Spark job per group.

Defaults follow the reference: an ``_adj`` group is compared with the full
SOA amount; ``net_adjustments=True`` first adds base and adjustment amounts.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY

# Fixed value: recon variance tolerance (inclusive), overridable per call.
VARIANCE_THRESHOLD = Decimal("1.00")
GROUP_KEYS = ("client_id", "category", "year", "period")
FAILING = ("PENDING_SOA", "BREAK", "ERROR")


def latest_version(df: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """Latest row per key: ``ORDER BY version DESC LIMIT 1`` for every key at once.

    A window over SOA entries: the partitions are (client, year, period), a
    handful of versions each.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(version).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def approved_soa(soa: DataFrame) -> DataFrame:
    """Latest APPROVED version per (client, year, period)."""
    return latest_version(soa.filter(F.col("status") == "APPROVED"), ["client_id", "year", "period"])


def period_amounts(premium: DataFrame | None, claims: DataFrame | None,
                   scope: DataFrame, net_adjustments: bool = False) -> DataFrame:
    """Amount per scope group: premium_amount for *premium* categories, claim_amount for *claims*.

    ``scope``: (client_id, category, year, period) groups of the run (R5).
    A (client, category) without any validated row in any period has no table: its groups get status NO_DATA.

    With ``net_adjustments`` a group's amount is its base plus its adjustment amount, also where only one of the
    two has rows; the netted table is present where either is.
    """
    sc = scope.select(*GROUP_KEYS).distinct()
    base = F.regexp_replace("category", "_adj$", "")
    # Only the periods of the run are read and summed: a semi-join on the scope before the
    # aggregate (on (year, period)-partitioned tables this prunes partitions at the scan).
    # With net_adjustments the base and _adj groups of a scoped period are both needed.
    want = sc if not net_adjustments else sc.select("client_id", "year", "period").distinct()
    on = list(GROUP_KEYS) if not net_adjustments else ["client_id", "year", "period"]
    parts, tables = [], []
    for validated, amount in ((premium, "premium_amount"), (claims, "claim_amount")):
        if validated is not None:
            parts.append(validated.join(want, on, "left_semi").select(*GROUP_KEYS, F.col(amount).cast(MONEY).alias("_amt")))
            tables.append(validated.select("client_id", "category").distinct())
    if not parts:
        return sc.withColumn("file_amount", F.lit(None).cast(MONEY)).withColumn("_has_table", F.lit(False))
    data = parts[0]
    for p in parts[1:]:
        data = data.unionByName(p)
    present = tables[0]
    for t in tables[1:]:
        present = present.unionByName(t)
    # the key that groups amounts: the category itself, or its base when adjustments are netted
    key = base if net_adjustments else F.col("category")
    sums = (data.withColumn("_key", key).groupBy("client_id", "_key", "year", "period").agg(F.sum("_amt").alias("_sum")))
    present = present.select("client_id", key.alias("_key"), F.lit(True).alias("_present")).distinct()
    out = (sc.withColumn("_key", key).join(sums, ["client_id", "_key", "year", "period"], "left")
           .join(present, ["client_id", "_key"], "left"))
    return out.select(*GROUP_KEYS, F.coalesce("_present", F.lit(False)).alias("_has_table"),
                      F.coalesce(F.col("_sum"), F.lit(0)).cast(MONEY).alias("file_amount"))


def reconcile(amounts: DataFrame, soa: DataFrame, run_id: str = "run",
              threshold: Decimal = VARIANCE_THRESHOLD, checked_at: str | None = None) -> DataFrame:
    """Status per group (R2): NO_DATA / PENDING_SOA / RECONCILED (|variance| <= threshold) / BREAK / ERROR.

    ERROR: the group has a table and a statement, but no comparable amount (the statement's amount is null, or the
    category is neither premium nor claims).
    """
    s = approved_soa(soa).select("client_id", "year", "period", F.col("premium_soa").cast(MONEY).alias("_p"),
                                 F.col("claims_soa").cast(MONEY).alias("_c"), F.lit(True).alias("_has_soa"))
    j = amounts.join(s, ["client_id", "year", "period"], "left")
    is_prem = F.col("category").contains("premium")
    soa_amt = F.when(is_prem, F.col("_p")).when(F.col("category").contains("claims"), F.col("_c"))
    variance = (F.col("file_amount") - soa_amt).cast(MONEY)
    status = (F.when(~F.col("_has_table"), F.lit("NO_DATA"))
              .when(F.col("_has_soa").isNull(), F.lit("PENDING_SOA"))
              .when(variance.isNull(), F.lit("ERROR"))
              .when(F.abs(variance) <= F.lit(threshold), F.lit("RECONCILED"))
              .otherwise(F.lit("BREAK")))
    known = F.col("_has_table") & F.col("_has_soa").isNotNull()
    ts = F.lit(checked_at).cast("timestamp") if checked_at else F.current_timestamp()
    return j.select(
        F.lit(run_id).alias("run_id"), *GROUP_KEYS,
        F.when(known, F.coalesce(soa_amt, F.lit(0))).otherwise(F.lit(0)).cast(MONEY).alias("soa_amount"),
        F.when(F.col("_has_table"), F.col("file_amount")).otherwise(F.lit(0)).cast(MONEY).alias("file_amount"),
        F.when(known, F.coalesce(variance, F.lit(0))).otherwise(F.lit(0)).cast(MONEY).alias("variance"),
        status.alias("status"), ts.alias("checked_at"))


def recon_health(results: DataFrame) -> DataFrame:
    """Run health (R3): failed if any PENDING_SOA, BREAK or ERROR; NO_DATA does not fail."""
    st = F.col("status")
    return results.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(st == "RECONCILED").alias("reconciled"),
        F.count_if(st == "BREAK").alias("breaks"),
        F.count_if(st == "PENDING_SOA").alias("pending_soa"),
        F.count_if(st == "NO_DATA").alias("no_data"),
        F.count_if(st == "ERROR").alias("errors"),
        F.bool_or(st.isin(*FAILING)).alias("failed"))


def recon_statement(results: DataFrame) -> DataFrame:
    """Human-readable statement line per group."""
    return results.select(*GROUP_KEYS, "status", F.concat_ws(
        " | ", F.concat_ws(" ", "client_id", "category", F.concat(F.col("year").cast("string"), F.lit("-"), F.col("period"))),
        F.concat(F.lit("file "), F.format_number("file_amount", 2)),
        F.concat(F.lit("soa "), F.format_number("soa_amount", 2)),
        F.concat(F.lit("variance "), F.format_number("variance", 2)), "status").alias("statement"))


def reconciled_rows(validated: DataFrame, results: DataFrame) -> DataFrame:
    """Validated rows of RECONCILED groups, ready for gold promotion."""
    ok = results.filter(F.col("status") == "RECONCILED").select(*GROUP_KEYS).distinct()
    return validated.join(ok, list(GROUP_KEYS), "left_semi")


def soa_transitions(results: DataFrame, soa: DataFrame) -> DataFrame:
    """Approved SOA versions whose groups all reconciled -> new status RECONCILED (state change as data)."""
    per = (results.groupBy("client_id", "year", "period")
           .agg(F.bool_and(F.col("status") == "RECONCILED").alias("_all_ok")).filter("_all_ok"))
    return (approved_soa(soa).join(per, ["client_id", "year", "period"], "left_semi")
            .select("client_id", "year", "period", "version", F.lit("RECONCILED").alias("new_status")))
