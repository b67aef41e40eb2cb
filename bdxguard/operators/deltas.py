"""Aggregates of the validated tables kept by signed changes.

An upsert takes rows away and brings rows.  ``changes`` states both as signed rows; every maintained table is a sum over
such rows, so it is brought up to date from the change alone:

- *period totals*: sum and row count per (client, category, year, period), read by the reconciliation;
- *premium values*: per (client, treaty, policy, benefit) the multiset of its (reinsured sum, paid-to date, effective
  date) with counts.  A maximum alone cannot forget a row that an update replaced; the multiset can, and ``extremes``
  reads the greatest and smallest remaining values from it.

The multiset is kept as rows, not as one array per key, so a key of any size is an ordinary group.  NULL keys and values
are groups like any other.  An entry whose count falls to 0 stays until the next change of its partition, so a partition
whose rows all went away is replaced by one that says so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .recon import GROUP_KEYS

SIGN = "_sign"
PREMIUM_KEYS = ("client_id", "treaty_id", "policy_number", "benefit_id")
PREMIUM_VALUES = ("reinsured_sum_at_risk", "valuation_date", "policy_effective_date")
AMOUNTS = {"premium": "premium_amount", "premium_adj": "premium_amount", "claims": "claim_amount", "claims_adj": "claim_amount"}
TOTAL = "decimal(38,2)"


def changes(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """What ``upsert(target, source, keys)`` changes: -1 for every target row it replaces, +1 for every source row.

    Only ``columns`` (a missing one is null) and the keys are read.  A target row hit by several source rows goes once;
    NULL keys never match, so their rows are only added.
    """
    types = {f.name: f.dataType for f in source.schema}

    def narrow(df: DataFrame, sign: int) -> DataFrame:
        have = [F.col(c).cast(types[c]) if c in df.columns and c in types else F.col(c) if c in df.columns
                else F.lit(None).cast(types.get(c, "string")) for c in columns]
        return df.select(*[c.alias(n) for c, n in zip(have, columns)], F.lit(sign).alias(SIGN))

    gone = target.join(source.select(*keys).distinct(), list(keys), "left_semi")
    return narrow(gone, -1).unionByName(narrow(source, 1))


def _folded(old: DataFrame | None, delta: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Sums per key of the old table and a delta: one shuffle, partial aggregation before it."""
    new = delta.select(*keys, F.col(SIGN).cast("long").alias("n"), *[c.alias(k) for k, c in sums.items()], F.lit(True).alias("_new"))
    if old is not None:
        new = old.select(*keys, "n", *sums, F.lit(False).alias("_new")).unionByName(new)
    out = new.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in sums], F.bool_or("_new").alias("_new"))
    # a count below 0 means that the delta belongs to another state of the table: end the job, do not write it
    bad = F.raise_error(F.lit("maintained aggregate: more rows taken away than it holds"))
    return out.withColumn("n", F.when(F.col("n") < 0, bad.cast("long")).otherwise(F.col("n")))


def fold_totals(old: DataFrame | None, delta: DataFrame, amount: str) -> DataFrame:
    """Period totals after a change.  Null amounts count as rows and add nothing (A5)."""
    add = F.coalesce(F.col(amount).cast("decimal(18,2)"), F.lit(0)).cast("decimal(18,2)") * F.col(SIGN)
    out = _folded(old, delta, GROUP_KEYS, {"amount": add.cast(TOTAL)})
    return out.select(*GROUP_KEYS, F.col("amount").cast(TOTAL).alias("amount"), "n")


def fold_values(old: DataFrame | None, delta: DataFrame) -> DataFrame:
    """Premium values after a change of base premium rows; entries that fell to 0 earlier are dropped."""
    out = _folded(old, delta, (*PREMIUM_KEYS, *PREMIUM_VALUES), {})
    return out.filter((F.col("n") > 0) | F.col("_new")).drop("_new")


def extremes(values: DataFrame) -> DataFrame:
    """Existence, greatest reinsured sum, last paid-to and first effective date per key: the premium index of the claims checks."""
    return values.filter(F.col("n") > 0).groupBy(*PREMIUM_KEYS).agg(
        F.lit(True).alias("_has_prem"), F.max("reinsured_sum_at_risk").alias("_max_risar"),
        F.max("valuation_date").alias("_last_paid_to"), F.min("policy_effective_date").alias("_first_effective"))


def amounts_of_totals(totals: DataFrame | None, scope: DataFrame, net_adjustments: bool = False) -> DataFrame:
    """``recon.period_amounts`` read from the period totals: no validated row is scanned."""
    sc = scope.select(*GROUP_KEYS).distinct()
    if totals is None:
        return sc.withColumn("_has_table", F.lit(False)).withColumn("file_amount", F.lit(None).cast("decimal(18,2)"))
    key = F.regexp_replace("category", "_adj$", "") if net_adjustments else F.col("category")
    held = totals.filter(F.col("n") > 0).withColumn("_key", key)
    sums = held.groupBy("client_id", "_key", "year", "period").agg(F.sum("amount").alias("_sum"))
    present = held.select("client_id", "_key", F.lit(True).alias("_present")).distinct()
    out = (sc.withColumn("_key", key).join(sums, ["client_id", "_key", "year", "period"], "left")
           .join(present, ["client_id", "_key"], "left"))
    return out.select(*GROUP_KEYS, F.coalesce("_present", F.lit(False)).alias("_has_table"),
                      F.coalesce(F.col("_sum"), F.lit(0)).cast("decimal(18,2)").alias("file_amount"))
