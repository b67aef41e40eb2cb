"""Silver staging: typed casts, row-level data-quality tags, clean/quarantine split.

SURVEY §2.3 (D1-D13), P5, P7, P8, P11, P12, A7, A12, G15.  Staging rules use the
canonical vocabulary (trap T1); tags keep the reference's staging names.  Every
cast is ``try_*`` (T3); a non-null raw value that does not parse gets an extra
``<name>:UNPARSABLE`` tag (T2).  Claims loss dates accept ``dd-MM-yyyy`` (T4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MONEY, parse_date, try_number
from ..functions.rules import Rule, active_rules, add_tags

# Staging tag prefix of each canonical column (the reference's staging names).
TAG_NAMES = {
    "policy_number": "policy_number",
    "valuation_date": "val_date",
    "policy_effective_date": "date_effect_policy",
    "date_of_birth": "dob",
    "issue_date": "issue_date",
    "age": "age",
    "sum_at_risk": "sar",
    "reinsured_sum_at_risk": "ri_sar",
    "premium_amount": "premium_amt",
    "new_renew": "new_renew",
    "loss_event_date": "loss_date",
    "reported_date": "reported_date",
    "claim_amount": "claim_amount",
}
CLAIMS_TAG_NAMES = dict(TAG_NAMES, policy_number="policy_num")

PREMIUM_DATES = ("issue_date", "policy_effective_date", "date_of_birth", "valuation_date")
PREMIUM_NUMBERS = (("age", "int"), ("sum_at_risk", MONEY), ("reinsured_sum_at_risk", MONEY),
                   ("premium_amount", MONEY))
CLAIMS_DATES = ("loss_event_date", "reported_date", "policy_effective_date")
CLAIMS_NUMBERS = (("claim_amount", MONEY),)
# Accepted New/Renew flags.
NEW_RENEW_VALUES = ("New", "Renew")


def _raw(c: str) -> str:
    return f"_raw_{c}"


def _both(a: str, b: str) -> Column:
    return F.col(a).isNotNull() & F.col(b).isNotNull()


def _null_rule(c: str, tags: dict) -> Rule:
    src = _raw(c) if c in PREMIUM_DATES + CLAIMS_DATES or c in dict(PREMIUM_NUMBERS + CLAIMS_NUMBERS) else c
    return Rule(f"{tags[c]}:NULL", lambda src=src: F.col(src).isNull(), (src,))


def _unparsable_rule(c: str, tags: dict) -> Rule:
    return Rule(f"{tags[c]}:UNPARSABLE",
                lambda c=c: F.col(_raw(c)).isNotNull() & F.col(c).isNull(), (_raw(c), c))


def premium_rules() -> list[Rule]:
    t = TAG_NAMES
    rules = [_null_rule(c, t) for c in ("policy_number", "policy_effective_date", "date_of_birth")]
    rules += [_unparsable_rule(c, t) for c in PREMIUM_DATES + tuple(n for n, _ in PREMIUM_NUMBERS)]
    rules += [
        Rule("age:OUT_OF_RANGE_0_100", lambda: F.col("age").isNotNull() & ((F.col("age") < 0) | (F.col("age") > 100)), ("age",)),
        Rule("sar:NOT_GREATER_THAN_PREMIUM_AMT",
             lambda: _both("sum_at_risk", "premium_amount") & (F.col("sum_at_risk") <= F.col("premium_amount")),
             ("sum_at_risk", "premium_amount")),
        Rule("ri_sar:NOT_GREATER_THAN_PREMIUM_AMT",
             lambda: _both("reinsured_sum_at_risk", "premium_amount") & (F.col("reinsured_sum_at_risk") <= F.col("premium_amount")),
             ("reinsured_sum_at_risk", "premium_amount")),
        Rule("issue_date:AFTER_VAL_DATE",
             lambda: _both("issue_date", "valuation_date") & (F.col("issue_date") > F.col("valuation_date")),
             ("issue_date", "valuation_date")),
        Rule("date_effect_policy:AFTER_VAL_DATE",
             lambda: _both("policy_effective_date", "valuation_date") & (F.col("policy_effective_date") > F.col("valuation_date")),
             ("policy_effective_date", "valuation_date")),
        Rule("dob:AFTER_VAL_DATE",
             lambda: _both("date_of_birth", "valuation_date") & (F.col("date_of_birth") > F.col("valuation_date")),
             ("date_of_birth", "valuation_date")),
        Rule("new_renew:INVALID_VALUE",
             lambda: F.col("new_renew").isNotNull() & ~F.col("new_renew").isin(*NEW_RENEW_VALUES), ("new_renew",)),
    ]
    return rules


def claims_rules() -> list[Rule]:
    t = CLAIMS_TAG_NAMES
    rules = [_null_rule(c, t) for c in ("policy_number", "loss_event_date")]
    rules += [_unparsable_rule(c, t) for c in CLAIMS_DATES + tuple(n for n, _ in CLAIMS_NUMBERS)]
    rules.append(Rule("loss_date:AFTER_REPORTED_DATE",
                      lambda: _both("loss_event_date", "reported_date") & (F.col("loss_event_date") > F.col("reported_date")),
                      ("loss_event_date", "reported_date")))
    return rules


def _typed(df: DataFrame, dates: Sequence[str], numbers) -> DataFrame:
    """Keep raw strings as ``_raw_*`` and cast in one projection (only columns present)."""
    cols = set(df.columns)
    out = []
    for c in df.columns:
        if c in dates:
            out += [F.col(c).cast("string").alias(_raw(c)), parse_date(F.col(c)).alias(c)]
        elif c in dict(numbers):
            out += [F.col(c).cast("string").alias(_raw(c)), try_number(F.col(c), dict(numbers)[c]).alias(c)]
        else:
            out.append(F.col(c))
    del cols
    return df.select(*out)


def _stage(df: DataFrame, dates, numbers, rules: list[Rule]) -> DataFrame:
    typed = _typed(df, dates, numbers)
    tagged = add_tags(typed, rules, "dq_issues")
    return tagged.drop(*[c for c in tagged.columns if c.startswith("_raw_")])


def stage_premium(bronze: DataFrame) -> DataFrame:
    """Typed premium rows with a ``dq_issues`` array (premium and premium_adj)."""
    return _stage(bronze, PREMIUM_DATES, PREMIUM_NUMBERS, premium_rules())


def stage_claims(bronze: DataFrame) -> DataFrame:
    """Typed claims rows with a ``dq_issues`` array (claims and claims_adj)."""
    return _stage(bronze, CLAIMS_DATES, CLAIMS_NUMBERS, claims_rules())


def skipped_staging_rules(bronze: DataFrame, kind: str = "premium") -> list[str]:
    """Names of rules disabled because their columns are absent."""
    rules = premium_rules() if kind == "premium" else claims_rules()
    dates, numbers = (PREMIUM_DATES, PREMIUM_NUMBERS) if kind == "premium" else (CLAIMS_DATES, CLAIMS_NUMBERS)
    cols = set(bronze.columns)
    cols |= {_raw(c) for c in cols if c in dates or c in dict(numbers)}
    active = {r.name for r in active_rules(rules, cols)}
    return [r.name for r in rules if r.name not in active]


def split_clean(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) routed on an empty tag array."""
    empty = F.size("dq_issues") == 0
    return staged.filter(empty), staged.filter(~empty)


def rule_counts(staged: DataFrame, keys: Sequence[str] = ("client_id", "file_name", "file_hash", "category")) -> DataFrame:
    """Rows per (file, rule), summed per rule.

    Rows are counted per (file, set of tags) first: there are few such sets, so the explode runs over counts, and the
    rules are evaluated once per row (an explode on the rows would evaluate them again in its inferred filter).
    """
    patterns = staged.groupBy(*keys, "dq_issues").agg(F.count(F.lit(1)).alias("_n"))
    return (patterns.select(*keys, "_n", F.explode("dq_issues").alias("dq_rule"))
            .groupBy(*keys, "dq_rule").agg(F.sum("_n").alias("row_count")))


def staging_log(staged: DataFrame, run_id: str,
                keys: Sequence[str] = ("client_id", "file_hash", "file_name", "category", "year", "quarter")) -> DataFrame:
    """One audit row per file: rows read, to silver, quarantined."""
    clean = F.size("dq_issues") == 0
    return (staged.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("rows_read"),
                 F.count_if(clean).alias("rows_to_silver"),
                 F.count_if(~clean).alias("rows_quarantined"))
            .withColumn("run_id", F.lit(run_id))
            .withColumn("status", F.lit("SUCCESS"))
            .withColumn("period", F.col("quarter"))
            .withColumn("period_type", F.lit("quarterly")))


def staging_summary(log: DataFrame) -> DataFrame:
    """Run summary of a staging log (G15, A14); with ``processed_at`` in the log also the run's latest time."""
    latest = [F.max("processed_at").alias("run_time")] if "processed_at" in log.columns else []
    return (log.groupBy("run_id")
            .agg(*latest, F.count(F.lit(1)).alias("total_files"),
                 F.count_if(F.col("status") == "SUCCESS").alias("processed_files"),
                 F.count_if(F.col("status") == "FAILED").alias("failed_files"),
                 F.coalesce(F.sum("rows_to_silver"), F.lit(0)).cast("bigint").alias("rows_to_silver"),
                 F.coalesce(F.sum("rows_quarantined"), F.lit(0)).cast("bigint").alias("rows_quarantined")))
