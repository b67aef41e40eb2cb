"""The scalar formulas as SQL functions.

Each is a temporary function with a SQL body.  The optimizer puts the body in
place of the call, so a query that uses them has the same plan as one written
with ``functions/columns.py``: no Python, whole-stage code, filters pushed down.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .columns import FREQUENCY_MULTIPLIERS

_MULTIPLIER = " ".join(f"WHEN '{name}' THEN {times}" for name, times in FREQUENCY_MULTIPLIERS)

#: Name -> (parameters, body).
FUNCTIONS = {
    "reinsured_sum": ("sar DECIMAL(18,2), quota_share DECIMAL(18,6), retention DECIMAL(18,2), multiple DECIMAL(18,6), reported DECIMAL(18,2)", """
        CASE WHEN quota_share IS NOT NULL AND retention IS NOT NULL THEN CASE WHEN sar > retention THEN (sar - retention) * quota_share ELSE sar * quota_share END
             WHEN quota_share IS NOT NULL THEN sar * quota_share
             WHEN multiple IS NOT NULL THEN least(sar - retention, multiple * retention)
             ELSE reported END"""),
    "frequency_multiplier": ("frequency STRING", f"CASE lower(frequency) {_MULTIPLIER} ELSE 1 END"),
    "expected_premium": ("risar DECIMAL(18,2), rate DECIMAL(18,6), times INT", "risar * 0.001BD * rate * times"),
    "age_by_days": ("valuation DATE, birth DATE", "floor(datediff(valuation, birth) / 365.25D)"),
    "age_completed_years": ("valuation DATE, birth DATE", """
        year(valuation) - year(birth) - CAST(month(valuation) < month(birth)
            OR (month(valuation) = month(birth) AND dayofmonth(valuation) < dayofmonth(birth)) AS INT)"""),
    "new_or_renew": ("valuation DATE, issue DATE", "CASE WHEN trunc(valuation, 'MM') = trunc(issue, 'MM') THEN 'New' ELSE 'Renew' END"),
    "quarter_start": ("d DATE", "trunc(d, 'quarter')"),
    "quarter_end": ("d DATE", "date_sub(add_months(trunc(d, 'quarter'), 3), 1)"),
    "quarter_label": ("d DATE", "concat('Q', CAST(quarter(d) AS STRING))"),
    "indexed_sum_at_risk": ("sar DECIMAL(18,2), years INT", "CAST(sar AS DOUBLE) * pow(1.02D, years)"),
    "reinsured_share": ("sar DECIMAL(18,2), share_pct DECIMAL(9,2)", "sar * share_pct * 0.01BD"),
    "net_soa": ("premium DECIMAL(18,2), claims DECIMAL(18,2), commission DECIMAL(18,2), tax DECIMAL(18,2), items STRING", """
        CAST(premium - claims - commission - tax + aggregate(
            coalesce(from_json(items, 'array<struct<label:string,amount:decimal(18,2),direction:string>>'), array()), CAST(0 AS DECIMAL(38,2)),
            (acc, x) -> CAST(acc + CASE WHEN lower(trim(x.direction)) = 'credit' THEN x.amount ELSE -x.amount END AS DECIMAL(38,2))) AS DECIMAL(18,2))"""),
    "normalize_column": ("name STRING", "replace(replace(replace(replace(trim(lower(name)), '/', '_'), ' ', '_'), '%', '_pct'), '-', '_')"),
    "classify_category": ("file_name STRING", """
        CASE WHEN contains(lower(file_name), 'prem') AND contains(lower(file_name), 'adj') THEN 'premium_adj'
             WHEN contains(lower(file_name), 'prem') THEN 'premium'
             WHEN contains(lower(file_name), 'claim') AND contains(lower(file_name), 'adj') THEN 'claims_adj'
             WHEN contains(lower(file_name), 'claim') THEN 'claims' ELSE 'others' END"""),
}


def register_sql_functions(spark: SparkSession, prefix: str = "bdx_") -> list[str]:
    """Create the functions in the session, each named ``prefix`` + its name; existing ones are replaced."""
    names = []
    for name, (parameters, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURN {body}")
        names.append(prefix + name)
    return names
