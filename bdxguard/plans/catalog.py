"""Registered queries: one per operator group of SURVEY §7.3, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Every query reads the given tables (or frames Spark derives from them) in
full; nothing is subset, capped or sampled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import staging as st
from ..operators import validation as va
from ..operators.joins import bounded_broadcast
from ..sources.tables import materialize, release_shuffles, write_scratch
from . import fixtures as fx
from . import oracle as orc

RUN_ID = orc.RUN_ID
CHECKED_AT = orc.CHECKED_AT

CHECK_COLS = ("run_id", "client_id", "file_hash", "file_name", "category", "year", "period", "check_name",
              "status", "failed_count", "total_count")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ shared pipeline pieces
_TABLES: dict = {}  # (application id, input folder, table) -> path of the written table


class Pipeline:
    """The bordereau pipeline over one scale-factor directory, built lazily per query.

    Staged premium and claims are written once as silver tables (the stage
    boundary of the real pipeline) and every later step scans them, so no
    branch of a plan recomputes the fixture joins.
    """

    def __init__(self, spark: SparkSession, d: str, reuse: bool = True):
        self.spark, self.d, self.reuse = spark, d, reuse
        self._memo: dict = {}

    def _get(self, key, fn):
        if key not in self._memo:
            self._memo[key] = fn()
        return self._memo[key]

    def _table(self, name: str, build, partition_by=()):
        """Silver/metadata table of this input folder, written once per Spark application and reused."""
        if not self.reuse:
            return materialize(build(), name, partition_by)
        key = (self.spark.sparkContext.applicationId, self.d.rstrip("/"), name)
        path = _TABLES.get(key)
        if path is not None:
            try:
                return self.spark.read.parquet(path)
            except Exception:  # noqa: BLE001 - table gone: write it again
                pass
        path = write_scratch(build(), name, partition_by, "zstd")  # fingerprints in hex: only an entropy coder shortens them
        _TABLES[key] = path
        out = self.spark.read.parquet(path)     # before the release: the next job's events replace the last ones of the write
        release_shuffles(self.spark)
        return out

    @staticmethod
    def _flag_clean(df: DataFrame) -> DataFrame:
        return df.withColumn("_clean", (F.size("dq_issues") == 0).cast("int"))  # int: partition type is inferred back

    @property
    def staged_premium(self) -> DataFrame:
        """Staged premium silver, partitioned by the clean flag (clean / quarantine in one table)."""
        return self._get("sp", lambda: self._table(
            "staged-premium", lambda: self._flag_clean(st.stage_premium(fx.premium_raw(self.spark, self.d))), ["_clean"]))

    @property
    def staged_claims(self) -> DataFrame:
        return self._get("sc", lambda: self._table(
            "staged-claims", lambda: self._flag_clean(st.stage_claims(fx.claims_raw(self.spark, self.d))), ["_clean"]))

    @property
    def clean_premium(self) -> DataFrame:
        """Clean rows: a partition filter, pruned at the scan."""
        return self.staged_premium.filter(F.col("_clean") == 1).drop("_clean")

    @property
    def clean_claims(self) -> DataFrame:
        return self.staged_claims.filter(F.col("_clean") == 1).drop("_clean")

    @property
    def treaty(self) -> DataFrame:
        """Treaty config: a metadata table, written once and scanned by every branch."""
        return self._get("t", lambda: self._table("treaty", lambda: fx.treaty(self.spark, self.d).coalesce(1)))

    @property
    def rates(self) -> DataFrame:
        return self._get("r", lambda: self._table("rates", lambda: fx.rates(self.spark, self.d).coalesce(1)))

    @property
    def treaty_primary(self) -> DataFrame:
        """Treaty rows without fan-out copies (what a promoted history carries)."""
        return self.treaty.filter(F.col("segment_id") == "A")

    def _with_treaty_id(self, df, how):
        t = bounded_broadcast(self.treaty_primary.select("client_id", "benefit_id", "plan_code", "treaty_id"))
        return df.join(t, ["client_id", "benefit_id", "plan_code"], how)

    @property
    def premium_history(self) -> DataFrame:
        """Validated premium stand-in: staged clean base-premium rows with their treaty id
        (adjustments live in their own table, as in the reference)."""
        return self._with_treaty_id(self.clean_premium.filter(F.col("category") == "premium"), "inner")

    @property
    def claims_history(self) -> DataFrame:
        return self._with_treaty_id(self.clean_claims.filter(F.col("category") == "claims"), "left")

    def premium_validation(self, as_of=False):
        return self._get(("pv", as_of), lambda: va.validate_premium(
            self.clean_premium, self.treaty, self.rates, None,
            run_id=RUN_ID, checked_at=CHECKED_AT, as_of=as_of))

    @property
    def premium_index(self) -> DataFrame:
        """Premium history aggregated per (client, treaty, policy, benefit): a maintained table."""
        return self._get("pi", lambda: self._table("premium-index",
                                                   lambda: va.premium_history_aggregate(self.premium_history)))

    def claims_validation(self):
        return self._get("cv", lambda: va.validate_claims(
            self.clean_claims, self.treaty, None, self.claims_history,
            run_id=orc.RUN_ID2, checked_at=orc.CHECKED_AT2, premium_index=self.premium_index))

    def check_table(self, name: str, validation) -> DataFrame:
        """Check rows of a validation: an audit table of one row per (file, check)."""
        return self._get(name, lambda: self._table(name, lambda: validation().checks))


def staged_premium(spark, d):
    """Staged premium as one plan (no intermediate table), for single-use queries."""
    return st.stage_premium(fx.premium_raw(spark, d))


def staged_claims(spark, d):
    return st.stage_claims(fx.claims_raw(spark, d))


def premium_validation(spark, d, as_of=False):
    return Pipeline(spark, d).premium_validation(as_of)


def claims_validation(spark, d):
    return Pipeline(spark, d).claims_validation()


def _checks(v, names=None) -> DataFrame:
    c = v.checks.select(*CHECK_COLS)
    return c if names is None else c.filter(F.col("check_name").isin(*names))


def _sql_checks(view: str, names=None) -> str:
    cols = ", ".join(CHECK_COLS)
    where = "" if names is None else " WHERE check_name IN (" + ", ".join(f"'{n}'" for n in names) + ")"
    return orc.with_views(f"SELECT {cols} FROM {view}{where}")


# ------------------------------------------------------------------ staging queries
@register("staging_rules_premium", orc.with_views("""
    SELECT client_id, file_hash, file_name, category, year, quarter, count(*) AS rows_read,
           count(*) FILTER (WHERE len(dq_issues) = 0) AS rows_to_silver,
           count(*) FILTER (WHERE len(dq_issues) > 0) AS rows_quarantined
    FROM s_premium GROUP BY ALL"""))
def q_staging_rules_premium(spark, d):
    """Staging of premium files, one audit row per file."""
    return st.staging_log(staged_premium(spark, d), RUN_ID).select(
        "client_id", "file_hash", "file_name", "category", "year", "quarter", "rows_read", "rows_to_silver",
        "rows_quarantined")


@register("staging_rules_claims", orc.with_views("""
    SELECT client_id, file_hash, file_name, category, year, quarter, count(*) AS rows_read,
           count(*) FILTER (WHERE len(dq_issues) = 0) AS rows_to_silver,
           count(*) FILTER (WHERE len(dq_issues) > 0) AS rows_quarantined
    FROM s_claims GROUP BY ALL"""))
def q_staging_rules_claims(spark, d):
    """D11-D13 (dd-MM-yyyy loss dates, T4): staging of claims files."""
    return st.staging_log(staged_claims(spark, d), RUN_ID).select(
        "client_id", "file_hash", "file_name", "category", "year", "quarter", "rows_read", "rows_to_silver",
        "rows_quarantined")


@register("rule_counts", orc.with_views("""
    SELECT client_id, file_name, file_hash, category, dq_rule, count(*) AS row_count
    FROM (SELECT client_id, file_name, file_hash, category, unnest(dq_issues) AS dq_rule FROM s_premium
          UNION ALL
          SELECT client_id, file_name, file_hash, category, unnest(dq_issues) AS dq_rule FROM s_claims)
    GROUP BY ALL"""))
def q_rule_counts(spark, d):
    """Quarantined rows per (file, rule), premium and claims."""
    return st.rule_counts(staged_premium(spark, d)).unionByName(st.rule_counts(staged_claims(spark, d)))


# ------------------------------------------------------------------ premium validation
@register("premium_checks", _sql_checks("p_checks"))
def q_premium_checks(spark, d):
    """V1-V9, V18, V19 over all premium files in one pass."""
    return _checks(premium_validation(spark, d))


for _name, _checks_names in {
    "treaty_mapping": ("TREATY_MAPPING",),
    "duplicate_premium": ("DUPLICATE_PREMIUM",),
    "new_business": ("NEW_BUSINESS_FLAG",),
    "effective_date": ("EFFECTIVE_DATE",),
    "age_range": ("AGE_RANGE",),
    "risar_validation": ("RISAR_VALIDATION",),
    "rate_check": ("RATE_TABLE", "RATE_TABLE_MISSING_MATCH"),
    "row_integrity": ("ROW_INTEGRITY_CHECK",),
}.items():
    def _q(spark, d, _n=_checks_names):
        return _checks(premium_validation(spark, d), _n)
    _q.__doc__ = f"{', '.join(_checks_names)} rows of the premium validation (all files in one pass)."
    register(_name, _sql_checks("p_checks", _checks_names))(_q)


@register("rate_check_as_of", _sql_checks("p_checks_asof", ("RATE_TABLE", "RATE_TABLE_MISSING_MATCH")))
def q_rate_check_as_of(spark, d):
    """V8/V9 with J13: rate valid at the valuation date."""
    return _checks(premium_validation(spark, d, as_of=True), ("RATE_TABLE", "RATE_TABLE_MISSING_MATCH"))


@register("file_threshold", orc.with_views("""
    SELECT client_id, file_hash, file_name, category, year, quarter, CAST(total_count AS BIGINT) AS total_count,
           CAST(quarantined_rows AS BIGINT) AS quarantined_rows, integrity_failed, rejected
    FROM p_files"""))
def q_file_threshold(spark, d):
    """Per-file quarantine ratio and rejection (>= 30 %)."""
    return premium_validation(spark, d).files.select(
        "client_id", "file_hash", "file_name", "category", "year", "quarter",
        F.col("total_count").cast("bigint").alias("total_count"),
        F.col("quarantined_rows").cast("bigint").alias("quarantined_rows"), "integrity_failed", "rejected")


# ------------------------------------------------------------------ claims validation
@register("claims_checks", _sql_checks("c_checks"))
def q_claims_checks(spark, d):
    """V1, V10-V19 over all claims files in one pass."""
    return _checks(claims_validation(spark, d))


for _name, _checks_names in {
    "duplicate_claims": ("DUPLICATE_CLAIMS",),
    "premium_exists": ("PREMIUM_EXISTS",),
    "risar_gte_claim": ("RISAR_GTE_CLAIM",),
    "cal_policy": ("CAL_CHECK",),
    "no_zero_negative": ("NO_ZERO_NEGATIVE",),
    "dol_coverage": ("DOL_COVERAGE",),
    "lapse_check": ("LAPSE_CHECK",),
}.items():
    def _q(spark, d, _n=_checks_names):
        return _checks(claims_validation(spark, d), _n)
    _q.__doc__ = f"{', '.join(_checks_names)} rows of the claims validation (all files in one pass)."
    register(_name, _sql_checks("c_checks", _checks_names))(_q)


@register("cal_life", orc.with_views("SELECT file_hash, client_id, insured_id FROM c_breach"))
def q_cal_life(spark, d):
    """Insureds whose life-level claims (current + other files) exceed the limit."""
    p = Pipeline(spark, d)
    rows = va.enrich_with_treaty(p.clean_claims, p.treaty).filter(F.col("category") == "claims")
    return va.cal_life_breaches(rows, p.claims_history).select("file_hash", "client_id", "insured_id")


# ------------------------------------------------------------------ reconciliation
from ..operators import deltas as dl  # noqa: E402
from ..operators import pruning as pr  # noqa: E402
from ..operators import recon as rc  # noqa: E402
from ..operators import soa as so  # noqa: E402
from ..operators import upsert as up  # noqa: E402

REPORT_DATE = "2024-01-01"
RECON_COLS = ("run_id", "client_id", "category", "year", "period", "soa_amount", "file_amount", "variance", "status")


def soa_fixture(p: Pipeline):
    return fx.soa_entries(p.clean_premium, p.clean_claims)


def _validated(df):
    return df.withColumn("period", F.col("quarter"))


def recon_results(p: Pipeline, net_adjustments=False):
    sp, sc = p.staged_premium, p.staged_claims
    scope = (sp.select("client_id", "category", "year", F.col("quarter").alias("period"))
             .unionByName(sc.select("client_id", "category", "year", F.col("quarter").alias("period"))))
    amounts = rc.period_amounts(_validated(p.clean_premium), _validated(p.clean_claims), scope,
                                net_adjustments=net_adjustments)
    return rc.reconcile(amounts, soa_fixture(p), run_id=RUN_ID, checked_at=CHECKED_AT)


_RECON_HEAD = """
    recon_scope AS (SELECT DISTINCT client_id, category, year, quarter AS period FROM s_premium
                    UNION SELECT DISTINCT client_id, category, year, quarter AS period FROM s_claims),
    recon_rows AS (SELECT client_id, category, {key} AS grp, year, quarter AS period, premium_amount AS amt FROM c_premium
                   UNION ALL
                   SELECT client_id, category, {key} AS grp, year, quarter AS period, claim_amount AS amt FROM c_claims),
    recon_amt AS (SELECT client_id, grp, year, period, sum(amt) AS amt FROM recon_rows GROUP BY ALL),
    recon_table AS (SELECT DISTINCT client_id, grp FROM recon_rows),
    soa_ok AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY client_id, year, period ORDER BY version DESC) AS rn
                              FROM soa WHERE status = 'APPROVED') WHERE rn = 1),
    recon_joined AS (
      SELECT s.*, t.client_id IS NOT NULL AS has_table, o.client_id IS NOT NULL AS has_soa, coalesce(a.amt, 0) AS amt,
        CASE WHEN s.category LIKE '%premium%' THEN o.premium_soa ELSE o.claims_soa END AS soa
      FROM (SELECT *, {key} AS grp FROM recon_scope) s
      LEFT JOIN recon_table t ON t.client_id = s.client_id AND t.grp = s.grp
      LEFT JOIN recon_amt a ON a.client_id = s.client_id AND a.grp = s.grp AND a.year = s.year AND a.period = s.period
      LEFT JOIN soa_ok o ON o.client_id = s.client_id AND o.year = s.year AND o.period = s.period),
    recon AS (
      SELECT '{run}' AS run_id, client_id, category, year, period,
        CAST(CASE WHEN has_table AND has_soa THEN coalesce(soa, 0) ELSE 0 END AS DECIMAL(18,2)) AS soa_amount,
        CAST(CASE WHEN has_table THEN amt ELSE 0 END AS DECIMAL(18,2)) AS file_amount,
        CAST(CASE WHEN has_table AND has_soa THEN coalesce(amt - soa, 0) ELSE 0 END AS DECIMAL(18,2)) AS variance,
        CASE WHEN NOT has_table THEN 'NO_DATA' WHEN NOT has_soa THEN 'PENDING_SOA' WHEN soa IS NULL THEN 'ERROR'
             WHEN abs(amt - soa) <= 1.00 THEN 'RECONCILED' ELSE 'BREAK' END AS status
      FROM recon_joined)
"""
_RECON_SQL = _RECON_HEAD.format(run=RUN_ID, key="category")
_RECON_NET_SQL = _RECON_HEAD.format(run=RUN_ID, key="regexp_replace(category, '_adj$', '')")


def _with_recon(select: str, extra: str = "", net: bool = False) -> str:
    body = (_RECON_NET_SQL if net else _RECON_SQL).strip()
    return orc.with_views(select, body + ("," + extra if extra.strip() else ""))


@register("reconcile", _with_recon("SELECT * FROM recon"))
def q_reconcile(spark, d):
    """Every (client, category, year, period) of the run against the latest approved SOA."""
    return recon_results(Pipeline(spark, d)).select(*RECON_COLS)


@register("recon_health", _with_recon("""
    SELECT run_id, count(*) AS groups, count(*) FILTER (WHERE status = 'RECONCILED') AS reconciled,
           count(*) FILTER (WHERE status = 'BREAK') AS breaks, count(*) FILTER (WHERE status = 'PENDING_SOA') AS pending_soa,
           count(*) FILTER (WHERE status = 'NO_DATA') AS no_data, count(*) FILTER (WHERE status = 'ERROR') AS errors,
           bool_or(status IN ('PENDING_SOA', 'BREAK', 'ERROR')) AS failed
    FROM recon GROUP BY run_id"""))
def q_recon_health(spark, d):
    """Run health; NO_DATA does not fail the run."""
    return rc.recon_health(recon_results(Pipeline(spark, d)))


@register("reconcile_net", _with_recon("SELECT * FROM recon", net=True))
def q_reconcile_net(spark, d):
    """R1 with net_adjustments=True: base and _adj amounts of a period are summed before the SOA comparison."""
    return recon_results(Pipeline(spark, d), net_adjustments=True).select(*RECON_COLS)


@register("recon_statement", _with_recon("""
    SELECT client_id, category, year, period, status,
        client_id || ' ' || category || ' ' || CAST(year AS VARCHAR) || '-' || period
        || ' | file ' || format('{:,.2f}', file_amount) || ' | soa ' || format('{:,.2f}', soa_amount)
        || ' | variance ' || format('{:,.2f}', variance) || ' | ' || status AS statement
    FROM recon"""))
def q_recon_statement(spark, d):
    """Formatted statement line per group."""
    return rc.recon_statement(recon_results(Pipeline(spark, d)))


@register("upsert_gold", _with_recon("""
    SELECT client_id, file_hash, year, quarter, policy_number, benefit_id, valuation_date, policy_effective_date, premium_amount
    FROM (SELECT * FROM gold_tgt t WHERE NOT EXISTS (SELECT 1 FROM gold_src s WHERE s.policy_number = t.policy_number
              AND s.benefit_id = t.benefit_id AND s.valuation_date = t.valuation_date
              AND s.policy_effective_date = t.policy_effective_date AND s.year = t.year AND s.quarter = t.quarter)
          UNION ALL SELECT * FROM gold_src)""", """
    gold_src AS (SELECT p.* FROM c_premium p WHERE EXISTS (
          SELECT 1 FROM recon r WHERE r.status = 'RECONCILED' AND r.client_id = p.client_id AND r.category = p.category
            AND r.year = p.year AND r.period = p.quarter)),
      gold_tgt AS (SELECT * REPLACE (CAST(0 AS DECIMAL(18,2)) AS premium_amount) FROM c_premium)"""))
def q_upsert_gold(spark, d):
    """R4 + S10/S11: rows of RECONCILED premium periods upserted into a gold table that holds all periods with amount 0."""
    p = Pipeline(spark, d)
    results = recon_results(p)
    src = rc.reconciled_rows(_validated(p.clean_premium), results)
    tgt = _validated(p.clean_premium).withColumn("premium_amount", F.lit(0).cast("decimal(18,2)"))
    merged = up.upsert(tgt, src, up.merge_keys("premium"))
    return merged.select("client_id", "file_hash", "year", "quarter", "policy_number", "benefit_id", "valuation_date",
                         "policy_effective_date", "premium_amount")


@register("upsert_gold_claims", _with_recon("""
    SELECT client_id, file_hash, year, quarter, claim_id, policy_number, benefit_id, policy_effective_date, claim_amount
    FROM (SELECT * FROM gold_tgt t WHERE NOT EXISTS (SELECT 1 FROM gold_src s WHERE s.claim_id = t.claim_id
              AND s.policy_number = t.policy_number AND s.benefit_id = t.benefit_id
              AND s.policy_effective_date = t.policy_effective_date AND s.year = t.year AND s.quarter = t.quarter)
          UNION ALL SELECT * FROM gold_src)""", """
    gold_src AS (SELECT c.* FROM c_claims c WHERE EXISTS (
          SELECT 1 FROM recon r WHERE r.status = 'RECONCILED' AND r.client_id = c.client_id AND r.category = c.category
            AND r.year = c.year AND r.period = c.quarter)),
      gold_tgt AS (SELECT * REPLACE (CAST(0 AS DECIMAL(18,2)) AS claim_amount) FROM c_claims)"""))
def q_upsert_gold_claims(spark, d):
    """R4 + S10/S11: rows of RECONCILED claims periods upserted into a gold table that holds all periods with amount 0."""
    p = Pipeline(spark, d)
    src = rc.reconciled_rows(_validated(p.clean_claims), recon_results(p))
    tgt = _validated(p.clean_claims).withColumn("claim_amount", F.lit(0).cast("decimal(18,2)"))
    return up.upsert(tgt, src, up.merge_keys("claims")).select("client_id", "file_hash", "year", "quarter", "claim_id", "policy_number",
                                                               "benefit_id", "policy_effective_date", "claim_amount")


@register("upsert_validated", orc.with_views("""
    SELECT client_id, file_hash, year, quarter, policy_number, benefit_id, valuation_date, policy_effective_date,
           CAST(premium_amount AS DECIMAL(18,2)) AS premium_amount
    FROM (SELECT * FROM u_tgt t WHERE NOT EXISTS (SELECT 1 FROM u_src s WHERE s.policy_number = t.policy_number
              AND s.benefit_id = t.benefit_id AND s.valuation_date = t.valuation_date
              AND s.policy_effective_date = t.policy_effective_date AND s.year = t.year AND s.quarter = t.quarter)
          UNION ALL SELECT * FROM u_src)""", """
    u_tgt AS (SELECT * FROM c_premium WHERE quarter IN ('Q1', 'Q2', 'Q3')),
    u_src AS (SELECT * REPLACE (CASE WHEN quarter = 'Q2' THEN premium_amount + 1 ELSE premium_amount END AS premium_amount)
              FROM c_premium WHERE quarter IN ('Q2', 'Q3', 'Q4'))"""))
def q_upsert_validated(spark, d):
    """Keyed upsert (MERGE semantics, NULL keys never match) of the rows of Q2-Q4 into those of Q1-Q3."""
    c = _validated(Pipeline(spark, d).clean_premium)
    tgt = c.filter(F.col("quarter").isin("Q1", "Q2", "Q3"))
    src = (c.filter(F.col("quarter").isin("Q2", "Q3", "Q4"))
           .withColumn("premium_amount", F.when(F.col("quarter") == "Q2", F.col("premium_amount") + 1)
                       .otherwise(F.col("premium_amount")).cast("decimal(18,2)")))
    return up.upsert(tgt, src, up.merge_keys("premium")).select(
        "client_id", "file_hash", "year", "quarter", "policy_number", "benefit_id", "valuation_date",
        "policy_effective_date", "premium_amount")


# ------------------------------------------------------------------ tables kept by the changes of an upsert
_MOVED = """
    k_all AS (SELECT p.*, t.treaty_id FROM c_premium p JOIN treaty_a t USING (client_id, benefit_id, plan_code) WHERE p.category = 'premium'),
    k_tgt AS (SELECT * FROM k_all WHERE quarter IN ('Q1', 'Q2', 'Q3')),
    k_src AS (SELECT * REPLACE (CASE WHEN quarter = 'Q2' THEN reinsured_sum_at_risk - 1 ELSE reinsured_sum_at_risk END AS reinsured_sum_at_risk,
                                CASE WHEN quarter = 'Q3' THEN treaty_id || '-N' ELSE treaty_id END AS treaty_id,
                                CASE WHEN quarter = 'Q2' THEN premium_amount + 1 ELSE premium_amount END AS premium_amount)
              FROM k_all WHERE quarter IN ('Q2', 'Q3', 'Q4')),
    k_new AS (SELECT * FROM k_tgt t WHERE NOT EXISTS (SELECT 1 FROM k_src s WHERE s.policy_number = t.policy_number
                  AND s.benefit_id = t.benefit_id AND s.valuation_date = t.valuation_date
                  AND s.policy_effective_date = t.policy_effective_date AND s.year = t.year AND s.quarter = t.quarter)
              UNION ALL SELECT * FROM k_src)"""


def _moved(spark, d):
    """Q1-Q3 as the validated premium, and Q2-Q4 as a promotion: lower sums and other amounts in Q2, another treaty in Q3."""
    p = Pipeline(spark, d)
    rows = _validated(p.premium_history)
    q2, q3 = F.col("quarter") == "Q2", F.col("quarter") == "Q3"
    src = (rows.filter(F.col("quarter").isin("Q2", "Q3", "Q4"))
           .withColumn("reinsured_sum_at_risk", F.when(q2, F.col("reinsured_sum_at_risk") - 1).otherwise(F.col("reinsured_sum_at_risk")).cast("decimal(18,2)"))
           .withColumn("premium_amount", F.when(q2, F.col("premium_amount") + 1).otherwise(F.col("premium_amount")).cast("decimal(18,2)"))
           .withColumn("treaty_id", F.when(q3, F.concat("treaty_id", F.lit("-N"))).otherwise(F.col("treaty_id"))))
    return rows.filter(F.col("quarter").isin("Q1", "Q2", "Q3")), src


@register("premium_index_kept", orc.with_views("""
    SELECT client_id, treaty_id, policy_number, benefit_id, CAST(max(reinsured_sum_at_risk) AS DECIMAL(18,2)) AS max_risar, max(valuation_date) AS last_paid_to,
           min(policy_effective_date) AS first_effective
    FROM k_new GROUP BY ALL""", _MOVED))
def q_premium_index_kept(spark, d):
    """The premium index kept by signed changes over an upsert that lowers sums and moves treaties."""
    tgt, src = _moved(spark, d)
    columns = (*dl.PREMIUM_KEYS, *dl.PREMIUM_VALUES)
    held = dl.fold_values(None, tgt.select(*columns, F.lit(1).alias(dl.SIGN)))
    index = dl.extremes(dl.fold_values(held, dl.changes(tgt, src, up.merge_keys("premium"), columns)))
    return index.select(*dl.PREMIUM_KEYS, F.col("_max_risar").alias("max_risar"), F.col("_last_paid_to").alias("last_paid_to"),
                        F.col("_first_effective").alias("first_effective"))


@register("period_totals_kept", orc.with_views("""
    SELECT client_id, category, year, quarter AS period, CAST(coalesce(sum(premium_amount), 0) AS DECIMAL(18,2)) AS file_amount
    FROM k_new GROUP BY client_id, category, year, quarter""", _MOVED))
def q_period_totals_kept(spark, d):
    """Period amounts kept by signed changes over the same upsert, as the reconciliation reads them."""
    tgt, src = _moved(spark, d)
    columns = (*rc.GROUP_KEYS, "premium_amount")
    held = dl.fold_totals(None, tgt.select(*columns, F.lit(1).alias(dl.SIGN)), "premium_amount")
    totals = dl.fold_totals(held, dl.changes(tgt, src, up.merge_keys("premium"), columns), "premium_amount")
    scope = tgt.select(*rc.GROUP_KEYS).unionByName(src.select(*rc.GROUP_KEYS))
    return dl.amounts_of_totals(totals, scope).filter("_has_table").drop("_has_table")


@register("history_duplicates", orc.with_views("""
    SELECT b.client_id, b.file_hash, b.year, b.quarter, count(*) AS rows_seen_before
    FROM (SELECT * FROM c_premium WHERE category = 'premium_adj') b
    WHERE EXISTS (SELECT 1 FROM c_premium h WHERE h.category = 'premium' AND h.client_id = b.client_id AND h.policy_number = b.policy_number
                    AND h.benefit_id = b.benefit_id AND h.valuation_date = b.valuation_date)
    GROUP BY ALL"""))
def q_history_duplicates(spark, d):
    """Rows of the adjustment files whose key the premium history holds; the history is read only in the (year, quarter)
    partitions whose key bitmaps meet those of the batch."""
    c = Pipeline(spark, d).clean_premium
    history, batch = c.filter(F.col("category") == "premium"), c.filter(F.col("category") == "premium_adj")
    keys, by, exact = ("client_id", *va.PREMIUM_DUP_KEYS), ("year", "quarter"), ("valuation_date",)
    read = pr.partitions_to_read(pr.key_maps(history, keys, by, exact), pr.key_maps(batch, keys, exact=exact), by, exact)
    old = history.join(read, list(by), "left_semi").select(*keys).distinct()
    return (batch.join(old, list(keys), "left_semi").groupBy("client_id", "file_hash", "year", "quarter")
            .agg(F.count(F.lit(1)).alias("rows_seen_before")))


# ------------------------------------------------------------------ SOA work lists
@register("soa_net", orc.with_views("""
    SELECT client_id, year, period, version,
        CAST(premium_soa - claims_soa - commission_soa - tax_soa + coalesce(list_sum(list_transform(items,
             lambda x: CASE WHEN lower(trim(x.direction)) = 'credit' THEN x.amount ELSE -x.amount END)), 0) AS DECIMAL(18,2)) AS net_soa,
        array_to_string(list_filter([
            CASE WHEN list_bool_or(list_transform(items, lambda x: coalesce(trim(x.label), '') = '')) THEN 'ITEM_LABEL_MISSING' END,
            CASE WHEN list_bool_or(list_transform(items, lambda x: NOT coalesce(lower(trim(x.direction)) IN ('credit', 'debit'), false)))
                 THEN 'ITEM_DIRECTION_INVALID' END,
            CASE WHEN list_bool_or(list_transform(items, lambda x: x.amount < 0)) THEN 'ITEM_AMOUNT_NEGATIVE' END],
            lambda x: x IS NOT NULL), '|') AS issues
    FROM (SELECT *, json_transform(additional_items,
            '[{"label":"VARCHAR","amount":"DECIMAL(18,2)","direction":"VARCHAR"}]') AS items FROM soa)"""))
def q_soa_net(spark, d):
    """net SOA from amounts and JSON additional items (credit +, debit -) and item issues."""
    s = soa_fixture(Pipeline(spark, d))
    items = so.parse_items()
    return s.select("client_id", "year", "period", "version",
                    so.net_soa("premium_soa", "claims_soa", "commission_soa", "tax_soa", items).alias("net_soa"),
                    F.array_join(so.item_issues(items), "|").alias("issues"))


def _periods(p: Pipeline):
    files = p.staged_premium.select("client_id", "file_hash", "file_name", "category", "year", "quarter").unionByName(
        p.staged_claims.select("client_id", "file_hash", "file_name", "category", "year", "quarter"))
    return so.uploaded_periods(fx.tracking_from_files(files), REPORT_DATE)


_PERIODS_SQL = f"""
    up AS (SELECT DISTINCT client_id, year, quarter AS period FROM tracking
           WHERE uploaded_at >= CAST(DATE '{REPORT_DATE}' AS TIMESTAMP)
             AND uploaded_at < CAST(DATE '{REPORT_DATE}' + 1 AS TIMESTAMP)),
    soa_last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY client_id, year, period ORDER BY version DESC) AS rn
                                FROM soa) WHERE rn = 1)
"""


def _with_periods(select: str) -> str:
    return orc.with_views(select, _PERIODS_SQL)


@register("soa_worklist", _with_periods("""
    SELECT u.client_id, u.year, u.period,
        CASE WHEN s.status IS NULL THEN 'READY_FOR_SOA_ENTRY' ELSE 'REJECTED - RESUBMISSION REQUIRED' END AS action
    FROM up u LEFT JOIN soa_last s USING (client_id, year, period)
    WHERE s.status IS NULL OR s.status = 'REJECTED'"""))
def q_soa_worklist(spark, d):
    """Periods uploaded on the report day that need an SOA action."""
    p = Pipeline(spark, d)
    return so.soa_worklist(_periods(p), soa_fixture(p))


@register("soa_board", _with_periods("""
    SELECT u.client_id, u.year, u.period, s.version, coalesce(s.status, 'READY_FOR_SOA_ENTRY') AS status,
        CASE WHEN s.status IS NULL OR s.status = 'REJECTED' THEN 'action_required'
             WHEN s.status = 'PENDING_APPROVAL' THEN 'pending_approval' WHEN s.status = 'APPROVED' THEN 'approved'
             WHEN s.status = 'RECONCILED' THEN 'reconciled' END AS bucket,
        s.status = 'RECONCILED' AS adjustment_candidate
    FROM up u LEFT JOIN soa_last s USING (client_id, year, period)
    WHERE s.status IS NULL OR s.status IN ('REJECTED', 'PENDING_APPROVAL', 'APPROVED', 'RECONCILED')"""))
def q_soa_board(spark, d):
    """SOA dashboard buckets for the periods uploaded on the report day."""
    p = Pipeline(spark, d)
    return so.soa_board(_periods(p), soa_fixture(p)).select(
        "client_id", "year", "period", "version", "status", "bucket", "adjustment_candidate")


def _decisions(soa):
    """Decisions on every SOA version, derived from its keys (approve / reject / duplicate)."""
    k = (F.col("year") + F.col("version") + F.substring("period", 2, 1).cast("int")) % 4
    return soa.select(
        "client_id", "year", "period", "version",
        F.when(k == 0, "approve").when(k == 1, "reject").when(k == 2, "duplicate").otherwise("approve").alias("action"),
        F.when(k == 3, F.col("entered_by")).otherwise(F.lit("manager")).alias("approved_by"),
        F.when((k == 1) & (F.col("version") == 1), F.lit("amounts differ")).alias("rejection_reason"))


_DEC_SQL = """
    dec AS (SELECT client_id, year, period, version,
                CASE (year + version + CAST(substr(period, 2, 1) AS INTEGER)) % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'reject'
                     WHEN 2 THEN 'duplicate' ELSE 'approve' END AS action,
                CASE WHEN (year + version + CAST(substr(period, 2, 1) AS INTEGER)) % 4 = 3 THEN entered_by ELSE 'manager' END AS approved_by,
                CASE WHEN (year + version + CAST(substr(period, 2, 1) AS INTEGER)) % 4 = 1 AND version = 1
                     THEN 'amounts differ' END AS rejection_reason
              FROM soa)"""


@register("soa_decisions", orc.with_views("""
    SELECT d.client_id, d.year, d.period, d.version, d.action,
        array_to_string(list_filter([
            CASE WHEN s.status IS NULL THEN 'ENTRY_NOT_FOUND' END,
            CASE WHEN d.action NOT IN ('approve', 'reject', 'duplicate') THEN 'UNKNOWN_ACTION' END,
            CASE WHEN d.action IN ('approve', 'reject') AND coalesce(trim(d.approved_by), '') = '' THEN 'APPROVER_REQUIRED' END,
            CASE WHEN d.action = 'approve' AND trim(d.approved_by) = trim(s.entered_by) THEN 'SEGREGATION_OF_DUTIES' END,
            CASE WHEN d.action = 'reject' AND coalesce(trim(d.rejection_reason), '') = '' THEN 'REASON_REQUIRED' END],
            lambda x: x IS NOT NULL), '|') AS issues,
        CASE WHEN d.action = 'approve' AND trim(d.approved_by) = trim(s.entered_by) THEN s.status
             WHEN d.action = 'reject' AND coalesce(trim(d.rejection_reason), '') = '' THEN s.status
             WHEN d.action = 'approve' THEN 'APPROVED' WHEN d.action = 'reject' THEN 'REJECTED' ELSE 'DUPLICATE' END AS new_status
    FROM dec d LEFT JOIN soa s USING (client_id, year, period, version)""", _DEC_SQL))
def q_soa_decisions(spark, d):
    """Approve / reject / duplicate with approver checks, segregation of duties, mandatory reason."""
    s = soa_fixture(Pipeline(spark, d))
    out = so.apply_decisions(s, _decisions(s))
    return out.select("client_id", "year", "period", "version", "action",
                      F.array_join("issues", "|").alias("issues"), "new_status")


# ------------------------------------------------------------------ ingestion
from ..operators import canonical as cn  # noqa: E402
from ..operators import drift as dr  # noqa: E402
from ..operators import ingest as ig  # noqa: E402
from ..operators import reports as rp  # noqa: E402

INV_COLS = ("doc_id", "rel_path", "file_name", "client_id", "file_hash", "name_category", "year", "quarter", "category",
            "accepted", "reject_reason")


def inventory(spark, d):
    return ig.file_inventory(fx.landed_files(spark, d))


def tracking(spark, d):
    return inventory(spark, d).filter(F.col("accepted"))


@register("file_inventory", orc.with_views(f"SELECT {', '.join(INV_COLS)} FROM inv"))
def q_file_inventory(spark, d):
    """Name pattern, classification, client folder, content md5 of every landed file."""
    return inventory(spark, d).select(*INV_COLS)


@register("file_status", orc.with_views(
    "SELECT doc_id, client_id, file_name, file_hash, category, status, duplicate_count FROM fstatus"))
def q_file_status(spark, d):
    """G1, A2, A3, A4: CROSS_CLIENT_DUP > DUPLICATE > UNKNOWN_CATEGORY > SUCCESS per tracked file."""
    return ig.file_status(tracking(spark, d)).select("doc_id", "client_id", "file_name", "file_hash", "category",
                                                     "status", "duplicate_count")


@register("duplicate_members", orc.with_views("""
    SELECT DISTINCT file_hash, client_id, file_name FROM trk
    WHERE file_hash IN (SELECT file_hash FROM trk GROUP BY 1 HAVING count(*) > 1)"""))
def q_duplicate_members(spark, d):
    """A2/A3 as rows: members of every hash tracked more than once."""
    return ig.duplicate_members(tracking(spark, d))


@register("file_registration", orc.with_views("""
    SELECT file_hash, doc_id, client_id, file_name FROM (
      SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY doc_id) AS rn FROM trk
      WHERE uploaded_at >= TIMESTAMP '2024-01-02 00:00:00') c
    WHERE rn = 1 AND file_hash NOT IN (SELECT file_hash FROM trk WHERE uploaded_at < TIMESTAMP '2024-01-02 00:00:00')"""))
def q_file_registration(spark, d):
    """Later arrivals registered once per content hash (first wins), skipping hashes already tracked."""
    t = tracking(spark, d)
    day1 = F.lit("2024-01-02").cast("timestamp")
    return ig.register_files(t.filter(F.col("uploaded_at") >= day1), t.filter(F.col("uploaded_at") < day1),
                             order=["doc_id"], payload=["file_hash", "doc_id", "client_id", "file_name"])


@register("retry_skip_set", orc.with_views("SELECT client_id, file_hash FROM skipset"))
def q_retry_skip_set(spark, d):
    """Pairs already written or with >= 3 failures."""
    return ig.skip_set(fx.ingestion_log(spark, d))


@register("files_to_ingest", orc.with_views("""
    SELECT DISTINCT client_id, file_hash FROM ilog
    WHERE (client_id, file_hash) NOT IN (SELECT (client_id, file_hash) FROM skipset)"""))
def q_files_to_ingest(spark, d):
    """Tracked files minus the skip set."""
    log = fx.ingestion_log(spark, d)
    return ig.files_to_ingest(log.select("client_id", "file_hash").distinct(), log)


@register("run_queue", orc.with_views("""
    SELECT file_hash, client_id, file_name, category, year, quarter, quarter AS period, 'quarterly' AS period_type
    FROM (SELECT b.*, row_number() OVER (PARTITION BY b.file_hash ORDER BY b.client_id, b.file_name) AS rn
          FROM fstatus b LEFT JOIN (
              SELECT file_hash, status FROM (SELECT *, row_number() OVER (PARTITION BY file_hash
                                             ORDER BY run_id DESC, event_id DESC) AS r FROM sruns) WHERE r = 1) s
            USING (file_hash)
          WHERE b.status = 'SUCCESS' AND (s.status IS NULL OR s.status = 'FAILED'))
    WHERE rn = 1"""))
def q_run_queue(spark, d):
    """Bronze SUCCESS files never staged or whose latest staging run failed, once per hash."""
    files = fx.landed_files(spark, d)
    bronze = ig.file_status(tracking(spark, d))
    runs = fx.staging_runs(spark, d, files)
    return ig.staging_candidates(bronze, runs, order=("run_id", "event_id")).select(
        "file_hash", "client_id", "file_name", "category", "year", "quarter", "period", "period_type")


# ------------------------------------------------------------------ drift and mapping governance
def _unmapped(spark, d):
    h = fx.header_rows(spark, d)
    return dr.unmapped_columns(h, fx.column_mapping(h))


@register("schema_drift", orc.with_views("""
    SELECT client_id, file_hash, file_name, category, 'NEW_COLUMN' AS issue_type, column_name, '{run}' AS run_id
    FROM hdr_n h WHERE category <> 'others' AND NOT EXISTS (SELECT 1 FROM expcols e WHERE e.category = h.category
                                                              AND e.column_name = h.column_name)
    UNION ALL
    SELECT f.client_id, f.file_hash, f.file_name, f.category, 'MISSING_COLUMN', e.column_name, '{run}'
    FROM (SELECT DISTINCT client_id, file_hash, file_name, category FROM hdr_n WHERE category <> 'others') f
    JOIN expcols e ON e.category = f.category
    WHERE NOT EXISTS (SELECT 1 FROM hdr_n h WHERE h.file_hash = f.file_hash AND h.column_name = e.column_name)""".format(run=RUN_ID)))
def q_schema_drift(spark, d):
    """NEW_COLUMN / MISSING_COLUMN against the expected set (normalised names both sides)."""
    return dr.schema_drift(fx.header_rows(spark, d), dr.expected_frame(spark), RUN_ID).select(
        "client_id", "file_hash", "file_name", "category", "issue_type", "column_name", "run_id")


@register("mapping_gate", orc.with_views("""
    SELECT f.client_id, f.file_hash, f.file_name, f.category, f.columns, CAST(coalesce(u.n, 0) AS BIGINT) AS unmapped,
        CASE WHEN coalesce(u.n, 0) > 0 THEN 'BLOCKED' ELSE 'QUEUED' END AS status
    FROM (SELECT client_id, file_hash, file_name, category, count(*) AS columns FROM hdr_n GROUP BY ALL) f
    LEFT JOIN (SELECT file_hash, count(*) AS n FROM unm GROUP BY 1) u USING (file_hash)"""))
def q_mapping_gate(spark, d):
    """Files with unmapped headers blocked, the rest queued."""
    h = fx.header_rows(spark, d)
    return dr.mapping_gate(h, fx.column_mapping(h)).select("client_id", "file_hash", "file_name", "category", "columns",
                                                           "unmapped", "status")


@register("review_queue", orc.with_views("SELECT client_id, category, raw_col_name, file_name, status FROM rq_new"))
def q_review_queue(spark, d):
    """New PENDING review items unless an open one exists."""
    un = _unmapped(spark, d)
    return dr.review_queue_inserts(un, fx.review_queue(un)).select("client_id", "category", "raw_col_name", "file_name", "status")


def _queue_after(spark, d):
    un = _unmapped(spark, d)
    old = fx.review_queue(un)
    new = dr.review_queue_inserts(un, old).withColumn("de_resolved", F.lit(False))
    return old.unionByName(new)


def _review_decisions(queue):
    n = F.length("raw_col_name") % 4
    return (queue.filter(F.col("status") == "PENDING")
            .select("client_id", "category", "raw_col_name",
                    F.when(n == 0, "approve").when(n == 1, "affects_calculations").when(n == 2, "reject").alias("action"),
                    F.col("raw_col_name").alias("canonical_name"),
                    F.col("raw_col_name").startswith("policy").alias("is_critical"),
                    F.col("raw_col_name").contains("birth").alias("is_pii"))
            .filter(F.col("action").isNotNull()))


@register("mapping_versions", orc.with_views("""
    SELECT client_id, category, raw_col_name, raw_col_name AS canonical_name,
        CAST(coalesce(m.mx, 0) + row_number() OVER (PARTITION BY client_id, category ORDER BY raw_col_name) AS INTEGER) AS mapping_version,
        CASE length(raw_col_name) % 4 WHEN 0 THEN 'APPROVED' ELSE 'AFFECTS_CALCULATIONS' END AS status
    FROM rq_all q LEFT JOIN (SELECT client_id, category, max(mapping_version) AS mx FROM cmap GROUP BY ALL) m
      USING (client_id, category)
    WHERE q.status = 'PENDING' AND length(raw_col_name) % 4 IN (0, 1)"""))
def q_mapping_versions(spark, d):
    """Approved review items become mapping rows with the next version per (client, category)."""
    q = _queue_after(spark, d)
    h = fx.header_rows(spark, d)
    rows, _ = dr.apply_review_decisions(q.filter(F.col("status") == "PENDING"), _review_decisions(q), fx.column_mapping(h))
    return rows.select("client_id", "category", "raw_col_name", "canonical_name", "mapping_version", "status")


@register("pending_digest", orc.with_views("""
    SELECT client_id, count(*) AS pending_items, count(DISTINCT file_name) AS files
    FROM rq_all WHERE status = 'PENDING' GROUP BY client_id"""))
def q_pending_digest(spark, d):
    """Pending mapping reviews per client."""
    return dr.pending_digest(_queue_after(spark, d))


@register("open_review_items", orc.with_views("""
    SELECT client_id, category, raw_col_name, status FROM rq_all
    WHERE status = 'PENDING' OR (status = 'AFFECTS_CALCULATIONS' AND NOT coalesce(de_resolved, false))"""))
def q_open_review_items(spark, d):
    """Open review items (pending, or affecting calculations and not yet resolved)."""
    return dr.open_review_items(_queue_after(spark, d)).select("client_id", "category", "raw_col_name", "status")


def _timed_queue(spark, d):
    """The review queue with a creation time (the fixture's column names arrive on days of their length)."""
    q = _queue_after(spark, d)
    return q.withColumn("created_at", F.timestamp_seconds(F.lit(1704067200) + F.length("raw_col_name") * 86400))


_TIMED = """timed AS (SELECT *, strftime(TIMESTAMP '2024-01-01' + to_days(CAST(length(raw_col_name) AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS created_at
                  FROM rq_all)"""


@register("review_list", orc.with_views("""
    SELECT client_id, category, raw_col_name, file_name, created_at FROM timed WHERE status = 'PENDING'
    ORDER BY created_at DESC, client_id, category, raw_col_name""", _TIMED))
def q_review_list(spark, d):
    """Pending review items, newest first."""
    return dr.review_list(_timed_queue(spark, d)).select("client_id", "category", "raw_col_name", "file_name",
                                                         F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@register("review_item", orc.with_views("""
    SELECT client_id, category, raw_col_name, file_name, status FROM timed
    WHERE client_id = 'client_1' AND category = 'premium' AND raw_col_name = (SELECT min(raw_col_name) FROM rq_all
        WHERE client_id = 'client_1' AND category = 'premium')""", _TIMED))
def q_review_item(spark, d):
    """Point lookup of one review item (the first column by name of one client and category)."""
    q = _timed_queue(spark, d)
    first = q.filter("client_id = 'client_1' AND category = 'premium'").agg(F.min("raw_col_name")).first()[0]
    return dr.review_item(q, "client_1", "premium", first or "").select("client_id", "category", "raw_col_name", "file_name", "status")


# ------------------------------------------------------------------ canonicalisation and PII
_CRAW = """
    craw AS (SELECT 'client_' || CAST(c_nationkey % 3 AS VARCHAR) AS client_id, CAST(c_custkey AS VARCHAR) AS customer_key,
        c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation_key, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS acct_bal_pct,
        c_mktsegment AS mkt_segment, CASE WHEN c_custkey % 4 = 0 THEN 'X' || CAST(c_custkey AS VARCHAR) END AS insured_id
      FROM customer),
    ccanon AS (SELECT client_id,
        CASE WHEN client_id = 'client_0' THEN acct_bal_pct END AS balance,
        CASE WHEN client_id = 'client_1' THEN nation_key END AS country_code,
        coalesce(insured_id, CASE WHEN client_id IN ('client_0', 'client_1', 'client_2') THEN customer_key END) AS insured_id,
        CASE WHEN client_id IN ('client_0', 'client_1', 'client_2') THEN name END AS insured_name,
        CASE WHEN client_id IN ('client_0', 'client_2') THEN mkt_segment END AS segment
      FROM craw)"""


def _canonical(spark, d):
    return cn.canonicalise(cn.normalize_columns(fx.customer_raw(spark, d)), fx.customer_mapping(spark))


@register("canonicalise", orc.with_views("SELECT * FROM ccanon", _CRAW))
def q_canonicalise(spark, d):
    """Per-client versioned mapping to canonical names in one projection."""
    return _canonical(spark, d)


@register("pii_mask", orc.with_views("""
    SELECT * REPLACE (CASE WHEN client_id IN ('client_0', 'client_1') THEN sha256(insured_name) ELSE insured_name END
                      AS insured_name) FROM ccanon""", _CRAW))
def q_pii_mask(spark, d):
    """SHA-256 of the columns each client flags as PII."""
    return cn.mask_pii(_canonical(spark, d), fx.customer_mapping(spark))


# ------------------------------------------------------------------ calendar, as-of, reports
from ..functions import columns as fc  # noqa: E402
from ..operators import joins as jn  # noqa: E402


@register("policy_calendar", orc.with_views("""
    SELECT client_id, file_hash, year, quarter,
        count(*) FILTER (WHERE date_trunc('month', valuation_date) = date_trunc('month', issue_date)) AS n_new,
        count(*) FILTER (WHERE date_trunc('month', valuation_date) <> date_trunc('month', issue_date)) AS n_renew,
        min(CAST(date_trunc('quarter', valuation_date) AS DATE)) AS quarter_start,
        max(CAST(date_trunc('quarter', valuation_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)) AS quarter_end,
        count(*) FILTER (WHERE year(valuation_date) - year(date_of_birth)
              - CASE WHEN month(valuation_date) < month(date_of_birth) OR (month(valuation_date) = month(date_of_birth)
                      AND day(valuation_date) < day(date_of_birth)) THEN 1 ELSE 0 END
              <> floor(date_diff('day', date_of_birth, valuation_date) / 365.25)) AS n_age_mismatch,
        CAST(sum(sum_at_risk * TRY_CAST(ri_share_pct AS DECIMAL(9,2)) * 0.01) AS DECIMAL(18,2)) AS ri_share_total
    FROM c_premium GROUP BY ALL"""))
def q_policy_calendar(spark, d):
    """new/renew, quarter bounds, completed-years vs day-count age, RI share per file."""
    c = Pipeline(spark, d).clean_premium
    v, i, b = "valuation_date", "issue_date", "date_of_birth"
    share = fc.reinsured_share("sum_at_risk", F.col("ri_share_pct").try_cast("decimal(9,2)"))
    return c.groupBy("client_id", "file_hash", "year", "quarter").agg(
        F.count_if(fc.new_or_renew(v, i) == "New").alias("n_new"),
        F.count_if(fc.new_or_renew(v, i) == "Renew").alias("n_renew"),
        F.min(fc.quarter_start(v)).alias("quarter_start"), F.max(fc.quarter_end(v)).alias("quarter_end"),
        F.count_if(fc.age_completed_years(v, b) != fc.age_by_days(v, b)).alias("n_age_mismatch"),
        F.sum(share).cast("decimal(18,2)").alias("ri_share_total"))


@register("asof_premium", orc.with_views("""
    SELECT c.file_hash, c.claim_id, c.policy_number, c.benefit_id, c.loss_event_date, p.valuation_date AS last_valuation_date
    FROM c_claims c ASOF LEFT JOIN c_premium p
      ON c.client_id = p.client_id AND c.policy_number = p.policy_number AND c.benefit_id = p.benefit_id
     AND c.loss_event_date >= p.valuation_date"""))
def q_asof_premium(spark, d):
    """For every claim, the last premium valuation at or before the loss date (skew-aware as-of join)."""
    p = Pipeline(spark, d)
    claims = p.clean_claims.select("client_id", "file_hash", "claim_id", "policy_number", "benefit_id", "loss_event_date")
    prem = p.clean_premium.select("client_id", "policy_number", "benefit_id", "valuation_date")
    out = jn.asof_join(claims, prem, ["client_id", "policy_number", "benefit_id"], "loss_event_date", "valuation_date",
                       ["valuation_date"], prefix="last_")
    return out.select("file_hash", "claim_id", "policy_number", "benefit_id", "loss_event_date", "last_valuation_date")


def _all_checks(p: Pipeline):
    """Check rows of both validations, each written when it is done (``audit/validation_results`` of the pipeline): the
    shuffles of one are gone before the other begins."""
    premium = p.check_table("premium-checks", p.premium_validation)
    return premium.unionByName(p.check_table("claims-checks", p.claims_validation))


_ALL_CHECKS = """
    all_checks AS (SELECT *, TIMESTAMP '{t1}' AS checked_at FROM p_checks
                   UNION ALL SELECT *, TIMESTAMP '{t2}' AS checked_at FROM c_checks)""".format(t1=CHECKED_AT, t2=orc.CHECKED_AT2)


@register("run_summary", orc.with_views("""
    SELECT run_id, strftime(min(checked_at), '%Y-%m-%d %H:%M:%S') AS run_date, count(*) AS total_checks,
        count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'FAIL') AS failed,
        count(*) FILTER (WHERE status = 'WARN') AS warned, count(*) FILTER (WHERE status = 'SKIPPED') AS skipped
    FROM all_checks GROUP BY run_id ORDER BY min(checked_at) DESC, run_id DESC LIMIT 10""", _ALL_CHECKS))
def q_run_summary(spark, d):
    """Last 10 validation runs with counts by status."""
    out = rp.run_summary(_all_checks(Pipeline(spark, d)))
    return out.withColumn("run_date", F.date_format("run_date", "yyyy-MM-dd HH:mm:ss"))


@register("open_failures", orc.with_views("""
    SELECT client_id, file_name, check_name, failed_count, total_count, run_id,
        strftime(checked_at, '%Y-%m-%d %H:%M:%S') AS checked_at
    FROM all_checks WHERE status = 'FAIL'
    ORDER BY all_checks.checked_at DESC, client_id, file_name, check_name LIMIT 100""", _ALL_CHECKS))
def q_open_failures(spark, d):
    """O3: the newest 100 FAIL check rows (top-k is the feature; total order)."""
    out = rp.open_failures(_all_checks(Pipeline(spark, d)))
    return out.withColumn("checked_at", F.date_format("checked_at", "yyyy-MM-dd HH:mm:ss"))


@register("run_detail", orc.with_views("""
    SELECT client_id, file_name, category, check_name, status, failed_count, total_count,
        CAST(coalesce(list_position([{order}], check_name), 999) AS INTEGER) AS check_rank
    FROM all_checks WHERE run_id = '{run}'""".format(
    order=", ".join(f"'{c}'" for c in rp.CHECK_ORDER), run=orc.RUN_ID2), _ALL_CHECKS))
def q_run_detail(spark, d):
    """One run's checks with the display rank of each check name."""
    out = rp.run_detail(_all_checks(Pipeline(spark, d)), orc.RUN_ID2)
    return out.select("client_id", "file_name", "category", "check_name", "status", "failed_count", "total_count",
                      "check_rank")


@register("staging_summary", orc.with_views("""
    SELECT '{run}' AS run_id, count(*) AS total_files, count(*) AS processed_files, CAST(0 AS BIGINT) AS failed_files,
        CAST(sum(c) AS BIGINT) AS rows_to_silver, CAST(sum(q) AS BIGINT) AS rows_quarantined
    FROM (SELECT file_hash, count(*) FILTER (WHERE len(dq_issues) = 0) AS c, count(*) FILTER (WHERE len(dq_issues) > 0) AS q
          FROM (SELECT file_hash, dq_issues FROM s_premium UNION ALL SELECT file_hash, dq_issues FROM s_claims) GROUP BY 1)
    """.format(run=RUN_ID)))
def q_staging_summary(spark, d):
    """Staging run summary (files, rows to silver, rows quarantined)."""
    logp = st.staging_log(staged_premium(spark, d), RUN_ID)
    logc = st.staging_log(staged_claims(spark, d), RUN_ID)
    return st.staging_summary(logp.unionByName(logc))


@register("latest_staging_run", orc.with_views("SELECT max(run_id) AS run_id FROM sruns WHERE status = 'SUCCESS'"))
def q_latest_staging_run(spark, d):
    """O1: latest successful staging run id (sortable yyyyMMdd_HHmmssZ)."""
    return rp.latest_successful_run(fx.staging_runs(spark, d, fx.landed_files(spark, d)))


# ------------------------------------------------------------------ streaming arrival (K1)
from ..session import scratch_dir  # noqa: E402
from ..sources import bucketed as bk  # noqa: E402
from ..streaming import arrival as ar  # noqa: E402
from ..streaming.metrics import MetricStore  # noqa: E402


@register("stream_bronze", orc.with_views("""
    SELECT file_hash, doc_id, client_id, file_name FROM (
      SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY doc_id) AS rn FROM trk) WHERE rn = 1"""))
def q_stream_bronze(spark, d):
    """Documents arrive through a file-source stream; foreachBatch registers each
    content hash once (first arrival wins) into a tracking table; availableNow trigger."""
    import uuid
    stream = fx.table_stream(spark, d, "documents")
    run = uuid.uuid4().hex[:12]
    tracking_path = scratch_dir(spark, f"tracking-{run}")
    q, _ = ar.run_arrivals(spark, stream, tracking_path, scratch_dir(spark, f"arrivals-ckpt-{run}"),
                           lambda b: ig.file_inventory(fx.landed_files_from(b)).filter(F.col("accepted")))
    q.stop()
    return spark.read.parquet(tracking_path).select("file_hash", "doc_id", "client_id", "file_name")


@register("stream_metrics", orc.with_views("""
    SELECT 'file' AS source, file_hash, count(*) AS rows_seen, CAST(1 AS BIGINT) AS rows_written FROM trk GROUP BY file_hash
    UNION ALL SELECT 'batch', NULL, count(*), count(DISTINCT file_hash) FROM trk
    UNION ALL SELECT 'progress', NULL, count(*), NULL FROM documents"""))
def q_stream_metrics(spark, d):
    """What the arrival stream of documents stored: per content the copies seen and registered, the totals that the
    batches observed, and the rows the engine reported as read; summed over the batches of the run."""
    import uuid
    stream = fx.table_stream(spark, d, "documents")
    run = uuid.uuid4().hex[:12]
    store = MetricStore(spark, scratch_dir(spark, f"stream-metrics-{run}"), f"arrivals_{run}")
    ar.run_arrivals(spark, stream, scratch_dir(spark, f"tracking-{run}"), scratch_dir(spark, f"arrivals-ckpt-{run}"),
                    lambda b: ig.file_inventory(fx.landed_files_from(b)).filter(F.col("accepted")), store=store)
    return store.read().groupBy("source", "file_hash").agg(F.sum("rows_seen").alias("rows_seen"), F.sum("rows_written").alias("rows_written"))


@register("policy_history", orc.with_views("""
    SELECT c.client_id, c.file_hash, count(*) AS n_claims, count(h.n) AS n_with_premium, CAST(sum(h.amt) AS DECIMAL(28,2)) AS premium_total
    FROM c_claims c LEFT JOIN (SELECT client_id, policy_number, count(*) AS n, sum(premium_amount) AS amt FROM c_premium GROUP BY 1, 2) h
      ON h.client_id = c.client_id AND h.policy_number = c.policy_number
    GROUP BY c.client_id, c.file_hash"""))
def q_policy_history(spark, d):
    """Claims met with the premium of their policies, from a premium table laid out by (client, policy); its
    aggregate and the join need no shuffle of the table."""
    import uuid
    p, keys = Pipeline(spark, d), ["client_id", "policy_number"]
    path = scratch_dir(spark, f"premium-by-policy-{uuid.uuid4().hex[:12]}")
    rows = p.clean_premium.select(*keys, "premium_amount")
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    bk.append_bucketed(rows, path, keys, bk.buckets_for(int(str(size))))
    history = bk.read_bucketed(spark, path).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("premium_amount").alias("_amt"))
    claims = p.clean_claims.groupBy("file_hash", *keys).agg(F.count(F.lit(1)).alias("_c"))
    return (bk.aligned(claims, path).join(history, keys, "left").groupBy("client_id", "file_hash")
            .agg(F.sum("_c").alias("n_claims"), F.coalesce(F.sum(F.when(F.col("_n").isNotNull(), F.col("_c"))), F.lit(0)).alias("n_with_premium"),
                 F.sum(F.col("_amt") * F.col("_c")).cast("decimal(28,2)").alias("premium_total")))


@register("promoted_rows", orc.with_views("""
    SELECT f.client_id, f.file_hash, f.file_name, f.year, f.quarter,
        count(*) FILTER (WHERE NOT f.rejected AND NOT coalesce(r.f_treaty OR r.f_dup, false)) AS promoted_rows,
        count(*) FILTER (WHERE f.rejected OR coalesce(r.f_treaty OR r.f_dup, false)) AS quarantined_rows
    FROM p_flags r JOIN p_files f USING (file_hash)
    GROUP BY ALL"""))
def q_promoted_rows(spark, d):
    """V19 + P8/P11 promotion path: rows promoted (clean rows of files under the 30 % threshold) vs quarantined."""
    v = Pipeline(spark, d).premium_validation()
    t = v.tagged_rows()
    ok = ~F.col("rejected") & (F.size("dq_reasons") == 0)
    return t.groupBy("client_id", "file_hash", "file_name", "year", "quarter").agg(
        F.count_if(ok).alias("promoted_rows"), F.count_if(~ok).alias("quarantined_rows"))


# ------------------------------------------------------------------ row-level entries and the landing scan
@register("ingestion_counts", orc.with_views(f"""
    SELECT client_id, file_name, category, year, quarter, count(*) AS data_lines, count(*) AS rows_written, any_value(n) AS n_columns,
        sum(len(list_filter(v, lambda x: x IS NOT NULL)))::BIGINT AS n_values,
        sum(CASE WHEN policy_number IS NULL THEN 0 ELSE length(policy_number) END)::BIGINT AS policy_chars
    FROM (SELECT client_id, file_name, category, year, quarter, policy_number, {len(fx.RAW_PREMIUM)} AS n, [{', '.join(fx.RAW_PREMIUM)}] AS v FROM raw_premium
          UNION ALL
          SELECT client_id, file_name, category, year, quarter, policy_number, {len(fx.RAW_CLAIMS)} AS n, [{', '.join(fx.RAW_CLAIMS)}] AS v FROM raw_claims)
    GROUP BY ALL"""))
def q_ingestion_counts(spark, d):
    """All raw files landed as CSV; inventory, one scan for all headers, rows counted against lines per file."""
    import uuid

    from ..sources import files as sf
    root = scratch_dir(spark, f"landing-{uuid.uuid4().hex[:12]}")
    fx.land_csv(spark, [(fx.premium_raw(spark, d), fx.RAW_PREMIUM), (fx.claims_raw(spark, d), fx.RAW_CLAIMS)], root)
    land = materialize(sf.scan_landing(spark, root), "landed")
    rows = sf.scan_bordereaux(spark, land)
    per = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows_written"), F.max(F.size("data")).cast("int").alias("n_columns"),
        F.sum(F.size(F.array_compact(F.map_values("data")))).alias("n_values"),
        F.coalesce(F.sum(F.length(F.col("data")["policy_number"])), F.lit(0).cast("long")).alias("policy_chars"))
    return land.filter("accepted").join(per, "path").select(
        "client_id", "file_name", "category", "year", "quarter", "data_lines", "rows_written", "n_columns", "n_values", "policy_chars")


@register("staged_rows", orc.with_views("""
    SELECT file_hash, _fp, policy_number, premium_amount AS amount, array_to_string(dq_issues, '|') AS issues FROM s_premium
    UNION ALL SELECT file_hash, _fp, policy_number, claim_amount, array_to_string(dq_issues, '|') FROM s_claims"""))
def q_staged_rows(spark, d):
    """Every staged premium and claims row with its typed amount and its rule tags."""
    cols = lambda df, amount: df.select("file_hash", "_fp", "policy_number", F.col(amount).alias("amount"), F.array_join("dq_issues", "|").alias("issues"))
    return cols(staged_premium(spark, d), "premium_amount").unionByName(cols(staged_claims(spark, d), "claim_amount"))


@register("tagged_premium_rows", orc.with_views("""
    SELECT file_hash, _fp, policy_number, treaty_id, coalesce(f_treaty, false) AS no_treaty, coalesce(f_dup, false) AS duplicate FROM p_flags"""))
def q_tagged_premium_rows(spark, d):
    """Every premium row joined with its treaties, with the two tags that quarantine it."""
    rows = premium_validation(spark, d).rows
    return rows.select("file_hash", "_fp", "policy_number", "treaty_id", F.array_contains("dq_reasons", "TREATY_MAPPING").alias("no_treaty"),
                       F.array_contains("dq_reasons", "DUPLICATE_PREMIUM").alias("duplicate"))


@register("tagged_claims_rows", orc.with_views("""
    SELECT file_hash, _fp, claim_id, treaty_id, array_to_string(list_filter([CASE WHEN f_treaty THEN 'TREATY_MAPPING' END, CASE WHEN f_dup THEN 'DUPLICATE_CLAIMS' END,
        CASE WHEN f_prem THEN 'PREMIUM_EXISTS' END, CASE WHEN f_risar THEN 'RISAR_GTE_CLAIM' END, CASE WHEN f_cal THEN 'CAL_CHECK' END],
        lambda x: x IS NOT NULL), '|') AS reasons FROM c_flags"""))
def q_tagged_claims_rows(spark, d):
    """Every claims row joined with its treaties, with the tags that quarantine it."""
    rows = claims_validation(spark, d).rows
    return rows.select("file_hash", "_fp", "claim_id", "treaty_id", F.array_join("dq_reasons", "|").alias("reasons"))


@register("quarantine_rows", orc.with_views("""
    SELECT file_hash, _fp, unnest(dq_issues) AS rule FROM s_premium UNION ALL SELECT file_hash, _fp, unnest(dq_issues) FROM s_claims"""))
def q_quarantine_rows(spark, d):
    """Every quarantined row once for each rule it breaks."""
    cols = lambda df: df.filter(F.size("dq_issues") > 0).select("file_hash", "_fp", F.explode("dq_issues").alias("rule"))
    return cols(staged_premium(spark, d)).unionByName(cols(staged_claims(spark, d)))


@register("sql_formulas", orc.with_views("""
    SELECT p.client_id, p.file_hash,
        CAST(sum(CASE WHEN quota_share IS NOT NULL AND retention_limit IS NOT NULL THEN
                   CASE WHEN sum_at_risk > retention_limit THEN (sum_at_risk - retention_limit) * quota_share ELSE sum_at_risk * quota_share END
                 WHEN quota_share IS NOT NULL THEN sum_at_risk * quota_share
                 WHEN surplus_multiple IS NOT NULL THEN least(sum_at_risk - retention_limit, surplus_multiple * retention_limit)
                 ELSE reinsured_sum_at_risk END) AS DECIMAL(24,2)) AS risar_total,
        CAST(sum(reinsured_sum_at_risk * 0.001 * 1.25 * CASE lower(policy_renewal_freq) WHEN 'annual' THEN 1 WHEN 'quarterly' THEN 4 WHEN 'monthly' THEN 12 ELSE 1 END)
             AS DECIMAL(24,2)) AS premium_total,
        count(*) FILTER (WHERE date_trunc('month', valuation_date) = date_trunc('month', issue_date)) AS n_new,
        sum(year(valuation_date) - year(date_of_birth) - CASE WHEN month(valuation_date) < month(date_of_birth)
            OR (month(valuation_date) = month(date_of_birth) AND day(valuation_date) < day(date_of_birth)) THEN 1 ELSE 0 END)::BIGINT AS years,
        sum(floor(date_diff('day', date_of_birth, valuation_date) / 365.25))::BIGINT AS years_by_days,
        max('Q' || CAST(quarter(valuation_date) AS VARCHAR)) AS label
    FROM c_premium p JOIN treaty_a t USING (client_id, benefit_id, plan_code) GROUP BY ALL"""))
def q_sql_formulas(spark, d):
    """F1-F7 as SQL functions, called from spark.sql over the clean premium rows and their treaties."""
    from ..functions.sql import register_sql_functions
    register_sql_functions(spark)
    p = Pipeline(spark, d)
    rows = p.clean_premium.join(p.treaty_primary.select("client_id", "benefit_id", "plan_code", "quota_share", "retention_limit", "surplus_multiple",
                                                        "policy_renewal_freq"), ["client_id", "benefit_id", "plan_code"])
    return spark.sql("""
        SELECT client_id, file_hash,
            CAST(sum(bdx_reinsured_sum(sum_at_risk, quota_share, retention_limit, surplus_multiple, reinsured_sum_at_risk)) AS DECIMAL(24,2)) AS risar_total,
            CAST(sum(bdx_expected_premium(reinsured_sum_at_risk, 1.25BD, bdx_frequency_multiplier(policy_renewal_freq))) AS DECIMAL(24,2)) AS premium_total,
            count_if(bdx_new_or_renew(valuation_date, issue_date) = 'New') AS n_new,
            CAST(sum(bdx_age_completed_years(valuation_date, date_of_birth)) AS BIGINT) AS years,
            CAST(sum(bdx_age_by_days(valuation_date, date_of_birth)) AS BIGINT) AS years_by_days,
            max(bdx_quarter_label(valuation_date)) AS label
        FROM {rows} GROUP BY client_id, file_hash""", rows=rows)


@register("file_offers")
def q_file_offers(spark, d):
    """The events table as a stream of file events (file = user and week) through the state per file; what each
    file was offered, dequeued or given up for.  No SQL: state and timers; tested against a plain loop."""
    import uuid

    from ..streaming import offers as of
    e = fx.table_stream(spark, d, "events")
    run = uuid.uuid4().hex[:12]
    actions = scratch_dir(spark, f"offers-{run}")
    of.run_offers(spark, fx.file_events(e), actions, scratch_dir(spark, f"offers-ckpt-{run}"))
    return spark.read.parquet(actions).select("file_hash", "action", "failures", "at")


@register("mapping_as_of", """
    WITH log AS (SELECT 'C' || (user_id % 7) AS client_id, CASE WHEN user_id % 2 = 0 THEN 'premium' ELSE 'claims' END AS category,
            'col_' || (event_id % 40) AS raw, 'canon_' || (event_id % 13) AS canonical,
            CASE event_type WHEN 'purchase' THEN 'approve' WHEN 'signup' THEN 'affects_calculations' WHEN 'error' THEN 'reject' ELSE 'retire' END AS action, ts
        FROM events WHERE event_type NOT IN ('view', 'error')),
    one AS (SELECT client_id, category, raw, ts, canonical, action IN ('approve', 'affects_calculations') AS opens FROM log
        QUALIFY row_number() OVER (PARTITION BY client_id, category, raw, ts ORDER BY canonical DESC, action IN ('approve', 'affects_calculations') DESC) = 1),
    spans AS (SELECT *, lead(ts) OVER (PARTITION BY client_id, category, raw ORDER BY ts) AS until FROM one),
    files AS (SELECT md5('file' || event_id) AS file_hash, 'C' || (user_id % 7) AS client_id, CASE WHEN user_id % 2 = 0 THEN 'premium' ELSE 'claims' END AS category, ts
        FROM events WHERE event_type = 'view')
    SELECT f.file_hash, f.client_id, f.category, s.raw AS raw_col_name, s.canonical AS canonical_name
    FROM files f JOIN spans s ON s.client_id = f.client_id AND s.category = f.category AND s.opens AND f.ts >= s.ts AND (s.until IS NULL OR f.ts < s.until)""")
def q_mapping_as_of(spark, d):
    """Events as mapping decisions and uploads; the mapping of each upload as of its time."""
    from ..operators import drift as dr
    log, files = fx.mapping_decisions(spark, d)
    return dr.mapping_as_of(files, materialize(dr.mapping_intervals(log), "mapping-intervals")).select(
        "file_hash", "client_id", "category", "raw_col_name", "canonical_name")
