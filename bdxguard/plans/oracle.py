"""DuckDB SQL for the fixture views and the oracle queries.

Written independently of the Spark operators, in plain SQL, so the driver can
run each registered query against it.  The fixture views here must describe
the same data as ``fixtures.py``.  Each oracle query is ``WITH <views> SELECT``.
"""

from __future__ import annotations

from .fixtures import BENEFITS, CHANNELS, COUNTRIES, PRODUCTS, RAW_CLAIMS, RAW_PREMIUM, SOA_ITEMS

RUN_ID = "20240101_000000Z"
CHECKED_AT = "2024-01-01 00:00:00"
# claims are validated in a second run, after premium promotion
RUN_ID2 = "20240101_000100Z"
CHECKED_AT2 = "2024-01-01 00:01:00"


def _pick(idx: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {idx} {whens} END)"


def _fp(cols) -> str:
    return "md5(concat_ws('|', file_hash, " + ", ".join(cols) + "))"


_BASE = """
    SELECT l.*, o_custkey, o_totalprice, o_orderdate, c_name, c_nationkey, r_name, p_type,
           CAST(l_shipdate AS DATE) AS ship, CAST(o_orderdate AS DATE) AS od,
           r_name AS client_id,
           CASE WHEN l_linestatus = 'O' AND quarter(CAST(l_shipdate AS DATE)) = 4 THEN '{cat}_adj' ELSE '{cat}' END AS category,
           CAST(year(CAST(l_shipdate AS DATE)) AS INTEGER) AS year,
           'Q' || CAST(quarter(CAST(l_shipdate AS DATE)) AS VARCHAR) AS quarter,
           CASE WHEN l_linestatus = 'O' AND quarter(CAST(l_shipdate AS DATE)) = 4 THEN '{cat}_adj' ELSE '{cat}' END
             || '_' || CAST(year(CAST(l_shipdate AS DATE)) AS VARCHAR) || '_Q'
             || CAST(quarter(CAST(l_shipdate AS DATE)) AS VARCHAR) || '.csv' AS file_name
    FROM lineitem l
    JOIN orders o ON l_orderkey = o_orderkey
    JOIN customer c ON o_custkey = c_custkey
    JOIN nation n ON c_nationkey = n_nationkey
    JOIN region r ON n_regionkey = r_regionkey
    JOIN part p ON l_partkey = p_partkey
    WHERE l_returnflag {op} 'R'
"""


def _common() -> str:
    return f"""
        CASE WHEN l_orderkey % 1000 = 7 THEN NULL ELSE 'P' || CAST(l_orderkey AS VARCHAR) END AS policy_number,
        'I' || CAST(o_custkey AS VARCHAR) AS insured_id,
        {_pick('l_linenumber % 3', BENEFITS)} AS benefit_id,
        p_type AS plan_code,
        {_pick('l_linenumber % 3', PRODUCTS)} AS product_code,
        {_pick('c_nationkey % 5', COUNTRIES)} AS resident_country"""


def views() -> dict[str, str]:
    v: dict[str, str] = {}
    v["b_premium"] = _BASE.format(cat="premium", op="<>")
    v["b_claims"] = _BASE.format(cat="claims", op="=")
    v["raw_premium0"] = f"""
    SELECT client_id, category, md5(client_id || '/' || file_name) AS file_hash, file_name, year, quarter,
        {_common()},
        CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
        strftime(CAST(date_trunc('month', ship) AS DATE), '%Y-%m-%d') AS valuation_date,
        CASE WHEN l_orderkey % 997 = 5 THEN NULL ELSE strftime(od, '%Y-%m-%d') END AS policy_effective_date,
        strftime(od, '%Y-%m-%d') AS issue_date,
        CASE WHEN o_custkey % 211 = 3 THEN '31-02-1970'
             ELSE strftime(make_date(CAST(1940 + o_custkey % 50 AS INTEGER), CAST(1 + o_custkey % 12 AS INTEGER),
                                     CAST(1 + o_custkey % 28 AS INTEGER)), '%Y-%m-%d') END AS date_of_birth,
        CASE l_orderkey % 500 WHEN 1 THEN '-1' WHEN 2 THEN '101' WHEN 3 THEN 'abc'
             ELSE CAST(year(ship) - (1940 + o_custkey % 50) AS VARCHAR) END AS age,
        CASE WHEN l_orderkey % 500 = 4
             THEN CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS VARCHAR)
             ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS sum_at_risk,
        CAST(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.5 AS DECIMAL(18,2))
             + CASE l_orderkey % 7 WHEN 0 THEN 0.01 WHEN 1 THEN 0.02 ELSE 0.00 END AS DECIMAL(18,2)) AS VARCHAR)
             AS reinsured_sum_at_risk,
        CASE WHEN l_orderkey % 500 = 9 THEN '1,000'
             ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS VARCHAR) END AS premium_amount,
        '50.00' AS ri_share_pct,
        CASE WHEN l_partkey % 101 = 0 THEN 'Unknown'
             WHEN date_trunc('month', ship) = date_trunc('month', od) THEN 'New' ELSE 'Renew' END AS new_renew,
        c_name AS insured_name,
        {_pick('l_orderkey % 4', CHANNELS)} AS distribution_channel
    FROM b_premium"""
    v["raw_premium"] = f"SELECT *, {_fp(RAW_PREMIUM)} AS _fp FROM raw_premium0"
    v["raw_claims0"] = f"""
    SELECT client_id, category, md5(client_id || '/' || file_name) AS file_hash, file_name, year, quarter,
        {_common()},
        'C' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS claim_id,
        strftime(od, '%Y-%m-%d') AS policy_effective_date,
        CASE WHEN l_orderkey % 997 = 6 THEN NULL ELSE strftime(ship, '%d-%m-%Y') END AS loss_event_date,
        strftime(CAST(ship + CAST(CAST(l_quantity AS INTEGER) - 5 AS INTEGER) AS DATE), '%Y-%m-%d') AS reported_date,
        CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) - 3000
             AS DECIMAL(18,2)) AS VARCHAR) AS claim_amount,
        CAST(year AS VARCHAR) || quarter AS reporting_period
    FROM b_claims"""
    v["raw_claims"] = f"SELECT *, {_fp(RAW_CLAIMS)} AS _fp FROM raw_claims0"

    # ---- staging: typed values + tag list (same rule order as the Spark rules)
    def d(c):
        return (f"CAST(coalesce(try_strptime(trim({c}), '%Y-%m-%d'), try_strptime(trim({c}), '%d-%m-%Y')) AS DATE)")

    def n(c, t="DECIMAL(18,2)"):
        return f"TRY_CAST(trim({c}) AS {t})"

    v["t_premium"] = f"""
    SELECT client_id, category, file_hash, file_name, year, quarter, _fp,
        policy_number, insured_id, benefit_id, plan_code, product_code, gender, ri_share_pct, new_renew,
        insured_name, distribution_channel, resident_country,
        issue_date AS r_issue, policy_effective_date AS r_eff, date_of_birth AS r_dob, valuation_date AS r_val,
        age AS r_age, sum_at_risk AS r_sar, reinsured_sum_at_risk AS r_risar, premium_amount AS r_prem,
        {d('issue_date')} AS issue_date, {d('policy_effective_date')} AS policy_effective_date,
        {d('date_of_birth')} AS date_of_birth, {d('valuation_date')} AS valuation_date,
        {n('age', 'INTEGER')} AS age, {n('sum_at_risk')} AS sum_at_risk,
        {n('reinsured_sum_at_risk')} AS reinsured_sum_at_risk, {n('premium_amount')} AS premium_amount
    FROM raw_premium"""
    tags_p = [
        ("policy_number:NULL", "policy_number IS NULL"),
        ("date_effect_policy:NULL", "r_eff IS NULL"),
        ("dob:NULL", "r_dob IS NULL"),
        ("issue_date:UNPARSABLE", "r_issue IS NOT NULL AND issue_date IS NULL"),
        ("date_effect_policy:UNPARSABLE", "r_eff IS NOT NULL AND policy_effective_date IS NULL"),
        ("dob:UNPARSABLE", "r_dob IS NOT NULL AND date_of_birth IS NULL"),
        ("val_date:UNPARSABLE", "r_val IS NOT NULL AND valuation_date IS NULL"),
        ("age:UNPARSABLE", "r_age IS NOT NULL AND age IS NULL"),
        ("sar:UNPARSABLE", "r_sar IS NOT NULL AND sum_at_risk IS NULL"),
        ("ri_sar:UNPARSABLE", "r_risar IS NOT NULL AND reinsured_sum_at_risk IS NULL"),
        ("premium_amt:UNPARSABLE", "r_prem IS NOT NULL AND premium_amount IS NULL"),
        ("age:OUT_OF_RANGE_0_100", "age < 0 OR age > 100"),
        ("sar:NOT_GREATER_THAN_PREMIUM_AMT", "sum_at_risk <= premium_amount"),
        ("ri_sar:NOT_GREATER_THAN_PREMIUM_AMT", "reinsured_sum_at_risk <= premium_amount"),
        ("issue_date:AFTER_VAL_DATE", "issue_date > valuation_date"),
        ("date_effect_policy:AFTER_VAL_DATE", "policy_effective_date > valuation_date"),
        ("dob:AFTER_VAL_DATE", "date_of_birth > valuation_date"),
        ("new_renew:INVALID_VALUE", "new_renew NOT IN ('New', 'Renew')"),
    ]
    v["s_premium"] = _tagged("t_premium", tags_p)
    v["t_claims"] = f"""
    SELECT client_id, category, file_hash, file_name, year, quarter, _fp,
        claim_id, policy_number, insured_id, benefit_id, plan_code, product_code, reporting_period, resident_country,
        loss_event_date AS r_loss, reported_date AS r_rep, policy_effective_date AS r_eff, claim_amount AS r_amt,
        {d('loss_event_date')} AS loss_event_date, {d('reported_date')} AS reported_date,
        {d('policy_effective_date')} AS policy_effective_date, {n('claim_amount')} AS claim_amount
    FROM raw_claims"""
    tags_c = [
        ("policy_num:NULL", "policy_number IS NULL"),
        ("loss_date:NULL", "r_loss IS NULL"),
        ("loss_date:UNPARSABLE", "r_loss IS NOT NULL AND loss_event_date IS NULL"),
        ("reported_date:UNPARSABLE", "r_rep IS NOT NULL AND reported_date IS NULL"),
        ("date_effect_policy:UNPARSABLE", "r_eff IS NOT NULL AND policy_effective_date IS NULL"),
        ("claim_amount:UNPARSABLE", "r_amt IS NOT NULL AND claim_amount IS NULL"),
        ("loss_date:AFTER_REPORTED_DATE", "loss_event_date > reported_date"),
    ]
    v["s_claims"] = _tagged("t_claims", tags_c)
    v["c_premium"] = "SELECT * FROM s_premium WHERE len(dq_issues) = 0"
    v["c_claims"] = "SELECT * FROM s_claims WHERE len(dq_issues) = 0"

    # ---- treaty config and rates
    k = "(length(client_id) * 7 + length(plan_code) * 3 + length(benefit_id))"
    v["treaty0"] = f"""
    SELECT DISTINCT r_name AS client_id, p_type AS plan_code, {_pick('p_size % 3', BENEFITS)} AS benefit_id,
           {_pick('p_size % 3', PRODUCTS)} AS product_id
    FROM part JOIN region ON p_partkey % 5 = r_regionkey"""
    v["treaty1"] = f"""
    SELECT 'T-' || substr(client_id, 1, 3) || '-' || benefit_id AS treaty_id, client_id, product_id, benefit_id,
        plan_code, 'A' AS segment_id,
        CAST(18 + k % 5 AS INTEGER) AS age_min, CAST(50 + k % 10 AS INTEGER) AS age_max,
        CAST(CASE WHEN k % 3 = 0 THEN NULL ELSE 150000 END AS DECIMAL(18,2)) AS retention_limit,
        CAST(CASE WHEN k % 4 <= 1 THEN 0.5 WHEN k % 4 = 2 THEN 0.4 END AS DECIMAL(18,6)) AS quota_share,
        CAST(CASE WHEN k % 4 = 3 AND k % 3 <> 0 THEN 2 END AS DECIMAL(18,6)) AS surplus_multiple,
        CAST(CASE WHEN k % 5 = 0 THEN NULL ELSE 40000 + (k % 5) * 10000 END AS DECIMAL(18,2)) AS cal_limit,
        CASE WHEN k % 2 = 0 THEN 'policy' ELSE 'life' END AS cal_level,
        make_date(CAST(1995 + k % 3 AS INTEGER), 1, 1) AS effective_date,
        CASE k % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_inforce_block,
        'quarterly' AS bdx_reporting_freq,
        CASE k % 3 WHEN 0 THEN 'Annual' WHEN 1 THEN 'QUARTERLY' ELSE 'monthly' END AS policy_renewal_freq
    FROM (SELECT *, {k} AS k FROM treaty0)
    WHERE NOT ((plan_code = 'PROMO' AND benefit_id = 'Critical_Illness') OR (client_id = 'AFRICA' AND plan_code = 'LARGE'))"""
    v["treaty"] = """
    SELECT * FROM treaty1
    UNION ALL
    SELECT treaty_id, client_id, product_id, benefit_id, plan_code, 'B', 60, 99, retention_limit, quota_share,
           surplus_multiple, cal_limit, cal_level, effective_date, is_inforce_block, bdx_reporting_freq, policy_renewal_freq
    FROM treaty1 WHERE client_id = 'ASIA' AND plan_code = 'PROMO' AND benefit_id = 'Death'"""
    v["treaty_n"] = """
    SELECT client_id, benefit_id, plan_code, count(*) AS cfg_n FROM treaty GROUP BY ALL"""
    v["rates0"] = f"""
    SELECT DISTINCT r_name AS client_id, {_pick('c_custkey % 3', BENEFITS)} AS benefit_id,
           CAST(c_custkey % 57 + 5 AS INTEGER) AS age, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS g
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
    v["rates"] = """
    SELECT client_id, 'T-' || substr(client_id, 1, 3) || '-' || benefit_id AS treaty_id, benefit_id, age,
           CASE WHEN age % 2 = 0 THEN lower(g) ELSE ' ' || g || ' ' END AS gender, 'N' AS smoker_status,
           CAST(CAST(age * 10 + length(benefit_id) + v AS DECIMAL(18,6)) * 0.001 AS DECIMAL(18,6)) AS rate,
           CASE WHEN v = 0 THEN DATE '1990-01-01' ELSE DATE '1999-01-01' END AS effective_from,
           CASE WHEN v = 0 THEN DATE '1998-12-31' END AS effective_to
    FROM rates0, (VALUES (0), (1)) t(v)"""
    return v


def _tagged(src: str, tags) -> str:
    items = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in tags)
    return f"""
    SELECT * EXCLUDE (r_list), list_filter(r_list, lambda x: x IS NOT NULL) AS dq_issues
    FROM (SELECT *, [{items}] AS r_list FROM {src})"""


def with_views(select: str, extra: str = "") -> str:
    """``WITH <all fixture views>[, extra CTEs] select`` (DuckDB only evaluates what is referenced)."""
    v = views()
    v.update(extra_views())
    v.update(gov_views())
    body = ",\n".join(f"{name} AS ({v[name]})" for name in v)
    if extra.strip():
        body += ",\n" + extra.strip().lstrip(",")
    return f"WITH {body}\n{select}"


# ------------------------------------------------------------------ validation views
_FREQ = ("CASE lower(policy_renewal_freq) WHEN 'annual' THEN 1 WHEN 'quarterly' THEN 4 "
         "WHEN 'monthly' THEN 12 ELSE 1 END")


def extra_views(as_of: bool = False) -> dict[str, str]:
    v: dict[str, str] = {}
    v["treaty_a"] = "SELECT * FROM treaty WHERE segment_id = 'A'"
    # ---------------- premium
    v["p_rows"] = """
    SELECT p.*, category = 'premium' AND row_number() OVER (
        PARTITION BY file_hash, policy_number, benefit_id, valuation_date ORDER BY _fp) > 1 AS dup_file
    FROM c_premium p"""
    v["p_j"] = """
    SELECT r.*, t.treaty_id, t.quota_share, t.surplus_multiple, t.retention_limit, t.cal_limit, t.cal_level,
        t.effective_date, t.age_min, t.age_max, t.is_inforce_block, t.policy_renewal_freq,
        coalesce(t.segment_id = 'B', false) AS is_extra,
        floor(date_diff('day', date_of_birth, valuation_date) / 365.25) AS current_age,
        t.treaty_id IS NULL AS f_treaty, dup_file AS f_dup
    FROM p_rows r LEFT JOIN treaty t USING (client_id, benefit_id, plan_code)"""
    v["p_flags"] = """
    SELECT *, date_diff('day', policy_effective_date, valuation_date) < 365 AS w_nb,
        abs(CASE WHEN quota_share IS NOT NULL AND retention_limit IS NOT NULL THEN
                   CASE WHEN sum_at_risk > retention_limit THEN (sum_at_risk - retention_limit) * quota_share
                        ELSE sum_at_risk * quota_share END
                 WHEN quota_share IS NOT NULL THEN sum_at_risk * quota_share
                 WHEN surplus_multiple IS NOT NULL THEN least(sum_at_risk - retention_limit, surplus_multiple * retention_limit)
                 ELSE reinsured_sum_at_risk END - reinsured_sum_at_risk) > 0.01 AS w_risar,
        NOT coalesce(is_inforce_block, false) AND policy_effective_date < effective_date AS w_eff,
        current_age < age_min OR current_age > age_max AS w_age
    FROM p_j"""
    for name, cond in (("p_rate", ""), ("p_rate_asof",
                       " AND j.valuation_date >= ra.effective_from AND j.valuation_date <= coalesce(ra.effective_to, DATE '9999-12-31')")):
        v[name] = f"""
    SELECT j.file_hash,
        count(*) FILTER (WHERE ra.rate IS NULL) AS n_rate_missing,
        count(*) FILTER (WHERE ra.rate IS NOT NULL AND abs(CAST(j.reinsured_sum_at_risk AS DECIMAL(16,2))
            * CAST(ra.rate AS DECIMAL(14,6)) * CAST({_FREQ.replace('policy_renewal_freq', 'j.policy_renewal_freq')} AS DECIMAL(2,0))
            - j.premium_amount * 1000) > 10) AS n_rate_fail
    FROM p_j j LEFT JOIN rates ra ON j.client_id = ra.client_id AND j.treaty_id = ra.treaty_id
        AND trim(j.benefit_id) = trim(ra.benefit_id) AND CAST(j.current_age AS INTEGER) = CAST(ra.age AS INTEGER)
        AND upper(trim(j.gender)) = upper(trim(ra.gender)){cond}
    WHERE j.category = 'premium'
    GROUP BY j.file_hash"""
    v["p_files"] = _files_sql("p_flags", """,
        count(*) FILTER (WHERE f_dup) AS n_dup, count(*) FILTER (WHERE w_nb) AS n_nb,
        count(*) FILTER (WHERE w_risar) AS n_risar, count(*) FILTER (WHERE w_eff) AS n_eff,
        count(*) FILTER (WHERE w_age) AS n_age""", "f_treaty OR f_dup")
    v["p_checks"] = _checks_sql("p_files", [
        ("TREATY_MAPPING", "FAIL", "n_treaty", None),
        ("DUPLICATE_PREMIUM", "FAIL", "n_dup", "category = 'premium'"),
        ("NEW_BUSINESS_FLAG", "ALWAYS_WARN", "n_nb", "category = 'premium'"),
        ("RISAR_VALIDATION", "WARN", "n_risar", "category = 'premium'"),
        ("EFFECTIVE_DATE", "WARN", "n_eff", "category = 'premium'"),
        ("AGE_RANGE", "WARN", "n_age", "category = 'premium'"),
    ], rate_view="p_rate")
    v["p_checks_asof"] = _checks_sql("p_files", [], rate_view="p_rate_asof")
    # ---------------- claims
    v["prem_hist"] = """
    SELECT p.client_id, t.treaty_id, p.policy_number, p.benefit_id, max(p.reinsured_sum_at_risk) AS max_risar,
           max(p.valuation_date) AS last_paid, min(p.policy_effective_date) AS first_eff
    FROM c_premium p JOIN treaty_a t USING (client_id, benefit_id, plan_code)
    WHERE p.category = 'premium'
    GROUP BY ALL"""
    v["claims_hist"] = """
    SELECT c.*, t.treaty_id FROM c_claims c LEFT JOIN treaty_a t USING (client_id, benefit_id, plan_code)
    WHERE c.category = 'claims'"""
    v["c_rows"] = """
    SELECT c.*, category = 'claims' AND row_number() OVER (
        PARTITION BY file_hash, claim_id, policy_number, benefit_id ORDER BY _fp) > 1 AS dup_file
    FROM c_claims c"""
    v["c_j"] = """
    SELECT r.*, t.treaty_id, t.cal_limit, t.cal_level, coalesce(t.segment_id = 'B', false) AS is_extra,
        EXISTS (SELECT 1 FROM claims_hist h WHERE h.client_id = r.client_id AND h.claim_id = r.claim_id
                AND h.policy_number = r.policy_number AND h.benefit_id = r.benefit_id AND h.file_hash <> r.file_hash) AS dup_hist
    FROM c_rows r LEFT JOIN treaty t USING (client_id, benefit_id, plan_code)"""
    v["c_life"] = "SELECT * FROM c_j WHERE category = 'claims' AND cal_level = 'life'"
    v["c_life_hist"] = """
    SELECT k.file_hash, k.client_id, k.insured_id, sum(h.claim_amount) AS hist
    FROM (SELECT DISTINCT file_hash, client_id, insured_id, treaty_id, benefit_id FROM c_life) k
    JOIN claims_hist h ON h.client_id = k.client_id AND h.insured_id = k.insured_id AND h.treaty_id = k.treaty_id
        AND h.benefit_id = k.benefit_id AND h.file_hash <> k.file_hash
    GROUP BY ALL"""
    v["c_breach"] = """
    SELECT l.file_hash, l.client_id, l.insured_id
    FROM (SELECT file_hash, client_id, insured_id, sum(claim_amount) AS cur, min(cal_limit) AS lim
          FROM c_life GROUP BY ALL) l
    LEFT JOIN c_life_hist h USING (file_hash, client_id, insured_id)
    WHERE l.cur + coalesce(h.hist, 0) > l.lim"""
    v["c_flags"] = """
    SELECT j.*, ph.max_risar, ph.last_paid, ph.first_eff,
        j.treaty_id IS NULL AS f_treaty,
        j.category = 'claims' AND (j.dup_file OR j.dup_hist) AS f_dup,
        j.category = 'claims' AND ph.client_id IS NULL AS f_prem,
        j.category = 'claims' AND coalesce(ph.max_risar IS NULL OR ph.max_risar < j.claim_amount, false) AS f_risar,
        j.category = 'claims' AND coalesce((j.cal_level = 'policy' AND j.claim_amount > j.cal_limit)
            OR (b.insured_id IS NOT NULL AND j.cal_level = 'life'), false) AS f_cal,
        j.claim_amount <= 0 AS w_neg,
        j.loss_event_date > ph.last_paid + 365 OR j.loss_event_date < ph.first_eff OR j.loss_event_date IS NULL AS w_dol,
        date_diff('day', ph.last_paid, j.loss_event_date) > 30 OR ph.last_paid IS NULL AS w_lapse
    FROM c_j j
    LEFT JOIN prem_hist ph ON ph.client_id = j.client_id AND ph.treaty_id = j.treaty_id
        AND ph.policy_number = j.policy_number AND ph.benefit_id = j.benefit_id
    LEFT JOIN c_breach b ON b.file_hash = j.file_hash AND b.client_id = j.client_id AND b.insured_id = j.insured_id"""
    v["c_files"] = _files_sql("c_flags", """,
        count(*) FILTER (WHERE f_dup) AS n_dup, count(*) FILTER (WHERE f_prem) AS n_prem,
        count(*) FILTER (WHERE f_risar) AS n_risar, count(*) FILTER (WHERE f_cal) AS n_cal,
        count(*) FILTER (WHERE w_neg) AS n_neg, count(*) FILTER (WHERE w_dol) AS n_dol,
        count(*) FILTER (WHERE w_lapse) AS n_lapse""", "f_treaty OR f_dup OR f_prem OR f_risar OR f_cal")
    full = "category = 'claims'"
    v["c_checks"] = _checks_sql("c_files", [
        ("TREATY_MAPPING", "FAIL", "n_treaty", None),
        ("DUPLICATE_CLAIMS", "FAIL", "n_dup", full), ("PREMIUM_EXISTS", "FAIL", "n_prem", full),
        ("RISAR_GTE_CLAIM", "FAIL", "n_risar", full), ("CAL_CHECK", "FAIL", "n_cal", full),
        ("NO_ZERO_NEGATIVE", "WARN", "n_neg", full), ("DOL_COVERAGE", "WARN", "n_dol", full),
        ("LAPSE_CHECK", "WARN", "n_lapse", full),
    ], run=RUN_ID2)
    # ---------------- statements of account
    v["soa_g"] = """
    SELECT coalesce(p.client_id, c.client_id) AS client_id, coalesce(p.year, c.year) AS year,
           coalesce(p.quarter, c.quarter) AS period,
           CAST(coalesce(p.p, 0) AS DECIMAL(18,2)) AS p, CAST(coalesce(c.c, 0) AS DECIMAL(18,2)) AS c
    FROM (SELECT client_id, year, quarter, sum(premium_amount) AS p FROM c_premium GROUP BY ALL) p
    FULL JOIN (SELECT client_id, year, quarter, sum(claim_amount) AS c FROM c_claims GROUP BY ALL) c
      ON p.client_id = c.client_id AND p.year = c.year AND p.quarter = c.quarter"""
    v["soa_v"] = """
    SELECT *, 1 AS version,
        CASE WHEN s % 12 = 6 THEN 'PENDING_APPROVAL' WHEN s % 12 = 7 THEN 'RECONCILED' ELSE 'APPROVED' END AS status,
        CASE s % 6 WHEN 2 THEN 1.00 WHEN 3 THEN 1.01 WHEN 4 THEN 5.00 ELSE 0.00 END AS bump,
        CAST(NULL AS VARCHAR) AS rejection_reason
    FROM (SELECT *, year * 4 + CAST(substr(period, 2, 1) AS INTEGER) AS s FROM soa_g)
    WHERE NOT ((year = 2001 AND period = 'Q4') OR (client_id = 'EUROPE' AND year = 1998))
    UNION ALL
    SELECT *, 2, CASE WHEN s % 6 = 4 THEN 'APPROVED' ELSE 'REJECTED' END,
        CASE WHEN s % 6 = 4 THEN 0.00 ELSE 2.00 END,
        CASE WHEN s % 6 = 5 AND s % 12 <> 11 THEN 'totals differ' END
    FROM (SELECT *, year * 4 + CAST(substr(period, 2, 1) AS INTEGER) AS s FROM soa_g)
    WHERE s % 6 IN (4, 5) AND NOT ((year = 2001 AND period = 'Q4') OR (client_id = 'EUROPE' AND year = 1998))"""
    items = _pick("(s + version) % 4", [x.replace("'", "''") for x in SOA_ITEMS])
    v["soa"] = f"""
    SELECT client_id, year, period, 'quarterly' AS period_type,
        CAST(p + bump AS DECIMAL(18,2)) AS premium_soa, CAST(c - bump AS DECIMAL(18,2)) AS claims_soa,
        CAST(CAST(p + bump AS DECIMAL(18,2)) * 0.1 AS DECIMAL(18,2)) AS commission_soa,
        CAST(CAST(p + bump AS DECIMAL(18,2)) * 0.05 AS DECIMAL(18,2)) AS tax_soa,
        {items} AS additional_items, status, version, 'clerk_' || CAST(s % 3 AS VARCHAR) AS entered_by,
        CASE WHEN status IN ('APPROVED', 'RECONCILED') THEN
             CASE WHEN s % 5 = 0 THEN 'clerk_' || CAST(s % 3 AS VARCHAR) ELSE 'manager' END END AS approved_by,
        rejection_reason
    FROM soa_v"""
    v["tracking"] = """
    SELECT DISTINCT client_id, file_hash, file_name, category, year, quarter,
        CAST(DATE '2024-01-01' + CAST(year % 2 AS INTEGER) AS TIMESTAMP) AS uploaded_at
    FROM (SELECT client_id, file_hash, file_name, category, year, quarter FROM s_premium
          UNION ALL SELECT client_id, file_hash, file_name, category, year, quarter FROM s_claims)"""
    return v


def _files_sql(src: str, extra: str, fail_expr: str) -> str:
    return f"""
    SELECT *, extra > 0 AS integrity_failed,
        CASE WHEN extra > 0 THEN joined ELSE quarantined END AS quarantined_rows,
        CASE WHEN extra > 0 THEN 1.0 WHEN total_count = 0 THEN 0.0 ELSE quarantined / total_count END AS quarantine_ratio,
        (CASE WHEN extra > 0 THEN 1.0 WHEN total_count = 0 THEN 0.0 ELSE quarantined / total_count END) >= 0.30 AS rejected
    FROM (
        SELECT client_id, file_hash, file_name, category, year, quarter,
            count(*) FILTER (WHERE NOT is_extra) AS total_count, count(*) AS joined,
            count(*) FILTER (WHERE is_extra) AS extra,
            count(*) FILTER (WHERE coalesce({fail_expr}, false)) AS quarantined,
            count(*) FILTER (WHERE f_treaty) AS n_treaty{extra}
        FROM {src} GROUP BY ALL)"""


def _checks_sql(files: str, checks, rate_view: str | None = None, run: str = RUN_ID) -> str:
    parts = []
    cols = ("'{run}' AS run_id, client_id, file_hash, file_name, category, year, quarter AS period, '{name}' AS check_name, "
            "{status} AS status, CAST({n} AS BIGINT) AS failed_count, CAST(total_count AS BIGINT) AS total_count")
    for name, kind, n, where in checks:
        status = {"FAIL": f"CASE WHEN {n} > 0 THEN 'FAIL' ELSE 'PASS' END",
                  "WARN": f"CASE WHEN {n} > 0 THEN 'WARN' ELSE 'PASS' END",
                  "ALWAYS_WARN": "'WARN'"}[kind]
        w = f" WHERE {where}" if where else ""
        parts.append(f"SELECT {cols.format(run=run, name=name, status=status, n=n)} FROM {files}{w}")
    if rate_view:
        src = f"(SELECT f.*, coalesce(r.n_rate_missing, 0) AS n_rate_missing, coalesce(r.n_rate_fail, 0) AS n_rate_fail " \
              f"FROM {files} f LEFT JOIN {rate_view} r USING (file_hash))"
        parts.append(f"SELECT {cols.format(run=RUN_ID, name='RATE_TABLE_MISSING_MATCH', status=chr(39) + 'WARN' + chr(39), n='n_rate_missing')} "
                     f"FROM {src} WHERE category = 'premium' AND n_rate_missing > 0")
        parts.append(f"SELECT {cols.format(run=RUN_ID, name='RATE_TABLE', status='CASE WHEN n_rate_fail > 0 THEN ' + chr(39) + 'WARN' + chr(39) + ' ELSE ' + chr(39) + 'PASS' + chr(39) + ' END', n='n_rate_fail')} "
                     f"FROM {src} WHERE category = 'premium'")
    if checks:
        parts.append(f"SELECT {cols.format(run=run, name='ROW_INTEGRITY_CHECK', status=chr(39) + 'FAIL' + chr(39), n='extra')} "
                     f"FROM {files} WHERE integrity_failed")
        parts.append(f"SELECT {cols.format(run=run, name='FILE_REJECTED', status=chr(39) + 'FAIL' + chr(39), n='quarantined_rows')} "
                     f"FROM {files} WHERE rejected")
    return "\n    UNION ALL\n    ".join(parts)


# ------------------------------------------------------------------ governance views
def _norm_sql(c: str) -> str:
    return f"replace(replace(replace(replace(trim(lower({c})), '/', '_'), ' ', '_'), '%', '_pct'), '-', '_')"


def gov_views() -> dict[str, str]:
    from ..operators.drift import EXPECTED_COLUMNS
    from .fixtures import FILE_NAME_KINDS, HEADER_CATEGORIES, HEADER_VOCAB

    forms = {"q": "y || '_Q' || q", "y": "y", "q5": "y || '_Q5'"}
    name = "CASE doc_id % 8 " + " ".join(
        f"WHEN {i} THEN '{p}' || {forms[f]} || '{e}'" for i, (p, f, e) in enumerate(FILE_NAME_KINDS)) + " END"
    pat = r"([a-zA-Z]+)_(\d{4})_(Q[1-4])"
    v: dict[str, str] = {}
    v["landed"] = f"""
    SELECT doc_id, file_name, CASE WHEN doc_id % 50 = 0 THEN file_name ELSE source || '/' || file_name END AS rel_path,
           md5(text) AS file_hash, CAST(DATE '2024-01-01' + CAST(doc_id % 3 AS INTEGER) AS TIMESTAMP) AS uploaded_at
    FROM (SELECT *, {name} AS file_name FROM (SELECT *, CAST(1995 + doc_id % 7 AS VARCHAR) AS y,
                                                    CAST(1 + doc_id % 4 AS VARCHAR) AS q FROM documents))"""
    v["inv"] = f"""
    SELECT *, reject_reason IS NULL AS accepted FROM (
      SELECT l.*, lower(nullif(regexp_extract(file_name, '{pat}', 1), '')) AS name_category,
        CAST(nullif(regexp_extract(file_name, '{pat}', 2), '') AS INTEGER) AS year,
        nullif(regexp_extract(file_name, '{pat}', 3), '') AS quarter,
        CASE WHEN contains(lower(file_name), 'prem') AND contains(lower(file_name), 'adj') THEN 'premium_adj'
             WHEN contains(lower(file_name), 'prem') THEN 'premium'
             WHEN contains(lower(file_name), 'claim') AND contains(lower(file_name), 'adj') THEN 'claims_adj'
             WHEN contains(lower(file_name), 'claim') THEN 'claims' ELSE 'others' END AS category,
        CASE WHEN NOT ends_with(file_name, '.csv') THEN 'NOT_CSV'
             WHEN nullif(regexp_extract(file_name, '{pat}', 2), '') IS NULL THEN 'NAME_PATTERN' END AS reject_reason,
        CASE WHEN len(string_split(rel_path, '/')) >= 2 THEN string_split(rel_path, '/')[-2] ELSE 'UNKNOWN_CLIENT' END AS client_id
      FROM landed l)"""
    v["trk"] = "SELECT * FROM inv WHERE accepted"
    v["fstatus"] = """
    SELECT t.*, CASE WHEN h.nc > 1 THEN 'CROSS_CLIENT_DUP' WHEN h.nf > 1 THEN 'DUPLICATE'
                     WHEN t.category = 'others' THEN 'UNKNOWN_CATEGORY' ELSE 'SUCCESS' END AS status,
        CAST(CASE WHEN h.nc > 1 THEN h.nc WHEN h.nf > 1 THEN h.nf ELSE 1 END AS BIGINT) AS duplicate_count
    FROM trk t JOIN (SELECT file_hash, count(*) AS nf, count(DISTINCT client_id) AS nc FROM trk GROUP BY 1) h USING (file_hash)"""
    v["ilog"] = """
    SELECT event_id, 'U' || CAST(user_id AS VARCHAR) AS client_id,
        md5('U' || CAST(user_id AS VARCHAR) || '/' || strftime(date_trunc('week', ts), '%Y-%m-%d')) AS file_hash,
        CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESS' WHEN 'signup' THEN 'DUPLICATE'
             ELSE 'RETRYING' END AS status
    FROM events"""
    v["skipset"] = """
    SELECT client_id, file_hash FROM ilog WHERE status IN ('SUCCESS', 'DUPLICATE', 'CROSS_CLIENT_DUP', 'UNKNOWN_CATEGORY')
    UNION
    SELECT client_id, file_hash FROM ilog WHERE status = 'FAILED' GROUP BY ALL HAVING count(*) >= 3"""
    v["sruns"] = """
    SELECT e.event_id, f.file_hash, strftime(e.ts, '%Y%m%d_%H%M%S') || 'Z' AS run_id,
        CASE e.event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESS' END AS status
    FROM events e JOIN landed f ON e.user_id = f.doc_id
    WHERE e.event_type IN ('error', 'purchase')"""
    v["hdr"] = f"""
    SELECT 'client_' || CAST(user_id % 7 AS VARCHAR) AS client_id, md5('hdr/' || CAST(user_id AS VARCHAR)) AS file_hash,
        cat || '_2024_Q' || CAST(user_id % 4 + 1 AS VARCHAR) || '_u' || CAST(user_id AS VARCHAR) || '.csv' AS file_name,
        cat AS category,
        CASE event_type WHEN 'view' THEN upper(nm) WHEN 'click' THEN ' ' || nm || ' '
             WHEN 'signup' THEN replace(nm, '_', ' ') WHEN 'error' THEN nm || '%' ELSE nm END AS raw_col_name
    FROM (SELECT *, {_pick('user_id % 4', HEADER_CATEGORIES)} AS cat,
                 {_pick("CAST(json_extract_string(props, '$.k') AS INTEGER) % 20", HEADER_VOCAB)} AS nm FROM events)"""
    v["hdr_n"] = f"SELECT DISTINCT client_id, file_hash, file_name, category, {_norm_sql('raw_col_name')} AS column_name FROM hdr"
    exp_rows = ", ".join(f"('{c}', '{col}')" for c, cols in EXPECTED_COLUMNS.items() for col in cols)
    v["expcols"] = f"SELECT * FROM (VALUES {exp_rows}) t(category, column_name)"
    v["cmap"] = """
    SELECT client_id, category, raw_col_name, raw_col_name AS canonical_name, 1 AS mapping_version,
        CASE WHEN (length(raw_col_name) + length(client_id)) % 5 = 0 THEN DATE '2023-12-31' END AS effective_to
    FROM (SELECT DISTINCT client_id, category, column_name AS raw_col_name FROM hdr_n)"""
    v["unm"] = """
    SELECT h.* FROM hdr_n h WHERE NOT EXISTS (SELECT 1 FROM cmap m WHERE m.effective_to IS NULL
        AND m.client_id = h.client_id AND m.category = h.category AND m.raw_col_name = h.column_name)"""
    v["rq_items"] = "SELECT client_id, category, column_name AS raw_col_name, min(file_name) AS file_name FROM unm GROUP BY ALL"
    v["rq_old"] = """
    SELECT *, CASE WHEN length(raw_col_name) % 3 = 0 THEN 'PENDING' WHEN length(raw_col_name) % 3 = 1 THEN 'REJECTED'
                   WHEN length(client_id) % 2 = 0 THEN 'AFFECTS_CALCULATIONS' ELSE 'APPROVED' END AS status,
        false AS de_resolved
    FROM rq_items"""
    v["rq_new"] = """
    SELECT i.*, 'PENDING' AS status FROM rq_items i WHERE NOT EXISTS (SELECT 1 FROM rq_old o
        WHERE o.status IN ('PENDING', 'AFFECTS_CALCULATIONS') AND o.client_id = i.client_id AND o.category = i.category
          AND o.raw_col_name = i.raw_col_name)"""
    v["rq_all"] = "SELECT * FROM rq_old UNION ALL SELECT *, false FROM rq_new"
    return v
