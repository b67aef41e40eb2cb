"""Fixture views: the driver's TPC-H-like tables re-read as bordereau data.

Every view is derived from the given tables only, so its size grows with the
scale factor.  Raw bordereau columns are *strings* (as a CSV bronze table
would hold them) so that staging really parses them.  ``oracle.py`` holds the
same views in DuckDB SQL; the two files must change together.

File = (client = region name, category, year, quarter of the ship date).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MONEY
from ..operators.joins import bounded_broadcast
from ..sources.tables import ensure_parallelism

RAW_PREMIUM = ("policy_number", "insured_id", "benefit_id", "plan_code", "product_code", "gender",
               "valuation_date", "policy_effective_date", "issue_date", "date_of_birth", "age", "sum_at_risk",
               "reinsured_sum_at_risk", "premium_amount", "ri_share_pct", "new_renew", "insured_name",
               "distribution_channel", "resident_country")
RAW_CLAIMS = ("claim_id", "policy_number", "insured_id", "benefit_id", "plan_code", "product_code",
              "policy_effective_date", "loss_event_date", "reported_date", "claim_amount", "reporting_period",
              "resident_country")
FILE_COLS = ("client_id", "category", "file_hash", "file_name", "year", "quarter")

# Fixed values (fixture vocabulary, from the reference's generators).
BENEFITS = ("Death", "Critical_Illness", "Terminal_Illness")
PRODUCTS = ("LIFE", "CI", "TERM")
CHANNELS = ("Agency", "Broker", "Direct", "Bancassurance")
COUNTRIES = ("UK", "US", "IN", "SG", "AU")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file-source stream of all its files: a table is one file or, once it is larger, a folder of files."""
    from ..sources.tables import _hadoop

    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    fs, p = _hadoop(spark, path)
    r = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if fs.getFileStatus(p).isDirectory():
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir.rstrip("/"))    # a stream reads no single file


def _pick(idx: Column, values) -> Column:
    """values[idx] as a compact array lookup (NULL when idx is NULL)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _iso(d: Column) -> Column:
    """``yyyy-MM-dd`` of a date: what its cast gives, without the formatter."""
    return _s(d)


def _dmy(d: Column) -> Column:
    """``dd-MM-yyyy`` of a date."""
    iso = _iso(d)
    plain = F.concat(F.substring(iso, 9, 2), F.substring(iso, 5, 4), F.substring(iso, 1, 4))
    return F.when(F.length(iso) == 10, plain).otherwise(F.date_format(d, "dd-MM-yyyy"))


def _s(c: Column) -> Column:
    return c.cast("string")


def _base(spark: SparkSession, sf_dir: str, claims: bool) -> DataFrame:
    """lineitem ⋈ part ⋈ (orders ⋈ customer ⋈ (nation ⋈ region)), one side of the return flag.

    Orders meet their customers first, while they are a fraction of the lines, and the lines meet the narrow parts
    first: where nothing can be broadcast, the lines are shuffled twice instead of three times.  ``_row_id`` is assigned right at the lineitem scan (deterministic per file
    split), before any shuffle, so every branch of a plan sees the same ids.
    """
    flag = F.col("l_returnflag") == "R"
    li = (table(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                  "l_returnflag", "l_linestatus", "l_shipdate")
          .filter(flag if claims else ~flag)
          .withColumn("_row_id", F.monotonically_increasing_id()))
    li = ensure_parallelism(li)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    # nation ⋈ region has one row per nation; broadcast after the usual size check
    nr = bounded_broadcast(table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"),
                                                               F.col("n_regionkey") == F.col("r_regionkey"))
                           .select("n_nationkey", "r_name"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    oc = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(nr, F.col("c_nationkey") == F.col("n_nationkey"))
    b = li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    ship = F.to_date("l_shipdate")
    cat = "claims" if claims else "premium"
    # open lines shipped in a fourth quarter arrive as adjustment files (late data, *_adj)
    category = F.when((F.col("l_linestatus") == "O") & (F.quarter(ship) == 4), F.lit(f"{cat}_adj")).otherwise(F.lit(cat))
    year = F.year(ship)
    quarter = F.concat(F.lit("Q"), _s(F.quarter(ship)))
    fname = F.concat(category, F.lit("_"), _s(year), F.lit("_"), quarter, F.lit(".csv"))
    return b.select(
        "*", ship.alias("_ship"), F.to_date("o_orderdate").alias("_od"),
        F.col("r_name").alias("client_id"), category.alias("category"), year.alias("year"), quarter.alias("quarter"),
        fname.alias("file_name"),
        F.md5(F.concat(F.col("r_name"), F.lit("/"), fname)).alias("file_hash"))


def _common(b: DataFrame) -> dict[str, Column]:
    li3 = F.col("l_linenumber") % 3
    return {
        "policy_number": F.when(F.col("l_orderkey") % 1000 == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("P"), _s(F.col("l_orderkey")))),
        "insured_id": F.concat(F.lit("I"), _s(F.col("o_custkey"))),
        "benefit_id": _pick(li3, BENEFITS),
        "plan_code": F.col("p_type"),
        "product_code": _pick(li3, PRODUCTS),
        "resident_country": _pick(F.col("c_nationkey") % 5, COUNTRIES),
    }


def _fingerprint(cols) -> Column:
    return F.md5(F.concat_ws("|", F.col("file_hash"), *[F.col(c) for c in cols]))


def premium_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw premium bordereau rows (all strings) + file columns, ``_row_id``, ``_fp``."""
    b = _base(spark, sf_dir, claims=False)
    m = _common(b)
    ok, ship, od = F.col("l_orderkey"), F.col("_ship"), F.col("_od")
    birth_year = F.lit(1940) + F.col("o_custkey") % 50
    dob = F.make_date(birth_year.cast("int"), (F.lit(1) + F.col("o_custkey") % 12).cast("int"),
                      (F.lit(1) + F.col("o_custkey") % 28).cast("int"))
    sar = F.col("o_totalprice").cast(MONEY)
    prem = (F.col("l_extendedprice").cast(MONEY) * F.lit(Decimal("0.01"))).cast(MONEY)
    bump = F.when(ok % 7 == 0, F.lit(Decimal("0.01"))).when(ok % 7 == 1, F.lit(Decimal("0.02"))).otherwise(F.lit(Decimal("0.00")))
    risar = ((sar * F.lit(Decimal("0.5"))).cast(MONEY) + bump).cast(MONEY)
    m.update({
        "gender": F.when(F.col("o_custkey") % 2 == 0, "M").otherwise("F"),
        "valuation_date": _iso(F.trunc(ship, "MM")),
        "policy_effective_date": F.when(ok % 997 == 5, F.lit(None).cast("string")).otherwise(_iso(od)),
        "issue_date": _iso(od),
        "date_of_birth": F.when(F.col("o_custkey") % 211 == 3, F.lit("31-02-1970")).otherwise(_iso(dob)),
        "age": F.when(ok % 500 == 1, F.lit("-1")).when(ok % 500 == 2, F.lit("101")).when(ok % 500 == 3, F.lit("abc"))
        .otherwise(_s(F.year(ship) - birth_year)),
        "sum_at_risk": F.when(ok % 500 == 4, _s(prem)).otherwise(_s(sar)),
        "reinsured_sum_at_risk": _s(risar),
        "premium_amount": F.when(ok % 500 == 9, F.lit("1,000")).otherwise(_s(prem)),
        "ri_share_pct": F.lit("50.00"),
        "new_renew": F.when(F.col("l_partkey") % 101 == 0, F.lit("Unknown"))
        .when(F.trunc(ship, "MM") == F.trunc(od, "MM"), F.lit("New")).otherwise(F.lit("Renew")),
        "insured_name": F.col("c_name"),
        "distribution_channel": _pick(F.col("o_orderkey") % 4, CHANNELS),
    })
    out = b.select(*FILE_COLS, "_row_id", *[m[c].alias(c) for c in RAW_PREMIUM])
    return out.withColumn("_fp", _fingerprint(RAW_PREMIUM))


def claims_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw claims bordereau rows (all strings; loss dates written dd-MM-yyyy)."""
    b = _base(spark, sf_dir, claims=True)
    m = _common(b)
    ok, ship = F.col("l_orderkey"), F.col("_ship")
    amount = (F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
              - F.lit(3000)).cast(MONEY)
    m.update({
        "claim_id": F.concat(F.lit("C"), _s(ok), F.lit("-"), _s(F.col("l_linenumber"))),
        "policy_effective_date": _iso(F.col("_od")),
        "loss_event_date": F.when(ok % 997 == 6, F.lit(None).cast("string")).otherwise(_dmy(ship)),
        "reported_date": _iso(F.date_add(ship, (F.col("l_quantity").cast("int") - 5))),
        "claim_amount": _s(amount),
        "reporting_period": F.concat(_s(F.col("year")), F.col("quarter")),
    })
    out = b.select(*FILE_COLS, "_row_id", *[m[c].alias(c) for c in RAW_CLAIMS])
    return out.withColumn("_fp", _fingerprint(RAW_CLAIMS))


def treaty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Treaty benefit config: one row per (client, plan, benefit) seen in part ⋈ region, except the
    combinations no treaty covers (PROMO plans for Critical_Illness; LARGE plans in AFRICA), and one
    combination doubled (fan-out)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    base = (p.join(r, (F.col("p_partkey") % 5) == F.col("r_regionkey"))
            .select(F.col("r_name").alias("client_id"), F.col("p_type").alias("plan_code"),
                    _pick(F.col("p_size") % 3, BENEFITS).alias("benefit_id"),
                    _pick(F.col("p_size") % 3, PRODUCTS).alias("product_id"))
            .distinct())
    k = F.length("client_id") * 7 + F.length("plan_code") * 3 + F.length("benefit_id")
    uncovered = (((F.col("plan_code") == "PROMO") & (F.col("benefit_id") == "Critical_Illness"))
                 | ((F.col("client_id") == "AFRICA") & (F.col("plan_code") == "LARGE")))
    base = base.withColumn("_k", k).filter(~uncovered)
    kk = F.col("_k")
    cfg = base.select(
        F.concat(F.lit("T-"), F.substring("client_id", 1, 3), F.lit("-"), F.col("benefit_id")).alias("treaty_id"),
        "client_id", "product_id", "benefit_id", "plan_code", F.lit("A").alias("segment_id"),
        (F.lit(18) + kk % 5).cast("int").alias("age_min"), (F.lit(50) + kk % 10).cast("int").alias("age_max"),
        F.when(kk % 3 == 0, F.lit(None)).otherwise(F.lit(150000)).cast(MONEY).alias("retention_limit"),
        F.when(kk % 4 <= 1, F.lit(Decimal("0.5"))).when(kk % 4 == 2, F.lit(Decimal("0.4"))).cast("decimal(18,6)").alias("quota_share"),
        F.when((kk % 4 == 3) & (kk % 3 != 0), F.lit(2)).cast("decimal(18,6)").alias("surplus_multiple"),
        F.when(kk % 5 == 0, F.lit(None)).otherwise(F.lit(40000) + (kk % 5) * 10000).cast(MONEY).alias("cal_limit"),
        F.when(kk % 2 == 0, F.lit("policy")).otherwise(F.lit("life")).alias("cal_level"),
        F.make_date((F.lit(1995) + kk % 3).cast("int"), F.lit(1), F.lit(1)).alias("effective_date"),
        F.when(kk % 3 == 0, F.lit(True)).when(kk % 3 == 1, F.lit(False)).alias("is_inforce_block"),
        F.lit("quarterly").alias("bdx_reporting_freq"),
        F.when(kk % 3 == 0, F.lit("Annual")).when(kk % 3 == 1, F.lit("QUARTERLY")).otherwise(F.lit("monthly")).alias("policy_renewal_freq"))
    doubled = (cfg.filter((F.col("client_id") == "ASIA") & (F.col("plan_code") == "PROMO") & (F.col("benefit_id") == "Death"))
               .withColumn("segment_id", F.lit("B")).withColumn("age_min", F.lit(60)).withColumn("age_max", F.lit(99)))
    return cfg.unionByName(doubled)


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate table: (client, treaty, benefit, age, gender) seen in customer ⋈ nation ⋈ region,
    two effective-dated versions each; gender spelled untidily on purpose."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nr = bounded_broadcast(table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"),
                                                               F.col("n_regionkey") == F.col("r_regionkey"))
                           .select("n_nationkey", "r_name"))
    keys = (c.join(nr, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("r_name").alias("client_id"), _pick(F.col("c_custkey") % 3, BENEFITS).alias("benefit_id"),
                    (F.col("c_custkey") % 57 + 5).cast("int").alias("age"),
                    F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("_g"))
            .distinct())
    base = keys.select(
        F.concat(F.lit("T-"), F.substring("client_id", 1, 3), F.lit("-"), F.col("benefit_id")).alias("treaty_id"),
        "client_id", "benefit_id", "age",
        F.when(F.col("age") % 2 == 0, F.lower("_g")).otherwise(F.concat(F.lit(" "), F.col("_g"), F.lit(" "))).alias("gender"),
        F.lit("N").alias("smoker_status"),
        (F.col("age") * 10 + F.length("benefit_id")).alias("_units"))
    old = base.select("*", F.lit(0).alias("_v"), F.lit("1990-01-01").cast("date").alias("effective_from"),
                      F.lit("1998-12-31").cast("date").alias("effective_to"))
    new = base.select("*", F.lit(1).alias("_v"), F.lit("1999-01-01").cast("date").alias("effective_from"),
                      F.lit(None).cast("date").alias("effective_to"))
    both = old.unionByName(new)
    rate = ((F.col("_units") + F.col("_v")).cast("decimal(18,6)") * F.lit(Decimal("0.001"))).cast("decimal(18,6)")
    return both.select("client_id", "treaty_id", "benefit_id", "age", "gender", "smoker_status", rate.alias("rate"),
                       "effective_from", "effective_to")


# Fixed fixture values for SOA additional items, chosen by (s + version) % 4.
SOA_ITEMS = (
    "[]",
    '[{"label":"profit commission","amount":12.50,"direction":"credit"}]',
    '[{"label":"levy","amount":3.25,"direction":"debit"},{"label":"fee","amount":1.00,"direction":"Credit"}]',
    '[{"label":"","amount":2.00,"direction":"sideways"},{"label":"refund","amount":-4.00,"direction":"debit"}]',
)


def soa_entries(premium_clean: DataFrame, claims_clean: DataFrame) -> DataFrame:
    """Statements of account per (client, year, quarter) from the staged totals.

    No statement yet for the last quarter of the data (2001 Q4) nor for EUROPE in 1998.
    Otherwise, with s = year * 4 + quarter: s % 12 = 6 pending; 7 already reconciled;
    s % 6 = 2 off by 1.00 (inside tolerance), 3 off by 1.01 (break), 4 two
    approved versions (the later one exact), 5 approved then a rejected version.
    """
    keys = ["client_id", "year", "quarter"]
    p = premium_clean.groupBy(*keys).agg(F.sum("premium_amount").alias("_p"))
    c = claims_clean.groupBy(*keys).agg(F.sum("claim_amount").alias("_c"))
    g = (p.join(c, keys, "full")
         .select(F.col("client_id"), F.col("year"), F.col("quarter").alias("period"),
                 F.coalesce("_p", F.lit(0)).cast(MONEY).alias("_p"), F.coalesce("_c", F.lit(0)).cast(MONEY).alias("_c")))
    s = F.col("year") * 4 + F.substring("period", 2, 1).cast("int")
    g = g.withColumn("_s", s)
    s12, s6 = F.col("_s") % 12, F.col("_s") % 6

    def money(x):
        return F.lit(Decimal(x))

    no_soa = (((F.col("year") == 2001) & (F.col("period") == "Q4"))
              | ((F.col("client_id") == "EUROPE") & (F.col("year") == 1998)))
    v1 = g.filter(~no_soa).select(
        "*", F.lit(1).alias("version"),
        F.when(s12 == 6, "PENDING_APPROVAL").when(s12 == 7, "RECONCILED").otherwise("APPROVED").alias("status"),
        F.when(s6 == 2, money("1.00")).when(s6 == 3, money("1.01")).when(s6 == 4, money("5.00"))
        .otherwise(money("0.00")).alias("_bump"),
        F.lit(None).cast("string").alias("rejection_reason"))
    v2 = g.filter(~no_soa & s6.isin(4, 5)).select(
        "*", F.lit(2).alias("version"),
        F.when(s6 == 4, "APPROVED").otherwise("REJECTED").alias("status"),
        F.when(s6 == 4, money("0.00")).otherwise(money("2.00")).alias("_bump"),
        F.when((s6 == 5) & (s12 != 11), F.lit("totals differ")).alias("rejection_reason"))
    e = v1.unionByName(v2)
    prem = (F.col("_p") + F.col("_bump")).cast(MONEY)
    entered = F.concat(F.lit("clerk_"), (F.col("_s") % 3).cast("string"))
    return e.select(
        "client_id", "year", "period", F.lit("quarterly").alias("period_type"),
        prem.alias("premium_soa"), (F.col("_c") - F.col("_bump")).cast(MONEY).alias("claims_soa"),
        (prem * F.lit(Decimal("0.1"))).cast(MONEY).alias("commission_soa"),
        (prem * F.lit(Decimal("0.05"))).cast(MONEY).alias("tax_soa"),
        _pick((F.col("_s") + F.col("version")) % 4, SOA_ITEMS).alias("additional_items"),
        "status", "version", entered.alias("entered_by"),
        F.when(F.col("status").isin("APPROVED", "RECONCILED"),
               F.when(F.col("_s") % 5 == 0, entered).otherwise(F.lit("manager"))).alias("approved_by"),
        "rejection_reason")


def tracking_from_files(files: DataFrame) -> DataFrame:
    """File-tracking rows of staged bordereau files; even years uploaded on 2024-01-01, odd on the 2nd."""
    return (files.select("client_id", "file_hash", "file_name", "category", "year", "quarter").distinct()
            .withColumn("uploaded_at", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("year") % 2).cast("int")).cast("timestamp")))


# ------------------------------------------------------------------ governance fixtures
# Fixed fixture values: landed file-name shapes by doc_id % 8 (prefix, period form, extension).
FILE_NAME_KINDS = (
    ("premium_", "q", ".csv"), ("PREM_ADJ_", "q", ".csv"), ("premium_adj_", "q", ".csv"), ("claims_", "q", ".csv"),
    ("claims_adj_", "q", ".csv"), ("notes_", "q", ".csv"), ("claims_", "y", ".csv"), ("claims_", "q5", ".txt"),
)
# Header vocabulary by slot (k % 20 of the event's props).
HEADER_VOCAB = (
    "policy_number", "benefit_id", "valuation_date", "policy_effective_date", "plan_code", "insured_id", "gender",
    "age", "premium_amount", "sum_at_risk", "reinsured_sum_at_risk", "issue_date", "date_of_birth", "new_renew",
    "product_code", "distribution_channel", "resident_country", "claim_id", "claim_amount", "loss_event_date",
)
HEADER_CATEGORIES = ("premium", "claims", "premium_adj", "others")


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as landed files: client folder = source (root for doc_id % 50 = 0), hash = md5(text)."""
    return landed_files_from(table(spark, sf_dir, "documents"))


def landed_files_from(documents: DataFrame) -> DataFrame:
    doc = documents.select("doc_id", "text", "source")
    y = _s(F.lit(1995) + F.col("doc_id") % 7)
    q = _s(F.lit(1) + F.col("doc_id") % 4)
    forms = {"q": F.concat(y, F.lit("_Q"), q), "y": y, "q5": F.concat(y, F.lit("_Q5"))}
    name = None
    for i, (prefix, form, ext) in enumerate(FILE_NAME_KINDS):
        v = F.concat(F.lit(prefix), forms[form], F.lit(ext))
        name = F.when(F.col("doc_id") % 8 == i, v) if name is None else name.when(F.col("doc_id") % 8 == i, v)
    return doc.select(
        "doc_id", name.alias("file_name"),
        F.when(F.col("doc_id") % 50 == 0, name).otherwise(F.concat(F.col("source"), F.lit("/"), name)).alias("rel_path"),
        F.md5(F.col("text")).alias("file_hash"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 3).cast("int")).cast("timestamp").alias("uploaded_at"))


def ingestion_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a bronze ingestion log: file = (user, week); error -> FAILED, purchase -> SUCCESS, signup -> DUPLICATE."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    client = F.concat(F.lit("U"), _s(F.col("user_id")))
    week = F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd")
    status = (F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "SUCCESS")
              .when(F.col("event_type") == "signup", "DUPLICATE").otherwise("RETRYING"))
    return e.select("event_id", client.alias("client_id"), F.md5(F.concat(client, F.lit("/"), week)).alias("file_hash"),
                    F.concat(F.lit("bdx_"), week, F.lit(".csv")).alias("file_name"), status.alias("status"))


def staging_runs(spark: SparkSession, sf_dir: str, files: DataFrame) -> DataFrame:
    """events as staging runs of landed files (event user_id = doc_id): error -> FAILED, purchase -> SUCCESS."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    st = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "SUCCESS")
    j = e.join(files.select("doc_id", "file_hash"), F.col("user_id") == F.col("doc_id"))
    return (j.select("event_id", "file_hash", F.concat(F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("Z")).alias("run_id"),
                     st.alias("status")).filter(F.col("status").isNotNull()))


def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as file headers: one file per user, one raw column per event, spelled by event type."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    slot = F.get_json_object("props", "$.k").cast("int") % 20
    e = e.select("user_id", "event_type", _pick(slot, HEADER_VOCAB).alias("_name"))
    name = F.col("_name")
    et = F.col("event_type")
    raw = (F.when(et == "view", F.upper(name)).when(et == "click", F.concat(F.lit(" "), name, F.lit(" ")))
           .when(et == "signup", F.replace(name, F.lit("_"), F.lit(" "))).when(et == "error", F.concat(name, F.lit("%")))
           .otherwise(name))
    cat = _pick(F.col("user_id") % 4, HEADER_CATEGORIES)
    return e.select(
        F.concat(F.lit("client_"), _s(F.col("user_id") % 7)).alias("client_id"),
        F.md5(F.concat(F.lit("hdr/"), _s(F.col("user_id")))).alias("file_hash"),
        F.concat(cat, F.lit("_2024_Q"), _s(F.col("user_id") % 4 + 1), F.lit("_u"), _s(F.col("user_id")), F.lit(".csv")).alias("file_name"),
        cat.alias("category"), raw.alias("raw_col_name"))


def column_mapping(headers: DataFrame) -> DataFrame:
    """Mapping version 1 of every header column seen; some already expired (effective_to set)."""
    from ..functions.columns import normalize_name_col
    h = headers.select("client_id", "category", normalize_name_col("raw_col_name").alias("raw_col_name")).distinct()
    expired = (F.length("raw_col_name") + F.length("client_id")) % 5 == 0
    return h.select("client_id", "category", "raw_col_name", F.col("raw_col_name").alias("canonical_name"),
                    F.lit(1).alias("mapping_version"), F.lit(False).alias("is_pii"),
                    F.when(expired, F.lit("2023-12-31").cast("date")).alias("effective_to"))


def review_queue(unmapped: DataFrame) -> DataFrame:
    """Existing review items of the unmapped columns: PENDING, REJECTED, AFFECTS_CALCULATIONS or APPROVED."""
    items = (unmapped.groupBy("client_id", "category", F.col("column_name").alias("raw_col_name"))
             .agg(F.min("file_name").alias("file_name")))
    n = F.length("raw_col_name") % 3
    st = (F.when(n == 0, "PENDING").when(n == 1, "REJECTED")
          .when(F.length("client_id") % 2 == 0, "AFFECTS_CALCULATIONS").otherwise("APPROVED"))
    return items.withColumn("status", st).withColumn("de_resolved", F.lit(False))


def customer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as a bronze file of three clients with untidy raw headers."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("client_"), _s(F.col("c_nationkey") % 3)).alias("client_id"),
        _s(F.col("c_custkey")).alias("Customer Key"), F.col("c_name").alias("Name"),
        _s(F.col("c_nationkey")).alias("Nation-Key"), _s(F.col("c_acctbal").cast(MONEY)).alias("Acct Bal%"),
        F.col("c_mktsegment").alias("MKT/Segment"),
        F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("X"), _s(F.col("c_custkey")))).alias("insured_id"))


# Fixed fixture values: per-client column mapping of the customer file
# (client, raw name, canonical name, is_pii, effective_to).
CUSTOMER_MAPPING = (
    ("client_0", "Customer Key", "insured_id", False, None),
    ("client_0", "Name", "insured_name", True, None),
    ("client_0", "MKT/Segment", "segment", False, None),
    ("client_0", "Acct Bal%", "balance", False, None),
    ("client_1", "Customer Key", "insured_id", False, None),
    ("client_1", "Name", "insured_name", True, None),
    ("client_1", "Nation-Key", "nation", False, "2023-12-31"),
    ("client_1", "Nation-Key", "country_code", False, None),
    ("client_2", "Name", "insured_name", False, None),
    ("client_2", "Customer Key", "insured_id", False, None),
    ("client_2", "MKT/Segment", "segment", False, None),
)


def customer_mapping(spark: SparkSession) -> DataFrame:
    return (spark.createDataFrame(list(CUSTOMER_MAPPING),
                                  "client_id string, raw_col_name string, canonical_name string, is_pii boolean, effective_to string")
            .withColumn("effective_to", F.col("effective_to").cast("date")))


def land_csv(spark: SparkSession, frames: list[tuple[DataFrame, tuple[str, ...]]], root: str) -> None:
    """Raw rows as CSV files ``root/<client>/<file name>``, the way clients land them (input of the landing scan)."""
    from urllib.parse import unquote

    from ..sources.tables import _hadoop, folders, remove_folder

    path = spark._jvm.org.apache.hadoop.fs.Path
    for k, (df, cols) in enumerate(frames):
        parts = f"{root}_parts{k}"
        (df.select("client_id", "file_name", *cols).repartition("client_id", "file_name")
         .write.option("header", True).partitionBy("client_id", "file_name").csv(parts))
        fs, _ = _hadoop(spark, parts)
        for client in (f for f in folders(spark, parts) if "=" in f):
            target = f"{root}/{unquote(client.split('=', 1)[1])}"
            fs.mkdirs(path(target))
            for name in folders(spark, f"{parts}/{client}"):
                for part in folders(spark, f"{parts}/{client}/{name}"):
                    fs.rename(path(f"{parts}/{client}/{name}/{part}"), path(f"{target}/{unquote(name.split('=', 1)[1])}"))
        remove_folder(spark, parts)


def file_events(events: DataFrame) -> DataFrame:
    """Rows of the events table (or a stream of them) as file events: file = (user, week); signup and click -> LANDED,
    error -> FAILED, view -> BLOCKED, purchase -> SUCCESS."""
    client = F.concat(F.lit("U"), _s(F.col("user_id")))
    week = F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd")
    event = (F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "view", "BLOCKED")
             .when(F.col("event_type") == "purchase", "SUCCESS").otherwise("LANDED"))
    return events.select(F.md5(F.concat(client, F.lit("/"), week)).alias("file_hash"), client.alias("client_id"),
                         F.concat(F.lit("bdx_"), week, F.lit(".csv")).alias("file_name"), event.alias("event"), F.col("ts").cast("timestamp").alias("at"))


def mapping_decisions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """events as mapping decisions (all but views) and file uploads (views) of seven clients."""
    e = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("C"), _s(F.col("user_id") % 7)).alias("client_id"),
        F.when(F.col("user_id") % 2 == 0, "premium").otherwise("claims").alias("category"))
    action = (F.when(F.col("event_type") == "purchase", "approve").when(F.col("event_type") == "signup", "affects_calculations")
              .when(F.col("event_type") == "error", "reject").otherwise("retire"))
    log = e.where("event_type <> 'view'").select(
        "client_id", "category", F.concat(F.lit("col_"), _s(F.col("event_id") % 40)).alias("raw_col_name"),
        F.concat(F.lit("canon_"), _s(F.col("event_id") % 13)).alias("canonical_name"), F.lit(False).alias("is_pii"), action.alias("action"), F.col("ts").alias("decided_at"))
    files = e.where("event_type = 'view'").select(F.md5(F.concat(F.lit("file"), _s(F.col("event_id")))).alias("file_hash"), "client_id", "category",
                                                  F.col("ts").alias("uploaded_at"))
    return log, files
