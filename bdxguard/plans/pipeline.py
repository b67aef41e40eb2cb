"""End-to-end batch: landing files -> bronze -> silver staging -> validated -> recon -> gold.

The reference runs this as a chain of scheduled scripts that loop over files.
Here each stage is one set-based Spark step over all files of the run, and the
stage boundaries are tables under ``warehouse``:

  audit/file_tracking, audit/ingestion_log, audit/schema_drift, audit/staging_log,
  audit/quarantine_summary, audit/validation_results, audit/recon_results,
  bronze (partitioned by run, category), silver/staging (by run, category, clean flag),
  silver/validated/<category>, gold/<category>   (partitioned by year, period)
  silver/period_totals/<category> (by year, period), silver/premium_values (by key bucket): kept by the changes of
  each promotion, so reconciliation and claims checks do not read the validated history;
  silver/key_maps/<category> (by year, period): bitmaps that tell which periods a duplicate check has to read

Premium is validated and promoted before claims, because the claims checks
read the validated premium (O7).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import canonical as cn
from ..operators import deltas as dl
from ..operators import drift as dr
from ..operators import ingest as ig
from ..operators import pruning as pr
from ..operators import recon as rc
from ..operators import staging as st
from ..operators import upsert as up
from ..operators import validation as va
from ..sources import files as sf
from ..sources import tables as tb

PREMIUM_LIKE = ("premium", "premium_adj")
CLAIMS_LIKE = ("claims", "claims_adj")
REQUIRED = {
    "premium": ("policy_number", "benefit_id", "plan_code", "valuation_date", "premium_amount", "_fp", "_row_id"),
    "claims": ("claim_id", "policy_number", "benefit_id", "plan_code", "claim_amount", "insured_id", "_fp", "_row_id"),
}


@dataclass
class Metadata:
    mapping: DataFrame            # column_mapping: client_id, category, raw_col_name, canonical_name, is_pii, effective_to; with
                                  # effective_from too, each file is read by the rows valid when it was first seen
    treaty: DataFrame             # treaty_benefit_config
    rates: DataFrame | None       # rate_tables
    soa: DataFrame                # soa_entries


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    return tb.try_read(spark, path)


#: Bronze has one schema for all files: their own columns are entries of ``data``, so new headers never change it.
BRONZE = ("path string, file_hash string, file_name string, client_id string, year int, quarter string, data map<string, string>, _row_id long, "
          "_fp string, source_path string, ingestion_time timestamp, run_id string, category string")


INDEX_BUCKETS = 64


def _bucket():
    """Hash bucket of a premium-values key (client, policy): the unit a change rewrites."""
    return F.pmod(F.xxhash64("client_id", "policy_number"), F.lit(INDEX_BUCKETS)).cast("int")


def _promotion_columns(df: DataFrame, run_id: str) -> DataFrame:
    """Columns the validated tables carry: run id of the validation, period and its type."""
    return (df.withColumn("validation_run_id", F.lit(run_id))
            .withColumn("period", F.col("quarter")).withColumn("period_type", F.lit("quarterly")))


def run_batch(spark: SparkSession, landing: str, warehouse: str, meta: Metadata, run_id: str,
              checked_at: str | None = None) -> dict[str, DataFrame]:
    """Scan the landing folder and process every file that is not done yet: new ones, and earlier ones that were
    blocked by the gate, failed, or belong to a run that did not end."""
    return run_files(spark, sf.scan_landing(spark, landing), warehouse, meta, run_id, checked_at)


def run_files(spark: SparkSession, inventory: DataFrame, warehouse: str, meta: Metadata, run_id: str,
              checked_at: str | None = None) -> dict[str, DataFrame]:
    """Process the files of an inventory frame (a folder scan or one micro-batch of arrivals)."""
    w = warehouse.rstrip("/")
    out: dict[str, DataFrame] = {}
    for t in (*(f"silver/validated/{c}" for c in (*PREMIUM_LIKE, *CLAIMS_LIKE)), *(f"gold/{c}" for c in (*PREMIUM_LIKE, *CLAIMS_LIKE))):
        up.recover_upserts(spark, f"{w}/{t}")
    _recover_kept(spark, w)

    # ---- 1. seen: the inventory, and each content hash tracked once
    inv = tb.materialize(inventory, "landing")
    cols = ["file_hash", "path", "file_name", "client_id", "category", "year", "quarter"]
    acc = inv.filter("accepted")
    new = ig.register_files(acc, _read(spark, f"{w}/audit/file_tracking"), order=["path"], payload=cols)
    tb.append(tb.materialize(new, "registered").withColumn("run_id", F.lit(run_id)).withColumn("tracked_at", F.current_timestamp()),
              f"{w}/audit/file_tracking")

    # ---- 2. one attempt per file: bronze, then its status in the log
    _ingest(spark, inv, w, meta, run_id)

    # ---- 3. files to stage: in bronze, and never staged to the end or last FAILED (J2, J9, S15), gated by the mapping
    log = _read(spark, f"{w}/audit/ingestion_log")
    if log is None:
        return out
    pending = tb.materialize(pending_files(log, _read(spark, f"{w}/audit/staging_log")), "pending")
    heads = sf.header_columns(pending.withColumn("path", F.col("file_hash"))).withColumnRenamed("path", "file_hash").join(
        pending.select("file_hash", "client_id", "file_name", "category"), "file_hash")
    if "effective_from" in meta.mapping.columns:
        seen = _read(spark, f"{w}/audit/file_tracking").groupBy("file_hash").agg(F.min("tracked_at").alias("uploaded_at"))
        as_of = dr.mapping_as_of(pending.join(seen, "file_hash"), meta.mapping)
        meta = replace(meta, mapping=tb.materialize(as_of, "mapping-as-of"))
    gate = dr.mapping_gate(heads, meta.mapping)
    _queue_reviews(spark, heads, meta.mapping, f"{w}/audit/mapping_review_queue")
    queue = tb.materialize(pending.join(gate.filter(F.col("status") == "QUEUED").select("file_hash"), "file_hash", "left_semi"), "queued")
    queued = queue.select("file_hash")
    gate = tb.materialize(gate, "gate")
    tb.append(gate.withColumn("run_id", F.lit(run_id)).withColumn("checked_at", F.current_timestamp()), f"{w}/audit/gate_log")
    out["gate"] = gate
    if queue.limit(1).count() == 0:   # nothing new or everything blocked: no further stage runs
        return out
    # canonical columns of each file, from its own header
    present = tb.materialize(dr.canonical_headers(heads, meta.mapping).groupBy("file_hash")
                             .agg(F.collect_set("column_name").alias("columns")), "present")

    # ---- 4. canonicalise, stage, split (P3, P5-P8, D1-D13, A7, A12); PII is hashed at the sinks
    canon = cn.canonicalise(_bronze_rows(spark, queue, f"{w}/bronze").withColumn("run_id", F.lit(run_id)), meta.mapping)
    # (each file's rows are compared below with what bronze logged for it)
    prem = st.stage_premium(canon.filter(F.col("category").isin(*PREMIUM_LIKE)))
    clm = st.stage_claims(canon.filter(F.col("category").isin(*CLAIMS_LIKE)))
    staged_tables = {}
    for name, staged in (("premium", prem), ("claims", clm)):
        staged = (staged.withColumn("_clean", (F.size("dq_issues") == 0).cast("int")).withColumn("period", F.col("quarter"))
                  .withColumn("staging_time", F.current_timestamp()))
        staged = tb.materialize(staged, f"staged-{name}", ["_clean"]) if _any(staged) else staged.filter(F.lit(False))
        staged_tables[name] = staged
        if _any(staged):
            tb.write_partitions(cn.mask_pii(staged, meta.mapping), f"{w}/silver/staging/{name}", ["run_id", "category", "_clean"])
    sp, sc = staged_tables["premium"], staged_tables["claims"]
    # every file of the queue has a log row, also one whose header has no rows below it
    counts = st.staging_log(sp, run_id).unionByName(st.staging_log(sc, run_id))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows_read", "rows_to_silver", "rows_quarantined")]
    whole = F.coalesce("rows_read", F.lit(0)) == F.coalesce("rows_written", "rows_read", F.lit(0))
    log = tb.materialize(
        queue.select("client_id", "file_hash", "file_name", "category", "year", "quarter", "period", "period_type", "rows_written")
        .join(counts.select("file_hash", "rows_read", "rows_to_silver", "rows_quarantined"), "file_hash", "left")
        .select("client_id", "file_hash", "file_name", "category", "year", "quarter", *zero, F.lit(run_id).alias("run_id"),
                F.when(whole, "SUCCESS").otherwise("FAILED").alias("status"), "period", "period_type", F.current_timestamp().alias("processed_at")), "staging-log")
    # a file of which rows went missing goes no further; its FAILED row offers it to the next run
    done = log.filter("status = 'SUCCESS'").select("file_hash")
    sp, sc = sp.join(done, "file_hash", "left_semi"), sc.join(done, "file_hash", "left_semi")
    tb.append(st.rule_counts(sp).unionByName(st.rule_counts(sc)).withColumn("run_id", F.lit(run_id)),
              f"{w}/audit/quarantine_summary")
    failures = va.load_failures(queue, log.filter("rows_to_silver > 0"), run_id, checked_at)
    tb.append(failures, f"{w}/audit/validation_results")

    # ---- 5. premium validation and promotion, then claims
    # A kind of file absent from the run has no columns to check: its validation is skipped.
    clean_p = sp.filter(F.col("_clean") == 1).drop("_clean")
    if all(c in clean_p.columns for c in REQUIRED["premium"]):
        hist_p = _history(spark, w, "premium", clean_p)
        pv = va.validate_premium(clean_p, meta.treaty, meta.rates, hist_p, run_id=run_id, checked_at=checked_at, present=present)
        out["premium_checks"] = tb.materialize(pv.checks, "premium-checks")
        tb.append(out["premium_checks"], f"{w}/audit/validation_results")
        _export(pv, meta.mapping, f"{w}/quarantine/run_id={run_id}/premium", run_id)
        promote_p = tb.materialize(cn.mask_pii(_promotion_columns(pv.promotable(), run_id), meta.mapping), "promote-premium")
        for cat in PREMIUM_LIKE:
            _promote(spark, promote_p.filter(F.col("category") == cat), w, cat)

    clean_c = sc.filter(F.col("_clean") == 1).drop("_clean")
    if all(c in clean_c.columns for c in REQUIRED["claims"]):
        prem_index = _premium_index(spark, w, clean_c)
        claims_hist = _read(spark, f"{w}/silver/validated/claims")
        cv = va.validate_claims(clean_c, meta.treaty, None, claims_hist, run_id=run_id, checked_at=checked_at,
                                premium_index=prem_index, present=present, duplicate_history=_history(spark, w, "claims", clean_c))
        out["claims_checks"] = tb.materialize(cv.checks, "claims-checks")
        tb.append(out["claims_checks"], f"{w}/audit/validation_results")
        _export(cv, meta.mapping, f"{w}/quarantine/run_id={run_id}/claims", run_id)
        promote_c = tb.materialize(cn.mask_pii(_promotion_columns(cv.promotable(), run_id), meta.mapping), "promote-claims")
        for cat in CLAIMS_LIKE:
            _promote(spark, promote_c.filter(F.col("category") == cat), w, cat)

    # ---- 6. reconciliation and gold
    scope = log.filter("status = 'SUCCESS'").select("client_id", "category", "year", F.col("quarter").alias("period"))
    def _union(cats):
        parts = [t for t in (_read(spark, f"{w}/silver/validated/{c}") for c in cats) if t is not None]
        out_ = parts[0] if parts else None
        for t in parts[1:]:
            out_ = out_.unionByName(t, allowMissingColumns=True)
        return out_

    vp, vc = _union(PREMIUM_LIKE), _union(CLAIMS_LIKE)
    res = rc.reconcile(dl.amounts_of_totals(_period_totals(spark, w), scope), meta.soa, run_id=run_id, checked_at=checked_at)
    res = tb.materialize(res, "recon")
    tb.append(res, f"{w}/audit/recon_results")
    for cat, v in (("premium", vp), ("claims", vc)):
        if v is None:
            continue
        rows = tb.materialize(rc.reconciled_rows(v, res), f"gold-{cat}")
        for sub in (cat, f"{cat}_adj"):      # _adj keeps base-category keys but its own table (R4)
            part = rows.filter(F.col("category") == sub)
            if part.limit(1).count():
                up.write_upsert(spark, part, f"{w}/gold/{sub}", up.merge_keys(cat))
    out["recon"] = res

    # ---- 7. done: only now are the files of the queue taken as staged; a run that ended before offers them again
    tb.append(log, f"{w}/audit/staging_log")
    return out


# ------------------------------------------------------------------ tables kept by the changes of a promotion
def _promote(spark: SparkSession, part: DataFrame, w: str, cat: str) -> None:
    """Upsert the promoted rows of a category and bring the tables kept from it up to date by what changed.

    The change is written before the upsert and removed after the last table that needs it.  A run that ends in
    between leaves it there, and the next run sums its groups again from the validated table (``_recover_kept``).
    Key maps only ever gain bits, so they are written first: no row is in the history before its bit.
    """
    if not _any(part):
        return
    if cat in KEY_MAPS:
        _write_maps(spark, w, cat, part)
    path, keys = f"{w}/silver/validated/{cat}", up.merge_keys(cat)
    if tb.table_exists(spark, path):
        target = tb.read_table(spark, path, merge_schema=True, types={f.name: f.dataType for f in part.schema})
        target = up.touched_rows(target, part, up.PARTITION_KEYS)
    else:
        target = up.empty_like(spark, part)
    change = f"{w}/silver/changes/{cat}/{uuid.uuid4().hex}"
    dl.changes(target, part, keys, _kept_columns(cat)).write.parquet(change)
    up.write_upsert(spark, part, path, keys)
    delta = spark.read.parquet(change)
    _write_totals(spark, w, cat, delta, delta)
    if cat == "premium":
        _write_values(spark, w, delta, delta)
    tb.remove_folder(spark, change)


def _kept_columns(cat: str) -> list[str]:
    own = ("treaty_id", "policy_number", "benefit_id", *dl.PREMIUM_VALUES) if cat == "premium" else ()
    return [*rc.GROUP_KEYS, dl.AMOUNTS[cat], *own]


def _write_totals(spark: SparkSession, w: str, cat: str, delta: DataFrame, touched: DataFrame, afresh: bool = False) -> None:
    """Fold a change into the period totals of a category; only the periods in ``touched`` are read and rewritten."""
    path = f"{w}/silver/period_totals/{cat}"
    old = None if afresh else _read(spark, path)
    if old is not None:
        old = up.touched_rows(old, touched, up.PARTITION_KEYS)
    up.replace_partitions(spark, dl.fold_totals(old, delta, dl.AMOUNTS[cat]), path, up.PARTITION_KEYS)


def _write_values(spark: SparkSession, w: str, delta: DataFrame, touched: DataFrame, afresh: bool = False) -> None:
    """Fold a change into the premium values; only the key buckets in ``touched`` are read and rewritten."""
    path = f"{w}/silver/premium_values"
    old = None if afresh else _read(spark, path)
    if old is not None:
        old = old.filter(F.col("_bucket").isin(_buckets(touched)))
    rows = dl.fold_values(old, delta).withColumn("_bucket", _bucket()).hint("rebalance", "_bucket")
    up.replace_partitions(spark, rows, path, ["_bucket"])


#: Key columns, exact columns and maps per exact value of the tables in which duplicates are looked for.
KEY_MAPS = {"premium": (("client_id", *va.PREMIUM_DUP_KEYS), ("valuation_date",), 8), "claims": (("client_id", *va.CLAIMS_DUP_KEYS), (), 64)}


def _write_maps(spark: SparkSession, w: str, cat: str, rows: DataFrame) -> None:
    """Add the keys of some rows to the key maps of their periods."""
    path, by = f"{w}/silver/key_maps/{cat}", up.PARTITION_KEYS
    keys, exact, spread = KEY_MAPS[cat]
    old = _read(spark, path)
    if old is not None:
        old = up.touched_rows(old, rows, by)
    up.replace_partitions(spark, pr.merge_maps(old, pr.key_maps(rows, keys, by, exact, spread), by, exact), path, by)


def _history(spark: SparkSession, w: str, cat: str, batch: DataFrame) -> DataFrame | None:
    """Validated rows of the periods that can hold a key of the batch; None without a validated table.

    The periods to read are a partition filter: one entry a quarter of history at most.
    """
    rows, maps = _read(spark, f"{w}/silver/validated/{cat}"), _read(spark, f"{w}/silver/key_maps/{cat}")
    if rows is None or maps is None:
        return rows
    keys, exact, spread = KEY_MAPS[cat]
    asked = pr.key_maps(batch.filter(F.col("category") == cat), keys, exact=exact, spread=spread)
    found = F.lit(False)
    for year, period in sorted(pr.partitions_to_read(maps, asked, up.PARTITION_KEYS, exact).collect(), key=str):
        found = found | (F.col("year").eqNullSafe(F.lit(year)) & F.col("period").eqNullSafe(F.lit(period)))
    return rows.filter(found)


def _buckets(rows: DataFrame) -> list[int]:
    """Key buckets of some rows: at most INDEX_BUCKETS numbers, used as a partition filter."""
    return sorted(r[0] for r in rows.select(_bucket().alias("_bucket")).distinct().collect())


def _premium_index(spark: SparkSession, w: str, claims: DataFrame) -> DataFrame | None:
    """Premium index of the policies of the claims: only their buckets are read."""
    values = _read(spark, f"{w}/silver/premium_values")
    if values is None:
        return None
    mine = claims.select("client_id", "policy_number").distinct()
    return dl.extremes(values.filter(F.col("_bucket").isin(_buckets(mine))).join(mine, ["client_id", "policy_number"], "left_semi"))


def _period_totals(spark: SparkSession, w: str) -> DataFrame | None:
    found = [t for t in (_read(spark, f"{w}/silver/period_totals/{c}") for c in (*PREMIUM_LIKE, *CLAIMS_LIKE)) if t is not None]
    out = found[0] if found else None
    for t in found[1:]:
        out = out.unionByName(t)
    return out


def _recover_kept(spark: SparkSession, w: str) -> None:
    """Make the kept tables fit the validated tables before a run.

    A change that is still there belongs to a run that ended before it was folded in everywhere (or before its
    upsert): its periods and buckets are summed again from the validated rows, whichever of the two it was.  Tables
    that do not exist yet beside a validated table are built from it.
    """
    up.recover_upserts(spark, f"{w}/silver/premium_values", ["_bucket"])
    for cat in (*PREMIUM_LIKE, *CLAIMS_LIKE):
        up.recover_upserts(spark, f"{w}/silver/period_totals/{cat}")
        left = [f"{w}/silver/changes/{cat}/{n}" for n in tb.folders(spark, f"{w}/silver/changes/{cat}")]
        up.recover_upserts(spark, f"{w}/silver/key_maps/{cat}")
        rows = _read(spark, f"{w}/silver/validated/{cat}")
        if rows is not None:
            if cat in KEY_MAPS and not tb.table_exists(spark, f"{w}/silver/key_maps/{cat}"):
                _write_maps(spark, w, cat, rows)
            columns = _kept_columns(cat)
            rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns], F.lit(1).alias(dl.SIGN))
            for path in (p for p in left if "_SUCCESS" in tb.folders(spark, p)):   # without the mark its upsert never began
                change = spark.read.parquet(path).withColumn(dl.SIGN, F.lit(0))    # names groups that may hold no row any more
                if tb.table_exists(spark, f"{w}/silver/period_totals/{cat}"):
                    again = up.touched_rows(rows, change, up.PARTITION_KEYS).unionByName(change)
                    _write_totals(spark, w, cat, again, change, afresh=True)
                if cat == "premium" and tb.table_exists(spark, f"{w}/silver/premium_values"):
                    again = rows.filter(_bucket().isin(_buckets(change))).unionByName(change)
                    _write_values(spark, w, again, change, afresh=True)
            if not tb.table_exists(spark, f"{w}/silver/period_totals/{cat}"):
                _write_totals(spark, w, cat, rows, rows, afresh=True)
            if cat == "premium" and not tb.table_exists(spark, f"{w}/silver/premium_values"):
                _write_values(spark, w, rows, rows, afresh=True)
        for path in left:
            tb.remove_folder(spark, path)


def decide(spark: SparkSession, warehouse: str, decisions: DataFrame, decided_at: str | None = None) -> DataFrame:
    """Store review decisions and return the mapping that follows from all of them.

    ``decisions``: client_id, category, raw_col_name, canonical_name, is_pii, action (approve, affects_calculations,
    reject, retire).  They are appended to ``audit/mapping_log``; items of the review queue that they settle get a row
    with their new status, and the latest row of an item holds (``review_items``).  The result is the frame to give
    ``Metadata.mapping``: rows with effective_from and effective_to.
    """
    w, when = warehouse.rstrip("/"), F.lit(decided_at).cast("timestamp") if decided_at else F.current_timestamp()
    rows = tb.materialize(decisions.select("client_id", "category", "raw_col_name", "canonical_name", "is_pii", "action", when.alias("decided_at")), "decisions")
    tb.append(rows, f"{w}/audit/mapping_log")
    queue = _read(spark, f"{w}/audit/mapping_review_queue")
    if queue is not None:
        act = F.lower("action")
        status = F.when(act == "approve", "APPROVED").when(act == "affects_calculations", "AFFECTS_CALCULATIONS").when(act == "reject", "REJECTED")
        settled = rows.select("client_id", "category", cn.normalize_name_col("raw_col_name").alias("raw_col_name"), status.alias("_new"), "decided_at").where("_new IS NOT NULL")
        settled = settled.groupBy("client_id", "category", "raw_col_name").agg(F.max_by("_new", "decided_at").alias("_new"), F.max("decided_at").alias("_at"))
        items = review_items(queue).where("status = 'PENDING'").join(settled, ["client_id", "category", "raw_col_name"])
        tb.append(tb.materialize(items.withColumn("status", F.col("_new")).withColumn("created_at", F.col("_at")).drop("_new", "_at"), "settled"),
                  f"{w}/audit/mapping_review_queue")
    return dr.mapping_intervals(tb.read_table(spark, f"{w}/audit/mapping_log"))


def review_items(queue: DataFrame) -> DataFrame:
    """Review items with their latest status."""
    rest = [c for c in queue.columns if c not in ("client_id", "category", "raw_col_name")]
    last = queue.groupBy("client_id", "category", "raw_col_name").agg(F.max_by(F.struct(*rest), F.struct("created_at", F.col("status") != "PENDING")).alias("x"))
    return last.select("client_id", "category", "raw_col_name", "x.*")


def pending_files(ingestion_log: DataFrame, staging_log: DataFrame | None) -> DataFrame:
    """Files in bronze that were never staged to the end, or whose latest staging run FAILED, with the run that ingested them."""
    ok = ingestion_log.filter(F.col("status") == "SUCCESS")
    if staging_log is None:
        staging_log = ok.select("file_hash", "run_id", "status").filter(F.lit(False))
    if "rows_written" not in ok.columns:
        ok = ok.withColumn("rows_written", F.lit(None).cast("long"))
    first = ok.groupBy("file_hash").agg(F.max(F.struct("run_id", "header", "rows_written")).alias("_last"))
    return (ig.staging_candidates(ok, staging_log).join(first, "file_hash").withColumn("bronze_run", F.col("_last.run_id"))
            .withColumn("header", F.col("_last.header")).withColumn("rows_written", F.col("_last.rows_written")).drop("_last"))


def _ingest(spark: SparkSession, inv: DataFrame, w: str, meta: Metadata, run_id: str) -> None:
    """Write the files that still need it to bronze and log one attempt per file.

    Of equal content one copy is ingested (the tracked one if it is there) and the others are logged as duplicates.
    A file is left out if it is already in bronze, of unknown category, or failed MAX_RETRIES times.  The log is
    written after bronze: rows of a run that ended in between belong to no logged attempt and are never read.
    """
    cols = ["file_hash", "path", "file_name", "client_id", "category", "year", "quarter"]
    acc = inv.filter("accepted")
    tracking = _read(spark, f"{w}/audit/file_tracking").select("file_hash", F.col("path").alias("_path"), F.col("client_id").alias("_client"))
    log = _read(spark, f"{w}/audit/ingestion_log")
    seen = acc.join(tracking, "file_hash")
    chosen = seen.groupBy("file_hash").agg(F.min(F.struct(F.col("path") != F.col("_path"), "path")).alias("_c")).select("file_hash", F.col("_c.path").alias("_chosen"))
    seen = tb.materialize(seen.join(chosen, "file_hash"), "sightings")
    copies = (seen.filter(F.col("path") != F.col("_chosen"))
              .withColumn("status", F.when(F.col("client_id") != F.col("_client"), "CROSS_CLIENT_DUP").otherwise("DUPLICATE"))
              .withColumn("message", F.concat(F.lit("same content as "), F.col("_path")))
              .select(*cols, "header", "status", "message"))
    todo = seen.filter(F.col("path") == F.col("_chosen"))
    if log is not None:
        copies = copies.join(log.select("file_hash", "path", "status"), ["file_hash", "path", "status"], "left_anti")
        attempts = log.filter(~F.col("status").isin("DUPLICATE", "CROSS_CLIENT_DUP"))
        todo = ig.files_to_ingest(todo, attempts)
    todo = tb.materialize(todo, "to-ingest")
    good = todo.filter(F.col("header_error").isNull() & (F.col("category") != "others"))
    written = spark.createDataFrame([], "file_hash string, rows_written long")
    if _any(good):
        bronze = sf.scan_bordereaux(spark, good)
        bronze = (bronze.withColumn("_fp", F.md5(F.concat_ws("|", "file_hash", F.to_json("data")))).withColumn("run_id", F.lit(run_id))
                  .withColumn("source_path", F.col("path")).withColumn("ingestion_time", F.current_timestamp()))
        # partitioned by run first: a run replaces only its own rows, and readers prune to the runs they need
        tb.write_partitions(bronze, f"{w}/bronze", ["run_id", "category"])
        written = (spark.read.schema(BRONZE).parquet(f"{w}/bronze").filter(F.col("run_id") == run_id)
                   .groupBy("file_hash").agg(F.count(F.lit(1)).alias("rows_written")))
        files = good.select("file_hash", "client_id", "file_name", "category")
        heads = sf.header_columns(good).join(good.select("path", "file_hash"), "path").drop("path").join(files, "file_hash")
        current = meta.mapping.where("effective_to IS NULL") if "effective_from" in meta.mapping.columns else meta.mapping
        drift = dr.schema_drift(heads, dr.expected_frame(spark), run_id, mapping=current)
        tb.append(drift, f"{w}/audit/schema_drift")
    # a file is only a success if bronze holds as many rows as the file has lines below its header
    sizes = acc.groupBy("file_hash").agg(F.count(F.lit(1)).alias("duplicate_count"))
    todo = (todo.withColumnRenamed("data_lines", "rows_read").join(written, "file_hash", "left").join(sizes, "file_hash", "left")
            .withColumn("rows_written", F.coalesce("rows_written", F.lit(0).cast("long"))))
    missing = F.col("rows_written") != F.col("rows_read")
    status = (F.when(F.col("header_error").isNotNull(), "FAILED").when(F.col("category") == "others", "UNKNOWN_CATEGORY")
              .when(missing, "FAILED").otherwise("SUCCESS"))
    message = F.coalesce("header_error", F.when((status == "FAILED") & missing, F.format_string("ROWS_MISSING: %d of %d lines", "rows_written", "rows_read")))
    attempts = todo.select(*cols, "header", status.alias("status"), F.substring(message, 1, 200).alias("message"), "rows_read", "rows_written", "duplicate_count")
    tb.append(attempts.unionByName(copies, allowMissingColumns=True).withColumn("run_id", F.lit(run_id)).withColumn("logged_at", F.current_timestamp()),
              f"{w}/audit/ingestion_log")


def _bronze_rows(spark: SparkSession, queue: DataFrame, path: str) -> DataFrame:
    """Bronze rows of the queued files as flat columns, each from the run that logged it; only those runs' partitions are read."""
    runs = sorted(r[0] for r in queue.select("bronze_run").distinct().collect())  # runs with pending files
    rows = spark.read.schema(BRONZE).parquet(path).filter(F.col("run_id").isin(runs))
    mine = queue.select("file_hash", F.col("bronze_run").alias("_run"))
    rows = rows.join(mine, (rows.file_hash == mine.file_hash) & (rows.run_id == mine._run), "left_semi")
    return sf.project(rows, sf.column_names(queue))


def _queue_reviews(spark: SparkSession, heads: DataFrame, mapping: DataFrame, path: str) -> None:
    """A PENDING review item for every column without a mapping that has no open item."""
    queue = _read(spark, path)
    if queue is None:
        queue = spark.createDataFrame([], "client_id string, category string, raw_col_name string, file_name string, status string")
    else:
        queue = review_items(queue)
    items = tb.materialize(dr.review_queue_inserts(dr.unmapped_columns(heads, mapping), queue), "review-items")
    if _any(items):
        tb.append(items.withColumn("created_at", F.current_timestamp()), path)


def _export(v: va.Validation, mapping: DataFrame, path: str, run_id: str) -> None:
    """The rows a validation quarantined, as CSV per file with PII hashed."""
    rows = v.quarantined()
    kinds = dict(rows.dtypes)
    flat = rows.drop(*[c for c in rows.columns if c != "dq_reasons" and kinds[c].startswith(("array", "map", "struct"))])
    tb.export_csv(cn.mask_pii(flat, mapping), path, run_id=run_id)


def _any(df: DataFrame) -> bool:
    return df.limit(1).count() > 0
