"""Column canonicalisation and PII masking for many clients and categories at once.

A bronze frame holds the files of many clients, each with its own versioned
column mapping per file category.  The active mapping is a small table; it is
aggregated to one row per (client, category), whose map gives the raw columns of
every canonical name, and joined to the rows.  Each canonical column then looks
its value up in the row's raw values: the plan grows with the number of columns,
not with clients, and no client's mapping reaches the driver.  Only the distinct
column names do (they are the columns of the result).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import normalize_name, normalize_name_col
from .drift import active_mapping

#: A mapping holds for a client's files of a category, or (``drift.mapping_as_of``) for one file.
SCOPE = ("client_id", "category", "file_hash")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with the name normaliser."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def _active(mapping: DataFrame, df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Active mapping rows with normalised raw names, and the columns that scope them in both frames."""
    m = active_mapping(mapping)
    scope = [c for c in SCOPE if c in m.columns and c in df.columns]
    return m.select(*scope, normalize_name_col("raw_col_name").alias("raw"), F.col("canonical_name").alias("canonical"),
                    F.coalesce("is_pii", F.lit(False)).alias("is_pii")).distinct(), scope


def canonicalise(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Raw columns to canonical names per (client, category); unmapped columns kept.

    Several raw columns of one canonical name are coalesced in order of their names, after an existing canonical
    column.  A mapping without a category column holds for all categories of its client.
    """
    m, scope = _active(mapping, df)
    m = m.where(F.col("raw").isin(df.columns) & (F.col("raw") != F.col("canonical")))
    used = sorted(r[0] for r in m.select("raw").distinct().collect())
    canon = sorted(r[0] for r in m.select("canonical").distinct().collect())
    if not used:
        return df
    per = (m.groupBy(*scope, "canonical").agg(F.array_sort(F.collect_set("raw")).alias("raws"))
           .groupBy(*scope).agg(F.map_from_entries(F.collect_list(F.struct("canonical", "raws"))).alias("__raws")))
    rows = df.withColumn("__value", F.create_map(*[x for r in used for x in (F.lit(r), F.col(r).cast("string"))]))
    rows = rows.join(per, scope, "left")
    out = []
    for c in canon:
        found = F.transform(F.col("__raws")[F.lit(c)], lambda r: F.col("__value")[r])
        value = F.get(F.filter(found, lambda v: v.isNotNull()), F.lit(0))
        out.append((F.coalesce(F.col(c).cast("string"), value) if c in df.columns else value).alias(c))
    keep = [F.col(c) for c in df.columns if c not in used and c not in canon]
    return rows.select(*keep, *out)


def mask_pii(df: DataFrame, mapping: DataFrame, salt: str = "") -> DataFrame:
    """SHA-256 of the PII columns each (client, category) flags, written at the sinks after all checks.

    A text column holds the hash in place of the value.  A typed column (a date of birth) keeps its type: it is null
    where masked and the hash stands in ``<column>_sha256``.
    """
    m, scope = _active(mapping, df)
    m = m.where(F.col("is_pii") & F.col("canonical").isin(df.columns))
    flagged = sorted(r[0] for r in m.select("canonical").distinct().collect())
    if not flagged:
        return df
    per = m.groupBy(*scope).agg(F.collect_set("canonical").alias("__pii"))
    rows = df.join(per, scope, "left")
    kinds = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c not in flagged:
            out.append(F.col(c))
            continue
        hit = F.coalesce(F.array_contains("__pii", F.lit(c)), F.lit(False))
        text = F.col(c).cast("string")
        hashed = F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)
        if kinds[c] == "string":
            out.append(F.when(hit, hashed).otherwise(F.col(c)).alias(c))
        else:
            out += [F.when(~hit, F.col(c)).alias(c), F.when(hit, hashed).alias(f"{c}_sha256")]
    return rows.select(*out)
