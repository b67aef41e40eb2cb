"""Landing-zone sources: file inventory scan, header probe, bronze CSV read.

Paths: ``binaryFile`` reports decoded paths while ``_metadata.file_path`` is
URL-encoded, so metadata paths are decoded before any join on the path
(a client folder such as ``MIDDLE EAST`` would otherwise never match).

All files of a landing folder are read by *one* scan, whatever their headers
(schema drift): a row is a map from its file's column names to its values, named
by joining the headers that the inventory already holds.  The driver loops over
neither files nor header versions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import normalize_name_col
from ..operators.ingest import file_inventory
from .ranges import content_digests, plain_path


def _rel(path_col: str, root: str):
    root = re.sub(r"^[a-z0-9+.-]+:/*(?=/)", "", root.rstrip("/"))
    return F.regexp_replace(F.col(path_col), r"^.*?\Q" + root.replace(r"\E", r"\E\\E\Q") + r"\E/", "")


#: Files of at least this size are hashed by byte ranges (sources/ranges.py), smaller ones as one value.
WHOLE_BYTES = 1 << 28


def scan_landing(spark: SparkSession, root: str, whole_bytes: int = WHOLE_BYTES, **ranges) -> DataFrame:
    """S4 + S3 + S5 + S17: one row per landed file with a digest of its content, its header and the name-based inventory.

    ``binaryFile`` reads a file of less than ``whole_bytes`` as one value; the content is hashed (MD5) and its first
    line taken in the same scan task, then dropped: only the digest and the header leave it.  Larger files get a tree
    digest from byte ranges (``ranges``: leaf_bytes, range_bytes).  Spark's reader leaves out files of length zero;
    they are added from the listing, so that no landed file goes unreported.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_escaped(root))
    return inventory_from_binary(raw, root, whole_bytes, **ranges).unionByName(_empty_files(spark, root))


def _empty_files(spark: SparkSession, root: str) -> DataFrame:
    """Inventory rows of the files of length zero below ``root`` (from the store's listing; no data is read)."""
    from .tables import _hadoop

    fs, p = _hadoop(spark, root)
    rows, found = [], fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        if f.getLen() == 0 and not f.getPath().getName().startswith((".", "_")):
            rows.append((f.getPath().toString(), f.getModificationTime()))
    listed = spark.createDataFrame(rows, "path string, ms long")
    raw = listed.select("path", F.timestamp_millis("ms").alias("modificationTime"), F.lit(0).cast("long").alias("length"),
                        F.lit(b"").alias("content"))
    return inventory_from_binary(raw, root)


def first_line(content) -> F.Column:
    """First line of a file's bytes, without a byte-order mark or a carriage return."""
    return _header(F.substring_index(F.col(content).cast("string"), "\n", 1))


def _header(line) -> F.Column:
    return F.regexp_replace(F.regexp_replace(line, "\r$", ""), "^\ufeff", "")


def data_lines(content) -> F.Column:
    """Lines below the header that hold anything but blanks: as many rows as the CSV scan has to give for the file."""
    starts = F.regexp_count(F.col(content).cast("string"), F.lit(r"(^|[\r\n])[\x00-\x09\x0b\x0c\x0e-\x20]*[^\x00-\x20]"))
    return F.greatest(starts - 1, F.lit(0)).cast("long")


def inventory_from_binary(raw: DataFrame, root: str, whole_bytes: int = WHOLE_BYTES, **ranges) -> DataFrame:
    """Inventory rows from a ``binaryFile`` frame (batch or one micro-batch of a stream).

    ``header_error`` tells why a file cannot be read as a table: it is empty, or two of its column names are equal
    after normalising.  Such a file fails alone.  The hash of an empty file includes its path: it has no content that
    could be a copy of another's.
    """
    small = raw.filter(F.col("length") < whole_bytes)
    digest = F.when(F.col("length") == 0, F.md5("path")).otherwise(F.md5("content"))
    small = small.select("path", "length", "modificationTime", first_line("content").alias("header"), data_lines("content").alias("data_lines"),
                         digest.alias("file_hash"))
    large = raw.filter(F.col("length") >= whole_bytes).select("path", "length", "modificationTime")  # their content is not read here
    files = small if large.limit(1).count() == 0 else small.unionByName(_large_files(large, root, whole_bytes, **ranges))
    files = files.select("*", F.element_at(F.split("path", "/"), -1).alias("file_name"), _rel("path", root).alias("rel_path"))
    names = header_names("header")
    error = (F.when(F.col("length") == 0, "EMPTY_FILE").when(F.trim("header") == "", "NO_HEADER")
             .when(F.size(F.array_distinct(names)) < F.size(names), "DUPLICATE_COLUMN"))
    return file_inventory(files.withColumn("header_error", error))


def _large_files(large: DataFrame, root: str, whole_bytes: int, **ranges) -> DataFrame:
    """Digest, header and number of data lines of large files, each read by many tasks."""
    spark = large.sparkSession
    digests = content_digests(spark, root, whole_bytes, **ranges).select(
        F.col("plain_path").alias("_plain"), "file_hash", _header("head").alias("header"))
    lines = (spark.read.option("recursiveFileLookup", "true").text(_escaped(root)).filter(F.col("_metadata.file_size") >= whole_bytes)
             .filter(F.col("value").rlike(r"[^\x00-\x20]")).groupBy(decoded_path(F.col("_metadata.file_path")).alias("path"))
             .agg((F.count(F.lit(1)) - 1).alias("data_lines")))
    found = large.withColumn("_plain", plain_path("path")).join(digests, "_plain", "left").join(lines, "path", "left")
    return found.select("path", "length", "modificationTime", "header", F.coalesce("data_lines", F.lit(0)).cast("long").alias("data_lines"), "file_hash")


# split on commas outside double quotes; then drop the surrounding quotes
_CSV_SPLIT = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _unquoted(c) -> F.Column:
    return F.regexp_replace(F.regexp_replace(c, r'^\s*"|"\s*$', ""), '""', '"')


def header_columns(headers: DataFrame) -> DataFrame:
    """Headers as (path, position, raw_col_name) rows for drift and mapping checks (quote-aware)."""
    parts = F.posexplode(F.split("header", _CSV_SPLIT)).alias("position", "_raw")
    return headers.select("path", parts).select("path", "position", _unquoted(F.col("_raw")).alias("raw_col_name"))


def parse_header(header: str) -> list[str]:
    """Driver-side parse of one header line (one per header version), CSV quoting rules."""
    import csv

    return next(csv.reader([header]))


#: Audit columns of a bronze row; a data column of the same name gives way to them.
AUDIT = ("path", "file_hash", "file_name", "client_id", "category", "year", "quarter")


def _escaped(path: str) -> str:
    """A path as a pattern that only matches itself (Spark reads paths with ``[ ] { } * ?`` as patterns)."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def decoded_path(path: Column) -> Column:
    """``_metadata.file_path`` (percent-encoded) as the plain path that ``binaryFile`` reports; a plus sign is a plus sign."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def header_names(header: Column | str) -> Column:
    """Normalised column names of a header line, in order."""
    header = F.col(header) if isinstance(header, str) else header
    return F.transform(F.split(header, _CSV_SPLIT), lambda c: normalize_name_col(_unquoted(c)))


def scan_bordereaux(spark: SparkSession, landing: DataFrame) -> DataFrame:
    """S1 + S8: the rows of all accepted files by one scan, however many headers there are.

    ``landing``: output of ``scan_landing``; accepted rows without a header error are read.  The scan gives every row
    as fields by position, as many as the widest header has.  The small table of files and headers is joined to it by
    path and names the fields: ``data`` maps each file's own column names to the row's values (all strings).  The
    driver learns the landing roots, the width and the oldest file's time (older files are left out of the listing),
    never a path or a header.  ``_row_id`` is assigned in the scan.
    """
    acc = landing.filter(F.col("accepted") & F.col("header_error").isNull())
    files = acc.select(*AUDIT, header_names("header").alias("__names"))
    root = F.expr("substring(path, 1, length(path) - length(rel_path) - 1)")
    oldest = F.min("modificationTime") - F.expr("INTERVAL 1 SECOND")
    bounds = acc.agg(F.max(F.size(header_names("header"))).alias("width"), F.date_format(oldest, "yyyy-MM-dd'T'HH:mm:ss").alias("after"),
                     F.collect_set(root).alias("roots")).first()
    if not bounds["width"]:
        return files.select(*AUDIT, F.lit(None).cast("map<string, string>").alias("data"), F.lit(0).cast("long").alias("_row_id"))
    fields = [f"f{i}" for i in range(bounds["width"])]
    rows = (spark.read.option("header", True).schema(", ".join(f"{f} string" for f in fields)).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv").option("modifiedAfter", bounds["after"]).csv([_escaped(r) for r in bounds["roots"]])
            .select(F.array(*fields).alias("__values"), decoded_path(F.col("_metadata.file_path")).alias("path"),
                    F.monotonically_increasing_id().alias("_row_id")))
    data = F.map_from_arrays("__names", F.slice("__values", F.lit(1), F.size("__names")))
    return rows.join(files, "path").select(*AUDIT, data.alias("data"), "_row_id")


def project(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows with a ``data`` map as flat columns: the given names, null where a row's file has no such column."""
    kept = [c for c in rows.columns if c != "data"]
    return rows.select(*kept, *[F.col("data")[F.lit(n)].alias(n) for n in names if n not in kept])


def column_names(headers: DataFrame) -> list[str]:
    """All distinct normalised names in the headers, sorted: the columns of a flat frame."""
    return sorted(r[0] for r in headers.select(F.explode(header_names("header")).alias("n")).distinct().collect())


def read_bordereaux(spark: SparkSession, landing: DataFrame) -> DataFrame:
    """S1 + S2: ``scan_bordereaux`` with one string column for every column name of any file."""
    acc = landing.filter(F.col("accepted") & F.col("header_error").isNull())
    return project(scan_bordereaux(spark, landing), [n for n in column_names(acc) if n not in AUDIT])
