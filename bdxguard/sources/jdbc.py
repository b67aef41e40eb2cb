"""Relational source (S7): metadata and audit tables read from a database.

Operators take DataFrames, so the metadata tables (tracking, logs, mappings,
treaty config, rate tables, SOA entries) may come from any source.  For a JDBC
database the filter/projection is pushed into the database with ``query=``, as
the reference does with its subquery table arguments; large tables can be read
in parallel by a numeric partition column.  (Not exercised by the tests: no
database server is started in this environment.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, query: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    return r.load()


def append_table(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Append audit rows (one write of the whole frame, never row by row)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode("append")
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
