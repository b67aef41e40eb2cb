"""Spark session helpers.

The library never creates its own cluster settings beyond what a job needs:
ANSI mode on, UTC session clock, adaptive execution (coalescing and skew-join
splitting) on.  The checkpoint directory is read from the session
(``spark.checkpoint.dir``); only when it is unset (tests, local runs) do we set
one of our own.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot leaves methods of more bytecode interpreted; Spark then generates code operator by operator instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (~100 TB input, ~1000 executors).  The shuffle width is left to AQE:
# start wide, let it coalesce to ~256 MB partitions and split skewed ones.  Scan splits of 512 MB keep
# the task count of a 100 TB scan near 200k.  ``get_spark`` without a master applies what spark-submit leaves open.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.shuffle.partitions": "20000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "bdxguard",
              extra: dict | None = None) -> SparkSession:
    """A session.  With ``master`` (local runs) it has the library's defaults; without, spark-submit's settings hold
    and DEFAULT_CONF and CLUSTER_CONF only fill in what these leave open."""
    builder = SparkSession.builder.appName(app)
    if master:
        conf = {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
                "spark.driver.memory": os.environ.get("BDX_DRIVER_MEMORY", "16g")}
        builder = builder.master(master)
    else:
        SparkContext._ensure_initialized()  # so that SparkConf sees what spark-submit was given
        given = SparkConf()
        conf = {k: v for k, v in {**CLUSTER_CONF, **DEFAULT_CONF}.items() if not given.contains(k)}
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**conf, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators rely on to an existing session."""
    for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone",
              "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.codegen.hugeMethodLimit"):
        try:
            spark.conf.set(k, DEFAULT_CONF[k])
        except Exception:  # static conf on a shared session: keep what it has
            pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; on a local master, one of our own if none is configured."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="bdxguard-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
