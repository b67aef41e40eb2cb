"""Corpus pipeline over ``documents``: language ID, toxicity, near-duplicates, packing.

``STAGES`` lists the stages in order.  Each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; what it returns is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bdxguard.llm import langid, toxicity
from bdxguard.llm.ngram_join import one_of_each
from bdxguard.llm.packing import pack
from bdxguard.sources.tables import materialize

#: A document stays if some language has at least this mean probability over its bytes.
MIN_LANGUAGE_SCORE = 0.4
#: Rows of an Arrow batch at most: whole rows and their texts pass to Python, and a batch is held on both sides.
BATCH_ROWS = 1000
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: And bytes: the buffers of a batch lie beside the executor's heap, on its side as on Python's.
BATCH_BYTES = 2 << 20
BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def _small_batches(spark: SparkSession) -> None:
    for key, most in ((BATCH_KEY, BATCH_ROWS), (BYTES_KEY, BATCH_BYTES)):
        if not 0 < _number(spark.conf.get(key)) <= most:
            spark.conf.set(key, str(most))


def _number(value: str) -> int:
    return int(value.rstrip("bB"))


def _whole(docs: DataFrame) -> DataFrame:
    """Every row as one column, so that no column of ``docs`` can clash with what an operator adds."""
    return docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell; null texts, texts without letters and undecided ones go."""
    _small_batches(spark)
    told = langid.predict(_whole(docs), langid.train(docs), ["row"])
    return told.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, learned from the labels of the documents so far, scores below the threshold."""
    _small_batches(spark)
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(_whole(docs), machine, ["row"]).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join stays: the one with the smallest doc_id."""
    _small_batches(spark)
    return one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every token of the documents goes: best-fit packing with conflicts."""
    _small_batches(spark)
    return pack(docs)


STAGES = [("language_id", language_id), ("toxicity", not_toxic), ("ngram_jaccard_join", near_duplicates), ("best_fit_packing", packed)]

#: No SQL: the stages learn models and pack bins.  Tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; the session's batch sizes are put back."""
    before = {key: spark.conf.get(key) for key in (BATCH_KEY, BYTES_KEY)}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    try:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return docs
