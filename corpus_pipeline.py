"""A pipeline from raw documents to packed training sequences.

``STAGES`` lists its steps. Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame that
is written as Parquet and read again as the next step's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableship.llm import ngram_join, packing, quality_classifier, secret_scan
from tableship.llm import quality_rules as rules
from tableship.llm.common import staged, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


#: Rows of a batch between Spark and Python. Rows hold whole documents here, so the default of
#: 10,000 would take hundreds of megabytes on either side.
BATCH_ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail a rule nor come from a rejected host."""
    _small_batches(spark)
    return rules.keep(docs)


def quality_classification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts. It learns from all labelled documents, since the
    rules before have removed most of those with label 0."""
    _small_batches(spark)
    described = staged(
        quality_classifier.describe(table(spark, sf_dir, "documents")), "quality-statistics"
    )
    labels = table(spark, sf_dir, "labels")
    model = quality_classifier.fit(described, labels, held_out=F.lit(False))
    return quality_classifier.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words per token, similarity of 0.8
    or more."""
    _small_batches(spark)
    return ngram_join.keep(docs, options=ngram_join.Options(percent=80, words=5))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a placeholder for each secret and their new number of characters."""
    clean = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
        clean = clean.withColumn("n_chars", F.coalesce(counted, F.col("n_chars")))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    _small_batches(spark)
    return packing.pack(packing.pieces(docs, TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classification),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("pattern_packing", pack),
]

#: Tokens, a trained classifier and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
