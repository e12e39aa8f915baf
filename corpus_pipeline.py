"""From raw documents to packed sequences: the stages, in order, and a run over all of them.

Each stage takes the documents its predecessor kept, as a written table, and returns the documents it keeps
with their columns; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tourlytics.llm import decontaminate, langid, packing, secret_scan, simhash
from tourlytics.llm.shared import settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell; texts that are null or hold no letter go."""
    net = langid.fit(langid.learned_from(docs))
    found = langid.predict(docs.select(F.struct("*").alias("row"), "text"), net)
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return secret_scan.redacted(docs, secret_scan.train(secret_scan.labelled_tokens(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    found = packing.packed_sequences(docs)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a trained network, fingerprints and tokens are not for SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
