"""The registered queries: thin forms of the operators over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hilbert, langid, merkle, oracles, oracles_shards, packing, periodic, phrases, pseudonyms, pstable
from . import quotes, secret_scan, separators, simhash
from .registry import query


DEMO_KEY = "registered query"  # in use, the key comes from a secret store


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@query("op1_quote_links", oracles.QUOTES)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.conversations(_read(spark, folder, "conversations"))


@query("op2_separator_scan")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return separators.counted(_read(spark, folder, "documents"))


@query("op3_phrase_automata", oracles.PHRASES)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = phrases.without_repeats(_read(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op4_prefix_filtered_join", oracles.LEAKS)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query("op5_sum_of_squares_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_sequences(_read(spark, folder, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op8_ball_hashing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op6_byte_convolution")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return langid.languages(_read(spark, folder, "documents"))


@query("op7_markov_secrets")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(secret_scan.labelled_tokens(docs)))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS[:3]]
    base = F.sha2(secret_scan.listed(secret_scan.KINDS[:3]), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secret_scan.listed(secret_scan.KINDS).alias("spans"))


@query("op9_feistel_pseudonyms")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(docs, DEMO_KEY)


@query("op10_p_stable_hashing", oracles.VECTORS)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return pstable.linked(_read(spark, folder, "embeddings"))


@query("op11_hilbert_shards", oracles_shards.SHARDS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = hilbert.curve_shards(_read(spark, folder, "documents"))
    return found.select(
        "row.doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op13_subtree_exchange", oracles_shards.MANIFEST)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    tampered = merkle.leaf_hash(changed={"n_chars": F.col("n_chars") + 1})
    drawn = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.manifest(docs, seen=F.when(drawn, tampered))
    proof = F.sha2("proof", 256).alias("proof_sha256")
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof, "folded_root", "verified")


@query("op12_block_convolution")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    found = periodic.periodic_runs(docs, text=periodic.with_periodic_tail(F.col("text"), F.col("doc_id")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("n"), (-r.start).alias("s"), (-r.period).alias("q"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("1000 * best.n div -best.q").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
