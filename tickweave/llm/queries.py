"""Queries of the numbered operators over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tickweave.llm import decontaminate, extract, fingerprints, lm, mixing, neardup, negatives, pieces, quality, sharding, toxicity, warc, whitening
from tickweave.llm.common import held_out, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.learn(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= quality.KEEP).cast("int").alias("predicted"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", neardup.hex_of(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("row")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("html")


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), path), path)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids divisible by 7 are moved on by one, as the contract has it."""
    rows = table(spark, sf_dir, "embeddings")
    return negatives.mine(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    exact = F.col("deviation")
    return found.select(
        "vec_id", "component", "n", exact.try_cast("long").alias("deviation"), "whitened", "explained", "identity_error", exact.alias("deviation_exact")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_quality": op1_quality,
        "op2_simhash": op2_simhash,
        "op3_mixing": op3_mixing,
        "op4_toxicity": op4_toxicity,
        "op5_decontaminate": op5_decontaminate,
        "op6_fingerprint": op6_fingerprint,
        "op7_lm": op7_lm,
        "op8_warc": op8_warc,
        "op9_extract": op9_extract,
        "op10_sharding": op10_sharding,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_negatives": op12_negatives,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    found = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return found | {"op3_mixing": mixing.sql(), "op8_warc": warc.sql(), "op10_sharding": sharding.sql(), "op12_negatives": negatives.sql()}
