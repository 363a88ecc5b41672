"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, fingerprints, jaccard, maxent, quality, secret_scan, suffix_dedup, toxicity
from .text import crc32_mod


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; those with crc32(doc_id) mod 10 = 0 are held out."""
    return maxent.score(_documents(spark, sf_dir), F.expr(f"{crc32_mod('doc_id', 10)} <> 0"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the rows with crc32(doc_id) mod 3 = 1 are held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"{crc32_mod('doc_id', 3)} <> 1")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.expr(f"{crc32_mod('doc_id', 3)} = 1").alias("held_out"), "score", quality.predicted(F.col("score"), 0.7).alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of the rows with crc32(doc_id) mod 5 = 0 are held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"{crc32_mod('doc_id', 5)} <> 0")
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.expr(f"{crc32_mod('doc_id', 5)} = 0").alias("held_out"), "score", quality.predicted(F.col("score"), 0.3).alias("predicted"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each of its speakers."""
    return chat.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likenesses."""
    return fingerprints.compare(_documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, with the item, the place and the similarity."""
    return decontaminate.find(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def rank_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op7_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every text encoded and decoded again, as digests; ``path``: the rank file."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return bpe.encode(docs, bpe.rank_file(spark, path or rank_path()), outputs=("n_tokens", "ids_sha256", "decoded_sha256"), keep=["doc_id"])


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every text without the 100-byte strings that start earlier."""
    return suffix_dedup.dedup(_documents(spark, sf_dir), digests=True)


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links (five-word shingles, similarity 0.8 or more) of every document."""
    return jaccard.near_copies(_documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Secrets of every text: base patterns and the token-efficiency test; ``path``: the rank file."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return secret_scan.scan(docs, bpe.rank_file(spark, path or rank_path()), outputs=("n_assign", "n_access", "n_hex", "n_dense", "base_sha256", "spans"), keep=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_chat": op4_chat,
    "op5_decontaminate": op5_decontaminate,
    "op6_fingerprints": op6_fingerprints,
    "op7_bpe": op7_bpe,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_jaccard": op9_jaccard,
    "op10_secrets": op10_secrets,
}

ORACLE_SQL: dict[str, str] = {"op4_chat": chat.ORACLE}
