"""The corpus pipeline: quality, near duplicates, benchmark, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webmeter.llm import bpe, decontaminate, jaccard, quality, secret_scan
from webmeter.llm.queries import rank_path
from webmeter.llm.text import crc32_mod, fresh, written

QUALITY_THRESHOLD = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects (score below 0.3)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"{crc32_mod('doc_id', 5)} <> 0")
    names = docs.columns
    out = fresh(names, "quality_score")
    scored = quality.score(docs, quality.fit(docs, labels), out=out)
    return scored.where(F.col(out) >= QUALITY_THRESHOLD).select(*names)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group of near copies."""
    return jaccard.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; no document is dropped, ``n_chars`` follows the text."""
    names = docs.columns
    out = fresh(names, "redacted")
    scanned = secret_scan.scan(docs, bpe.rank_file(spark, rank_path()), outputs=("redacted",), called={"redacted": out})
    changed = {"text": F.col(out)} | ({"n_chars": F.when(F.col("n_chars").isNotNull(), F.length(out).cast("long"))} if "n_chars" in names else {})
    return scanned.withColumns(changed).select(*names)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed as little-endian 32-bit integers, with digests of ids and decoded bytes."""
    return bpe.encode(docs, bpe.rank_file(spark, rank_path()), outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"), keep=["doc_id"])


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("secret scans", secrets_stage),
    ("byte-level BPE encoding and decoding", tokens_stage),
]

#: Trained and iterative stages cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(spark, docs)
    return docs
