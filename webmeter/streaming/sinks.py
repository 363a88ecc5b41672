"""Idempotent sinks for foreachBatch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counters
from .retry import RetryPolicy


def delta_sink(folder: str, delta: Callable[[DataFrame], DataFrame], retry: RetryPolicy | None = None) -> Callable[[DataFrame, int], None]:
    """Writes each batch's counters to ``batch_id=N``; a repeated batch overwrites its own folder."""
    retry = retry or RetryPolicy()

    def write(batch: DataFrame, batch_id: int) -> None:
        retry.run(f"deltas of batch {batch_id}", lambda: delta(batch).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}"))

    return write


def read_deltas(spark: SparkSession, folder: str) -> DataFrame:
    return counters.merged(spark.read.option("basePath", folder).parquet(f"{folder}/batch_id=*"))


def compact(spark: SparkSession, folder: str, target: str) -> None:
    """Sums all deltas into one table of ``target``; the caller swaps the folders."""
    read_deltas(spark, folder).write.mode("overwrite").parquet(target)


def store_by_site(stored: DataFrame, folder: str) -> None:
    """Counters (site_id, minute, ...) in a folder a site, sorted by minute in the files.

    A scan of the latest minutes of a site reads that folder only, and skips
    row groups by their minutes.
    """
    stored.repartition("site_id").sortWithinPartitions("site_id", F.col("minute").desc()).write.mode("overwrite").partitionBy("site_id").parquet(folder)


def latest_of_site(spark: SparkSession, folder: str, site: str, n: int = 10) -> DataFrame:
    return spark.read.parquet(folder).where(F.col("site_id") == site).orderBy(F.col("minute").desc(), "bucket_id").limit(n)


def split_sink(enriched: str, dead: str) -> Callable[[DataFrame, int], None]:
    """Writes accepted rows and dead letters of a batch to two topics, both overwritten when the batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.where(F.col("reason").isNull()).write.mode("overwrite").parquet(f"{enriched}/batch_id={batch_id}")
            batch.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write
