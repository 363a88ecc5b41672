"""Reconciliation of the event log with stored counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import bucket_id

TOTALS = ["pageviews", "clicks", "bot_events"]


def copies(messages: DataFrame) -> DataFrame:
    """One row per (site, id): copies, distinct partitions, positions in order."""
    position = F.struct(F.col("part"), F.col("offset"))
    return messages.groupBy("site_id", "id").agg(F.count(F.lit(1)).alias("copies"), F.count_distinct("part").alias("partitions"), F.array_join(F.transform(F.sort_array(F.collect_list(position)), lambda p: F.concat_ws(":", p["part"].cast("string"), p["offset"].cast("string"))), ",").alias("positions"), F.min_by(bucket_id(F.col("site_id"), F.col("ts")), position).alias("bucket_id"))


def bucket_diff(stored: DataFrame, unique: DataFrame) -> DataFrame:
    """Buckets whose totals differ, with signed differences (stored minus unique); a missing side is 0."""
    a = stored.select("bucket_id", *(F.col(c).alias(f"s_{c}") for c in TOTALS))
    b = unique.select("bucket_id", *(F.col(c).alias(f"u_{c}") for c in TOTALS))
    zero = F.lit(0)
    both = a.join(b, "bucket_id", "full_outer").select("bucket_id", *((F.coalesce(f"s_{c}", zero) - F.coalesce(f"u_{c}", zero)).cast("long").alias(c) for c in TOTALS))
    return both.where(" or ".join(f"{c} <> 0" for c in TOTALS))


def of_sites(rows: DataFrame, prefix: str) -> DataFrame:
    """Rows of the sites with a prefix: of events, or of counters by the site in their bucket id (pushed to the scan)."""
    return rows.where(F.col("site_id" if "site_id" in rows.columns else "bucket_id").startswith(prefix))


def first_and_rest(diff: DataFrame, show: int = 15) -> DataFrame:
    """The first ``show`` differing buckets in order, each with the number of buckets that are not shown."""
    hidden = diff.agg(F.greatest(F.count(F.lit(1)) - show, F.lit(0)).alias("n")).scalar()
    return diff.orderBy("bucket_id").limit(show).withColumn("remaining", hidden)


def verdict(expected: list[Column], unique: list[Column], stored: list[Column]) -> Column:
    same = lambda x, y: F.forall(F.arrays_zip(F.array(*x).alias("a"), F.array(*y).alias("b")), lambda p: p["a"] == p["b"])
    return F.when(same(unique, expected) & same(stored, unique), "consistent").when(~same(unique, expected) & same(stored, unique), "upstream").when(~same(unique, expected), "upstream_and_aggregation").otherwise("aggregation")
