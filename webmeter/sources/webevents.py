"""Web events derived from the driver's ``events`` table.

The table lacks site, agent and lateness; each is a fixed function of its
columns, so that the same rows can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One agent of each kind that the classification must tell apart.
AGENTS = [
    "Mozilla/5.0 (Windows NT 11.0; Win64; arm64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/131.0.6778.86 Safari/537.36",
    "Mozilla/5.0 (Windows NT 11.0; Win64; arm64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/131.0.6778.86 Safari/537.36 Edg/131.0.2903.70",
    "Mozilla/5.0 (Wayland; Fedora; Linux aarch64; rv:133.0) Gecko/20100101 Firefox/133.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 18_1 like Mac OS X) AppleWebKit/619.2 (KHTML, like Gecko) Version/18.1 Mobile/22B91 Safari/619.2",
    "Mozilla/5.0 (iPad; CPU OS 18_1 like Mac OS X) AppleWebKit/619.2 (KHTML, like Gecko) Version/18.1 Mobile/22B91 Safari/619.2",
    "Mozilla/5.0 (Linux; Android 15; Example Phone) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/131.0.6778.81 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 15; Example Slate) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/131.0.6778.81 Safari/537.36",
    "ExampleSearchBot/3.2 (+https://search.example/about)",
    "Wget/1.24.5",
    "Mozilla/5.0 (Debian; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) HeadlessChrome/131.0.6778.85 Safari/537.36",
    "",
    "ExampleReader/7.4 (Haiku)",
]
#: Slices of the reception time, in seconds, in which offsets are numbered.
SLICE_S = 60
PARTITIONS = 6


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per delivered event, re-sends included."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"))
    copies = F.when(F.col("event_id") % 50 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    late = F.when(F.col("event_id") % 40 == 0, 4000).when(F.col("event_id") % 40 == 1, 3600).when(F.col("event_id") % 40 == 2, -600).when(F.col("event_id") % 40 == 3, 1800).otherwise(1)
    agent = F.element_at(F.array(*(F.lit(a) for a in AGENTS)), (F.col("ua_idx") + 1).cast("int"))
    kind = F.when(F.col("event_type").isin("view", "signup"), "pageview").when(F.col("event_type").isin("click", "purchase"), "click").otherwise(F.col("event_type"))
    e = e.withColumn("copy", F.explode(copies)).withColumn("ua_idx", (F.col("event_id") * 7 + F.col("user_id")) % 12)
    return e.select(
        F.concat(F.lit("evt-"), F.col("event_id")).alias("id"),
        kind.alias("type"),
        F.concat(F.lit("site-"), F.col("k") % 3).alias("site_id"),
        F.concat(F.lit("v-"), F.col("user_id")).alias("visitor_id"),
        F.concat(F.lit("https://example.com/page-"), F.col("event_id") % 50).alias("url"),
        agent.alias("user_agent"),
        "ts",
        F.timestamp_micros(F.unix_micros("ts") + (late + F.col("copy") * 60).cast("long") * 1_000_000).alias("received_at"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("part"),
        "copy",
        "event_id",
        "user_id",
    )


def arrival() -> list:
    """Order in which messages arrive; with the partition first it is the order of offsets."""
    return [F.col("received_at"), F.col("event_id"), F.col("copy")]


def with_offsets(events: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """Adds the offset in the simulated topic partition: its place in the order of arrival.

    Rows are numbered inside slices of the reception time, so that no task
    reads more than a slice; the offset at which a slice begins is a running
    sum of the slices' sizes (a row for each slice and partition).
    """
    at = F.coalesce(F.floor(F.unix_micros("received_at") / (slice_s * 1_000_000)).cast("long"), F.lit(-(1 << 62)))
    rows = events.withColumn("_slice", at)
    before = Window.partitionBy("part").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("part", "_slice").agg(F.count(F.lit(1)).alias("_size"))
    begins = sizes.select("part", "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy("part", "_slice").orderBy(*arrival())
    numbered = rows.withColumn("_n", F.row_number().over(inside) - 1)
    return numbered.join(begins, ["part", "_slice"]).withColumn("offset", F.col("_begin") + F.col("_n")).drop("_slice", "_begin", "_n")
