"""Counters per site and minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import bucket_id, known_or_other, minute
from ..schema import BROWSERS, DEVICES

COUNTERS = ["pageviews", "clicks", "bot_events", "sessions"]


def counter_columns(new_session: Column | None = None) -> dict[str, Column]:
    human = ~F.col("is_bot")
    new = F.col("new_session") if new_session is None else new_session
    return {
        "pageviews": F.count_if(human & (F.col("type") == "pageview")),
        "clicks": F.count_if(human & (F.col("type") == "click")),
        "bot_events": F.count_if(F.col("is_bot")),
        "sessions": F.count_if(human & new),
    }


def minute_counters(events: DataFrame) -> DataFrame:
    """Four counters of each (site, minute of the event's own time); partial sums before the exchange."""
    out = events.groupBy("site_id", minute(F.col("ts")).alias("minute")).agg(*(c.alias(n) for n, c in counter_columns().items()))
    return out.select(bucket_id(F.col("site_id"), F.col("minute")).alias("bucket_id"), "site_id", "minute", *COUNTERS)


def breakdown(events: DataFrame, column: str, known: list[str]) -> DataFrame:
    """Human events of each bucket by a listed value, others as ``other``: long rows."""
    return events.where(~F.col("is_bot")).groupBy(bucket_id(F.col("site_id"), F.col("ts")).alias("bucket_id"), known_or_other(F.col(column), known).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def devices(events: DataFrame) -> DataFrame:
    return breakdown(events, "device", DEVICES)


def browsers(events: DataFrame) -> DataFrame:
    return breakdown(events, "browser", BROWSERS)


def with_maps(events: DataFrame) -> DataFrame:
    """The counters with sparse maps devices and browsers."""

    def folded(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy("bucket_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, "n")))).alias(f"{key}s"))

    out = minute_counters(events)
    return out.join(folded(devices(events), "device"), "bucket_id", "left").join(folded(browsers(events), "browser"), "bucket_id", "left")


def merged(deltas: DataFrame) -> DataFrame:
    """Counters from deltas of any number of batches."""
    return deltas.groupBy("bucket_id", "site_id").agg(*(F.sum(c).cast("long").alias(c) for c in COUNTERS))


def totals(counters: DataFrame, prefix: str = "") -> DataFrame:
    """Sums over the sites with a prefix (pushed to the scan); zeros if there is none."""
    return counters.where(F.col("site_id").startswith(prefix)).agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS[:3]))
