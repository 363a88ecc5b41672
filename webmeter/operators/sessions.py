"""Sessions in arrival order.

Batch form: one exchange on (site, visitor, lane of bots); the memo of repeated ids and the
session rule are windows over that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import session_id
from ..schema import SESSION_TIMEOUT_MS

BOT_LANES = 256


def assign(events: DataFrame, order: list[Column], timeout_ms: int = SESSION_TIMEOUT_MS) -> DataFrame:
    """Adds session_id and new_session to every human event, replays included.

    A first delivery opens a session if the visitor has none or the event is
    more than the timeout after the latest event so far; otherwise it joins the
    current one, late events too.  A replay gets the answer of its first
    delivery and changes nothing.  Bots get null and false; they share few
    visitors and need no order, so they are dealt over ``BOT_LANES`` lanes.
    """
    ms = F.floor(F.unix_micros("ts") / 1000)
    bot = F.col("is_bot")
    lane = F.when(bot, F.pmod(F.xxhash64("id"), F.lit(BOT_LANES))).otherwise(-1)
    own = events.withColumn("_lane", lane).repartition("site_id", "visitor_id", "_lane")
    replay = Window.partitionBy("site_id", "visitor_id", "_lane", "id").orderBy(*order)
    own = own.withColumn("_first", ~bot & (F.row_number().over(replay) == 1))
    visitor = Window.partitionBy("site_id", "visitor_id", "_lane").orderBy(*order)
    before = visitor.rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("_last", F.max(F.when(F.col("_first"), ms)).over(before))
    own = own.withColumn("_new", F.col("_first") & (F.col("_last").isNull() | (ms - F.col("_last") > timeout_ms)))
    opener = F.last(F.when(F.col("_new"), F.col("id")), ignorenulls=True).over(visitor.rowsBetween(Window.unboundedPreceding, 0))
    own = own.withColumn("_opener", F.when(F.col("_first"), opener))
    memo = Window.partitionBy("site_id", "visitor_id", "_lane", "id")
    own = own.withColumn("_opener", F.max("_opener").over(memo))
    out = own.withColumns({"session_id": F.when(~bot, session_id(F.col("site_id"), F.col("visitor_id"), F.col("_opener"))), "new_session": F.coalesce(~bot & (F.col("_opener") == F.col("id")), F.lit(False))})
    return out.drop("_first", "_last", "_new", "_opener", "_lane")


def summary(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of events taken in order of their own time (they merge when a late event bridges a gap)."""
    ms = F.timestamp_millis(F.floor(F.unix_micros("ts") / 1000))
    return events.where(~F.col("is_bot")).withColumn("_t", ms).groupBy("site_id", "visitor_id", F.session_window("_t", gap).alias("w")).agg(F.count(F.lit(1)).alias("events"), F.min("_t").alias("first_ts"), F.max("_t").alias("last_ts")).drop("w")
