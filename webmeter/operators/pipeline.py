"""From delivered events to accepted, enriched and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import agents, codec, net, validation
from ..schema import RAW_FIELDS


def judged(events: DataFrame, now: str = "received_at") -> DataFrame:
    """Adds problems, late_us and reason (null: accepted); the first reason that holds wins."""
    c = F.col
    found = validation.problems(c("id"), c("site_id"), c("visitor_id"), c("type"), c("url"), c("ts"), c(now))
    late = validation.lateness_us(c("ts"), c("received_at"), c(now))
    out = events.withColumns({"problems": found, "late_us": late})
    reason = F.when(F.size("problems") > 0, "invalid_event").when(validation.too_late(c("late_us")), "too_late")
    return out.withColumn("reason", reason)


def accepted(events: DataFrame, now: str = "received_at") -> DataFrame:
    """Valid events that are not too late; both tests are plain filters before any exchange."""
    c = F.col
    good = validation.valid(c("id"), c("site_id"), c("visitor_id"), c("type"), c("url"), c("ts"), c(now))
    return events.where(good).where(~validation.too_late(validation.lateness_us(c("ts"), c("received_at"), c(now))))


def enriched(events: DataFrame) -> DataFrame:
    """Adds browser, device and is_bot; bots stay in the stream."""
    return agents.classified(events)


def reason_of(readable: Column, problems: Column, late_us: Column, encoded: Column) -> Column:
    """Why a message is rejected (null: it is not); the first reason that holds wins."""
    wrong = F.when(~readable, "invalid_json").when(F.size(problems) > 0, "invalid_event").when(validation.too_late(late_us), "too_late")
    return wrong.when(encoded.isNull(), "encode_error")


def encoded(names: list[str], times: list[str]) -> Column:
    """Flat JSON of the named columns (``ts`` is written as ``timestamp``), empty strings and nulls left out."""
    one = lambda n: codec.rfc3339(F.col(n)) if n in times else F.col(n) if n == "is_bot" else F.nullif(F.col(n), F.lit(""))
    return codec.encode([one(n).alias("timestamp" if n == "ts" else n) for n in names])


def routed(messages: DataFrame, now: str) -> DataFrame:
    """Raw messages (topic, partition, offset, key, value) decoded, judged and encoded again.

    Adds the fields of the event, ``reason`` (null: accepted), ``problems`` and
    ``enriched`` (the value to publish; null for a rejected message).  A null
    value is not JSON.
    """
    c = F.col
    names = {f: "ts" if f == "timestamp" else f for f in RAW_FIELDS}
    rows = codec.decoded(messages, "value", "_got")
    rows = rows.withColumns({"_ok": c("_got.ok")} | {n: c(f"_got.{f}") for f, n in names.items()}).drop("_got")
    found = validation.problems(c("id"), c("site_id"), c("visitor_id"), c("type"), c("url"), c("ts"), c(now))
    rows = agents.classified(rows.withColumns({"_found": found, "_late": validation.lateness_us(c("ts"), c("received_at"), c(now))}))
    rows = rows.withColumn("_value", encoded(["id", "type", "site_id", "visitor_id", "url", "referrer", "user_agent", "ts", "ip", "received_at", "browser", "device", "is_bot"], ["ts", "received_at"]))
    # as a generator's output: a filter on the reason stays above it, and the encoding is not repeated for it
    rows = rows.select("*", F.explode(F.array(reason_of(c("_ok"), c("_found"), c("_late"), c("_value")))).alias("reason"))
    told = (
        F.when(c("reason") == "invalid_json", F.array(F.lit("invalid JSON")))
        .when(c("reason") == "invalid_event", c("_found"))
        .when(c("reason") == "too_late", F.array(validation.lateness_text(c("_late"))))
        .when(c("reason") == "encode_error", F.array(F.lit("cannot be encoded")))
    )
    return rows.withColumns({"problems": told, "enriched": F.when(c("reason").isNull(), c("_value"))}).drop("_ok", "_found", "_late", "_value")


def dead_letters(routed_messages: DataFrame, now: str) -> DataFrame:
    """The record of every rejected message: reason, problems, raw, source (topic, partition, offset), failed_at."""
    source = F.struct("topic", "partition", "offset")
    return routed_messages.where("reason is not null").select("reason", "problems", validation.dead_letter_raw(F.coalesce("value", F.lit(""))).alias("raw"), source.alias("source"), F.col(now).alias("failed_at"))


def stamped(events: DataFrame, now: Column, remote: Column, header_agent: Column) -> DataFrame:
    """Columns that belong to the server: time and truncated address replace what a client sent, an empty agent is the header's."""
    return events.withColumns({"received_at": now, "ip": net.anonymize(net.host(remote)), "user_agent": F.coalesce(F.nullif(F.col("user_agent"), F.lit("")), header_agent)})


def in_key_order(messages: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows of a key in one partition, key after key, in their order: for operators that take rows one after the other."""
    return messages.repartition(*keys).sortWithinPartitions(*keys, *order)
