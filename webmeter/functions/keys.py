"""Identity keys, hashes and time buckets as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(site: Column, visitor: Column, event: Column) -> Column:
    nul = F.lit("\x00")
    return F.sha2(F.concat(site, nul, visitor, nul, event), 256)


def session_id(site: Column, visitor: Column, first_event: Column) -> Column:
    return F.concat(F.lit("s_"), F.substring(_digest(site, visitor, first_event), 1, 16))


def event_key(site: Column, visitor: Column, event: Column) -> Column:
    return F.substring(_digest(site, visitor, event), 1, 32)


def partition_key(site: Column, visitor: Column) -> Column:
    return F.concat_ws("/", site, visitor)


def dedupe_key(site: Column, event: Column, prefix: str = "seen") -> Column:
    """Unambiguous text form of (site, event): the site's length in bytes comes first."""
    return F.concat_ws(":", F.lit(prefix), F.octet_length(site).cast("string"), site, event)


def owner(topic: Column, partition: Column, offset: Column) -> Column:
    return F.concat(topic, F.lit("/"), partition.cast("string"), F.lit(":"), offset.cast("string"))


def minute(ts: Column) -> Column:
    return F.date_trunc("MINUTE", ts)


def bucket_id(site: Column, ts: Column) -> Column:
    return F.concat(site, F.lit("|"), F.date_format(minute(ts), "yyyy-MM-dd'T'HH:mm'Z'"))


def known_or_other(value: Column, known: list[str]) -> Column:
    return F.when(value.isin(known), value).otherwise("other")
