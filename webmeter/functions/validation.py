"""Validation, lateness and rejection reasons as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MAX_FIELD_BYTES, MAX_FUTURE_SKEW_S, MAX_LATENESS_S, MAX_RAW_BYTES, MAX_URL_BYTES


def required(name: str, value: Column, limit: int) -> Column:
    text = F.coalesce(value, F.lit(""))
    return F.when(text == "", f"{name} is required").when(F.octet_length(text) > limit, f"{name} must be at most {limit} characters")


def absolute_http(url: Column) -> Column:
    """Scheme http or https (any case), a host, no control character, valid percent escapes in the host part."""
    return url.rlike(r"(?i)^https?://([^/?#]*@)?(\[[0-9a-f:.%]+\](:\d*)?|[^/?#@:\s\x00-\x1f\x7f%\[\]]+(:\d*)?|:\d+)([/?#][^\x00-\x1f\x7f]*)?$") & ~url.rlike(r"^[^?#]*%(?![0-9A-Fa-f]{2})")


def missing_time(ts: Column) -> Column:
    return ts.isNull() | (F.year(ts) <= 1)


def problems(id_: Column, site: Column, visitor: Column, type_: Column, url: Column, ts: Column, now: Column) -> Column:
    """All problems of an event in fixed order; an empty array if it is valid."""
    has_url = F.coalesce(url, F.lit("")) != ""
    found = F.array(
        required("id", id_, MAX_FIELD_BYTES),
        required("site_id", site, MAX_FIELD_BYTES),
        required("visitor_id", visitor, MAX_FIELD_BYTES),
        F.when(~F.coalesce(type_, F.lit("")).isin("pageview", "click"), 'type must be "pageview" or "click"'),
        required("url", url, MAX_URL_BYTES),
        F.when(has_url & ~absolute_http(url), "url must be an absolute http(s) URL"),
        F.when(missing_time(ts), "timestamp is required").when(ts > now + F.expr(f"INTERVAL {MAX_FUTURE_SKEW_S} SECONDS"), "timestamp is in the future"),
    )
    return F.filter(found, lambda p: p.isNotNull())


def valid(id_: Column, site: Column, visitor: Column, type_: Column, url: Column, ts: Column, now: Column) -> Column:
    """Whether there is no problem, as one plain condition (for filters in the hot path)."""
    size = lambda c, limit: F.octet_length(F.coalesce(c, F.lit(""))).between(1, limit)
    fields = size(id_, MAX_FIELD_BYTES) & size(site, MAX_FIELD_BYTES) & size(visitor, MAX_FIELD_BYTES)
    typed = F.coalesce(type_.isin("pageview", "click"), F.lit(False))
    return fields & typed & size(url, MAX_URL_BYTES) & absolute_http(url) & ~missing_time(ts) & (ts <= now + F.expr(f"INTERVAL {MAX_FUTURE_SKEW_S} SECONDS"))


def lateness_us(ts: Column, received: Column, now: Column) -> Column:
    reference = F.when(missing_time(received), now).otherwise(received)
    return F.unix_micros(reference) - F.unix_micros(ts)


def too_late(late_us: Column) -> Column:
    return late_us > MAX_LATENESS_S * 1_000_000


def lateness_text(late_us: Column) -> Column:
    """``event is 1h6m40s late, more than the allowed 1h0m0s``; seconds rounded half up."""
    s = F.floor((late_us + 500_000) / 1_000_000).cast("long")
    h, m = F.floor(s / 3600).cast("string"), F.floor(s % 3600 / 60).cast("string")
    return F.concat(F.lit("event is "), h, F.lit("h"), m, F.lit("m"), (s % 60).cast("string"), F.lit("s late, more than the allowed 1h0m0s"))


def dead_letter_raw(raw: Column) -> Column:
    """The message, cut after 8192 bytes (invalid UTF-8 replaced) with a mark."""
    cut = F.concat(F.make_valid_utf8(F.substring(raw.cast("binary"), 1, MAX_RAW_BYTES).cast("string")), F.lit("...(truncated)"))
    return F.when(F.octet_length(raw) > MAX_RAW_BYTES, cut).otherwise(raw)
