"""Row types and fixed limits of the event data model."""

from __future__ import annotations

from pyspark.sql import types as T

MAX_FUTURE_SKEW_S = 300
MAX_LATENESS_S = 3600
SESSION_TIMEOUT_MS = 30 * 60 * 1000
DEDUPE_TTL_MIN_S = 65 * 60
DEDUPE_TTL_S = 90 * 60
MAX_FIELD_BYTES = 128
MAX_URL_BYTES = 2048
MAX_RAW_BYTES = 8192
MAX_BODY_BYTES = 64 * 1024

RAW_FIELDS = ["id", "type", "site_id", "visitor_id", "url", "referrer", "user_agent", "timestamp", "ip", "received_at"]
ENRICHED_FIELDS = ["browser", "device", "is_bot", "processed_at", "session_id", "new_session"]
TIME_FIELDS = {"timestamp", "received_at"}

EVENT = T.StructType([T.StructField(f, T.TimestampType() if f in TIME_FIELDS else T.StringType()) for f in RAW_FIELDS])
ENRICHED = T.StructType(
    [
        *EVENT.fields,
        T.StructField("browser", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("is_bot", T.BooleanType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("new_session", T.BooleanType()),
    ]
)
MESSAGE = T.StructType([T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])

DEVICES = ["desktop", "mobile", "tablet"]
BROWSERS = ["chrome", "firefox", "safari", "edge", "opera"]
REASONS = ["invalid_json", "invalid_event", "too_late", "encode_error"]
OUTCOMES = ["counted", "duplicate", "redelivered", "replayed", "skipped"]
STATUS_CODES = [202, 400, 413, 422, 503]
