"""Sessions as a stateful streaming operator."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.keys import session_id
from ..schema import MAX_LATENESS_S, SESSION_TIMEOUT_MS

#: Time after which a visitor's state may go: the timeout and the allowed lateness.
SESSION_TTL_MS = SESSION_TIMEOUT_MS + MAX_LATENESS_S * 1000

OUTPUT = T.StructType([T.StructField("site_id", T.StringType()), T.StructField("visitor_id", T.StringType()), T.StructField("id", T.StringType()), T.StructField("opener", T.StringType()), T.StructField("payload", T.StringType())])


class SessionProcessor(StatefulProcessor):
    """Keeps a visitor's current session (opener, latest millisecond) and the answers given to its events.

    Rows of one call are taken in the order of (received_us, offset), since an
    exchange does not keep the order of arrival.
    """

    def __init__(self, timeout_ms: int = SESSION_TIMEOUT_MS, ttl_ms: int | None = None):
        self.timeout_ms = timeout_ms
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", "opener string, last_ms long", self.ttl_ms)
        self.answers = handle.getMapState("answers", "id string", "opener string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.current.get() if self.current.exists() else None
        opener, last = (state[0], state[1]) if state else (None, None)
        seen: dict[str, str] = {}
        changed = False
        for r in sorted(rows, key=lambda r: (r.received_us, r.order)):
            if r.id not in seen:
                known = self.answers.getValue((r.id,)) if self.answers.containsKey((r.id,)) else None
                if known is None:
                    if last is None or r.ts_ms - last > self.timeout_ms:
                        opener, last = r.id, r.ts_ms
                    else:
                        last = max(last, r.ts_ms)
                    self.answers.updateValue((r.id,), (opener,))
                    changed = True
                seen[r.id] = opener if known is None else known[0]
            yield Row(site_id=key[0], visitor_id=key[1], id=r.id, opener=seen[r.id], payload=r.payload)
        # replays do not refresh the session
        if changed:
            self.current.update((opener, last))

    def close(self) -> None:
        pass


def assign(events: DataFrame, timeout_ms: int = SESSION_TIMEOUT_MS, ttl_ms: int | None = None) -> DataFrame:
    """Streaming form of the session rule for human events (id, site_id, visitor_id, ts, received_at, order, payload).

    A query that runs for ever gives ``ttl_ms`` (``SESSION_TTL_MS``: the timeout
    and the allowed lateness), after which idle visitors and answers are
    forgotten; the clock is then processing time, with which a query that
    drains its input and stops would not end.
    """
    rows = events.select("site_id", "visitor_id", "id", F.floor(F.unix_micros("ts") / 1000).cast("long").alias("ts_ms"), F.unix_micros("received_at").alias("received_us"), F.col("order").cast("long").alias("order"), "payload")
    out = rows.groupBy("site_id", "visitor_id").transformWithState(statefulProcessor=SessionProcessor(timeout_ms, ttl_ms), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")
    return out.select("site_id", "visitor_id", "id", "payload", session_id(F.col("site_id"), F.col("visitor_id"), F.col("opener")).alias("session_id"), (F.col("opener") == F.col("id")).alias("new_session"))
