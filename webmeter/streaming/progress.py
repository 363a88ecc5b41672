"""Progress of streaming queries as rows: batch sizes, durations, lag, health."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import reports

BATCHES = "consumer string, batch long, size long, duration_ms long, dropped long, result string"


class ProgressLog(StreamingQueryListener):
    """Keeps one row a micro-batch, the latest ``kept`` of them, and running totals of all; a failed query is an error row."""

    def __init__(self, kept: int = 10_000) -> None:
        self.rows: deque[dict] = deque(maxlen=kept)
        self.totals: dict[tuple[str, str], int] = {}
        self.messages: dict[str, int] = {}
        self.names: dict[str, str] = {}

    def _add(self, row: dict) -> None:
        self.rows.append(row)
        who = row["query"]
        for result in ("ok", "error"):
            self.totals.setdefault((who, result), 0)
        self.totals[who, row["result"]] += 1
        # messages of a batch count only when it succeeded
        self.messages[who] = self.messages.get(who, 0) + (row["size"] if row["result"] == "ok" else 0)

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add({"query": p.name or str(p.id), "batch": p.batchId, "size": p.numInputRows, "duration_ms": dict(p.durationMs).get("triggerExecution", 0), "dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators), "result": "ok"})

    def onQueryIdle(self, event) -> None:
        """Nothing was read: no row."""

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._add({"query": self.names.get(str(event.id), str(event.id)), "batch": None, "size": 0, "duration_ms": 0, "dropped": 0, "result": "error"})

    def frame(self, spark: SparkSession) -> DataFrame:
        """The kept rows, for the same reports as stored batches."""
        return spark.createDataFrame([(r["query"], r["batch"], r["size"], r["duration_ms"], r["dropped"], r["result"]) for r in self.rows], BATCHES)

    def exposition(self) -> str:
        """Counters as text, one series a line; both results of a consumer are there from its first batch."""
        lines = [f'batches_total{{consumer="{who}",result="{result}"}} {n}' for (who, result), n in sorted(self.totals.items())]
        lines += [f'batch_messages_total{{consumer="{who}"}} {n}' for who, n in sorted(self.messages.items())]
        return "".join(f"{x}\n" for x in lines)


class LagTracker:
    """The lag that was measured last; a failed measurement keeps it (0 before the first one)."""

    def __init__(self) -> None:
        self.value = 0
        self.healthy = True

    def refresh(self, offsets: Callable[[], DataFrame]) -> int:
        """``offsets`` gives rows (first, end, committed) of the partitions."""
        try:
            self.value = reports.lag(offsets()).selectExpr("coalesce(sum(lag), 0)").first()[0]
            self.healthy = True
        except Exception:
            self.healthy = False
        return self.value


def health(spark: SparkSession) -> DataFrame:
    """One row a streaming query of the session that runs: name, status, message."""
    rows = [(q.name or str(q.id), "ok" if q.exception() is None else "error", q.status["message"]) for q in spark.streams.active]
    return spark.createDataFrame(rows, "consumer string, status string, message string")


def up(spark: SparkSession) -> int:
    """Streaming queries that run."""
    return len(spark.streams.active)


def runtime(spark: SparkSession) -> dict[str, int]:
    """Threads and heap bytes of the driver."""
    beans = spark._jvm.java.lang.management.ManagementFactory
    return {"threads": beans.getThreadMXBean().getThreadCount(), "heap_bytes": beans.getMemoryMXBean().getHeapMemoryUsage().getUsed()}
