"""Streaming forms: restart after a failure, replayed batches, configuration."""

from __future__ import annotations

import time

import pytest
from compare import DATA
from pyspark.sql import functions as F

from webmeter.functions.keys import bucket_id
from webmeter.operators import counters, pipeline
from webmeter.plans import catalog
from webmeter.sources import topics, webevents
from webmeter.streaming import queries, sinks, stateful
from webmeter.streaming import progress
from webmeter.streaming.progress import ProgressLog
from webmeter.streaming.retry import Cancelled, RetryPolicy

FOLDER = f"{DATA}/sf0.001"


def test_sessions_stream_equals_batch(spark):
    stream = queries.stream_sessions(spark, FOLDER)
    batch = catalog.sessions_assign(spark, FOLDER).select(stream.columns)
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_counters_survive_a_crash(spark, tmp_path):
    """The sink fails after it wrote a batch; after the restart every event counts once."""
    _, path = queries._staged(spark, FOLDER)
    deltas, cp = f"{tmp_path}/deltas", f"{tmp_path}/cp"

    def delta(batch):
        named = batch.groupBy("site_id", bucket_id(F.col("site_id"), F.col("ts")).alias("bucket_id"))
        return named.agg(*(x.alias(n) for n, x in counters.counter_columns(F.lit(False)).items()))

    write, failed = sinks.delta_sink(deltas, delta), []

    def crash_once(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("killed after the write")

    def run():
        rows = queries.unique_stream(pipeline.enriched(pipeline.accepted(spark.readStream.option("maxFilesPerTrigger", 4).schema(webevents.web_events(spark, FOLDER).schema).parquet(path))))
        rows.writeStream.foreachBatch(crash_once).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="killed after the write"):
        run()
    run()
    assert failed
    got = sinks.read_deltas(spark, deltas).select("bucket_id", "pageviews", "clicks", "bot_events")
    want = catalog.audit_totals(spark, FOLDER)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    sinks.compact(spark, deltas, f"{tmp_path}/compact")
    assert spark.read.parquet(f"{tmp_path}/compact").count() == got.count()


def test_short_ttl_is_refused(spark):
    with pytest.raises(ValueError, match="at least"):
        queries.unique_stream(spark.readStream.format("rate").load(), 60)


def test_topics(spark, tmp_path):
    folder = f"{tmp_path}/topic"
    assert not topics.exists(spark, folder)
    topics.create(spark, folder)
    assert topics.exists(spark, folder)
    events = webevents.with_offsets(webevents.web_events(spark, FOLDER))
    messages = topics.keyed(events, F.to_json(F.struct("id")), "raw-events")
    topics.publish(messages, folder)
    q = topics.scan(spark, folder).writeStream.format("memory").queryName("scanned").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("scanned").count() == events.count()
    topics.delete(spark, folder)
    assert not topics.exists(spark, folder)


def test_reports_round_trip(spark, tmp_path):
    report = spark.createDataFrame([("r1", [(1, 2)])], "run string, steps array<struct<rate:int,n:int>>")
    topics.write_report(report, f"{tmp_path}/report")
    assert topics.read_report(spark, f"{tmp_path}/report", "run string, steps array<struct<rate:int,n:int>>").collect() == report.collect()


def test_progress_rows(spark):
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        queries.stream_scan(spark, FOLDER).count()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(log)
    assert sum(r["size"] for r in log.rows) == webevents.web_events(spark, FOLDER).count()
    assert sum(log.messages.values()) == sum(r["size"] for r in log.rows)
    lines = log.exposition().splitlines()
    assert any('result="error"} 0' in x for x in lines) and any('result="ok"}' in x for x in lines)
    assert log.frame(spark).count() == len(log.rows)


def test_failed_batches_are_counted(spark, tmp_path):
    """A failed query is an error row; its messages do not count."""
    log = ProgressLog(kept=3)

    class Event:
        id, name, exception = "q1", "broken", "boom"

    log.onQueryStarted(Event)
    log.onQueryTerminated(Event)
    assert list(log.rows)[0]["result"] == "error" and log.totals == {("broken", "ok"): 0, ("broken", "error"): 1} and log.messages == {"broken": 0}
    for _ in range(5):
        log.onQueryTerminated(Event)
    assert len(log.rows) == 3 and log.totals["broken", "error"] == 6


def test_retry():
    calls = []

    def fails(times):
        def work():
            calls.append(1)
            if len(calls) <= times:
                raise OSError("down")

        return work

    RetryPolicy(5, 0.001).run("write", fails(3))
    assert len(calls) == 4
    calls.clear()
    with pytest.raises(RuntimeError, match="after 2 attempts"):
        RetryPolicy(2, 0.001).run("write", fails(9))
    calls.clear()
    policy = RetryPolicy(5, 60)
    policy.cancelled.set()
    with pytest.raises(Cancelled):
        policy.run("write", fails(9))
    assert len(calls) == 1


def test_lag_is_kept_on_error(spark):
    tracker = progress.LagTracker()
    offsets = spark.createDataFrame([(0, 100, 40), (0, 50, -1)], "first long, end long, committed long")

    def broken():
        raise OSError("no broker")

    assert tracker.refresh(broken) == 0 and not tracker.healthy
    assert tracker.refresh(lambda: offsets) == 110 and tracker.healthy
    assert tracker.refresh(broken) == 110


def test_health_and_console(spark):
    assert progress.runtime(spark)["threads"] > 0 and progress.runtime(spark)["heap_bytes"] > 0
    rate = spark.readStream.format("rate").load().selectExpr("'t' as topic", "cast(value as string) as key", "'x' as value")
    before = progress.up(spark)
    q = topics.log_sink(rate).queryName("printer").start()
    try:
        assert progress.up(spark) == before + 1
        assert ("printer", "ok") in {(r.consumer, r.status) for r in progress.health(spark).collect()}
    finally:
        q.stop()


def test_replays_leave_the_session_alone():
    """The state is written for new events only, so that a replay does not refresh its life."""
    from pyspark.sql import Row

    class Value(dict):
        writes = 0
        exists = lambda self: "v" in self
        get = lambda self: self["v"]

        def update(self, v):
            self["v"] = v
            self.writes += 1

    class Answers(dict):
        containsKey = dict.__contains__  # noqa: N815
        getValue = dict.__getitem__  # noqa: N815
        updateValue = dict.__setitem__  # noqa: N815

    p = stateful.SessionProcessor()
    p.current, p.answers = Value(), Answers()
    call = lambda *ids: [r.opener for r in p.handleInputRows(("s", "v"), iter([Row(id=i, ts_ms=0, received_us=0, order=n, payload="") for n, i in enumerate(ids)]), None)]
    assert call("a", "a", "b") == ["a", "a", "a"] and p.current.writes == 1
    assert call("b", "a") == ["a", "a"] and p.current.writes == 1


def test_sessions_with_a_ttl(spark, tmp_path):
    """A running query whose state expires gives the same sessions; it is stopped by hand."""
    _, path = queries._staged(spark, FOLDER, 1)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", queries.ROCKSDB)
    try:
        humans = pipeline.enriched(pipeline.accepted(queries._stream(spark, FOLDER, path))).where("not is_bot")
        out = stateful.assign(humans.withColumns({"order": F.col("event_id") * 2 + F.col("copy"), "payload": F.col("copy").cast("string")}), ttl_ms=stateful.SESSION_TTL_MS)
        q = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="2 seconds").start()
        try:
            want = catalog.sessions_assign(spark, FOLDER).select("id", "session_id", "new_session")
            n, end = want.count(), time.time() + 90
            while sum(p["numInputRows"] for p in q.recentProgress) == 0 and time.time() < end:
                time.sleep(0.5)
            time.sleep(2)
        finally:
            q.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = spark.read.schema("id string, session_id string, new_session boolean").parquet(f"{tmp_path}/out")
    assert got.count() == n and got.exceptAll(want).count() == 0
