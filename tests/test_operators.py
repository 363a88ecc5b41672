"""Sessions, claims, outcomes, reports: sequences with known answers."""

from __future__ import annotations

import random

import pytest
from compare import DATA
from pyspark.sql import Window
from pyspark.sql import functions as F

from webmeter.operators import audit, counters, dedupe, pipeline, reports, sessions
from webmeter.sources import generator, lines, topics, webevents

c = F.col


def session_rows(spark, events):
    """events: (site, visitor, id, minutes[, bot]) in order of arrival."""
    rows = [(i, s, v, e, int(m * 60_000), bool(b and b[0])) for i, (s, v, e, m, *b) in enumerate(events)]
    df = spark.createDataFrame(rows, "n int, site_id string, visitor_id string, id string, ms long, is_bot boolean").withColumn("ts", F.timestamp_millis(F.lit(1_790_000_000_000) + c("ms")))
    out = sessions.assign(df, [c("n")]).orderBy("n").collect()
    return [(r.session_id, r.new_session) for r in out]


def fold(events, timeout=30):
    """The rule, one event after the other."""
    state, memo, out = {}, {}, []
    for s, v, e, m, *b in events:
        if b and b[0]:
            out.append((None, False))
            continue
        k = (s, v)
        if (*k, e) not in memo:
            if k not in state or m - state[k][1] > timeout:
                state[k] = [e, m]
            else:
                state[k][1] = max(state[k][1], m)
            memo[(*k, e)] = state[k][0]
        out.append((memo[(*k, e)], memo[(*k, e)] == e))
    return out


@pytest.mark.parametrize(
    "minutes",
    [[0], [0, 10], [0, 30], [0, 30 + 1 / 60_000], [0, 20, 40, 60, 80], [0, 20, 5, 45], [0, 10, 18, 53, 56], [0, 10, 50]],
)
def test_session_rule(spark, minutes):
    events = [("s", "v", f"e{i}", m) for i, m in enumerate(minutes)]
    got, want = session_rows(spark, events), fold(events)
    assert [n for _, n in got] == [n for _, n in want]
    pairs = {(g, w) for (g, _), (w, _) in zip(got, want, strict=True)}
    assert len(pairs) == len({g for g, _ in pairs}) == len({w for _, w in pairs})


def test_sessions_at_random(spark):
    r = random.Random(5)
    for _ in range(6):
        events = [(r.choice("st"), r.choice("uvw"), f"e{r.randint(0, 25)}", r.randint(0, 200), r.random() < 0.1) for _ in range(60)]
        got, want = session_rows(spark, events), fold(events)
        names: dict = {}
        for (s, v, *_), (g, gn), (w, wn) in zip(events, got, want, strict=True):
            assert gn == wn and (g is None) == (w is None)
            if g is not None:
                assert names.setdefault((s, v, w), g) == g
        assert len(set(names.values())) == len(names)


def claims(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, site_id string, id string, owner string")
    return [r.claimed for r in dedupe.claim(df, c("owner"), [c("n")]).orderBy("n").collect()]


def test_claims(spark):
    assert claims(spark, [("s", "a", "m1"), ("s", "a", "m2"), ("s", "b", "m2"), ("s", "a", "m1")]) == ["m1", "m1", "m2", "m1"]
    assert claims(spark, [("s", "e1", "m1"), ("s", "e10", "m2"), ("s", "e", "m2")]) == ["m1", "m2", "m2"]
    assert claims(spark, [("s1", "e", "m1"), ("s2", "e", "m2"), ("a:b", "c", "m1"), ("a", "b:c", "m2")]) == ["m1", "m2", "m1", "m2"]
    assert claims(spark, []) == []


def outcome_counts(spark, deliveries, positions=()):
    """deliveries: (part, offset, id or None)."""
    df = spark.createDataFrame([(i, "s", p, o, e) for i, (p, o, e) in enumerate(deliveries)], "n int, site_id string, part int, offset long, id string").withColumns({"owner": F.concat_ws(":", "part", "offset"), "readable": c("id").isNotNull()})
    rows = dedupe.redelivered(df, [c("n")])
    live = c("readable") & ~c("again")
    ready = dedupe.claim(rows.where(live), c("owner"), [c("n")]).unionByName(rows.where(~live).withColumn("claimed", F.lit(None).cast("string")))
    stored = spark.createDataFrame(list(positions), "part int, offset long")
    return {r.outcome: r["count"] for r in dedupe.outcomes(ready, stored).groupBy("outcome").count().collect()}


def test_outcomes(spark):
    assert outcome_counts(spark, [(0, 0, "e1"), (0, 1, "e1"), (0, 2, None), (0, 3, "e2")]) == {"counted": 2, "duplicate": 1, "skipped": 1}
    batch = [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "d"), (0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (0, 3, "e")]
    assert outcome_counts(spark, batch) == {"counted": 5, "redelivered": 3}
    assert outcome_counts(spark, [(0, 0, "a"), (0, 1, "b")], [(0, 1)]) == {"replayed": 2}


def test_positions(spark):
    m = spark.createDataFrame([(0, 9), (0, 10), (0, 11), (1, 0)], "part int, offset long")
    p = spark.createDataFrame([(0, 10)], "part int, offset long")
    assert sorted(map(tuple, dedupe.not_yet_applied(m, p).select("part", "offset").collect())) == [(0, 11), (1, 0)]
    m = spark.createDataFrame([(0, 20), (1, 5), (2, 3)], "part int, offset long")
    p = spark.createDataFrame([(0, 10), (1, 8)], "part int, offset long")
    assert sorted(map(tuple, dedupe.advanced(m, p).collect())) == [(0, 20), (1, 8), (2, 3)]


def enriched(spark, rows):
    return spark.createDataFrame(rows, "site_id string, ts string, type string, is_bot boolean, device string, browser string, new_session boolean").withColumn("ts", c("ts").cast("timestamp"))


def test_counters(spark):
    rows = [
        ("site-42", "2026-09-30 11:00:10", "pageview", False, "mobile", "safari", True),
        ("site-42", "2026-09-30 11:00:59", "click", False, "desktop", "chrome", False),
        ("site-42", "2026-09-30 11:00:30", "pageview", True, "bot", "other", False),
        ("site-42", "2026-09-30 11:01:00", "pageview", False, "$where", "evil.browser", True),
        ("site-43", "2026-09-30 11:00:00", "pageview", True, "bot", "other", False),
    ]
    got = {r.bucket_id: r for r in counters.with_maps(enriched(spark, rows)).collect()}
    a = got["site-42|2026-09-30T11:00Z"]
    assert (a.pageviews, a.clicks, a.bot_events, a.sessions, a.devices, a.browsers) == (1, 1, 1, 1, {"mobile": 1, "desktop": 1}, {"safari": 1, "chrome": 1})
    assert got["site-42|2026-09-30T11:01Z"].devices == {"other": 1} and got["site-42|2026-09-30T11:01Z"].browsers == {"other": 1}
    b = got["site-43|2026-09-30T11:00Z"]
    assert (b.pageviews, b.clicks, b.bot_events, b.sessions, b.devices) == (0, 0, 1, 0, None)
    assert counters.minute_counters(enriched(spark, rows[:0])).count() == 0


def test_percentiles(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "v")
    assert [df.agg(reports.upper_rank_percentile("v", q)).first()[0] for q in (0.5, 0.95, 0.99, 1.0, 0.0)] == [50, 95, 99, 100, 1]
    assert df.where("v < 0").agg(reports.upper_rank_percentile("v", 0.5)).first()[0] == 0


def test_lag(spark):
    cases = [(0, 100, 40, 60), (0, 100, 100, 0), (0, 100, -1, 100), (30, 100, -1, 70), (30, 100, 10, 70), (0, 100, 150, 0), (0, 0, -1, 0)]
    df = spark.createDataFrame([x[:3] for x in cases], "first long, end long, committed long")
    assert sorted(r.lag for r in reports.lag(df).collect()) == sorted(x[3] for x in cases)


def test_histogram_quantile(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 1.5), ("a", 3.0), ("a", 99.0), ("b", None)], "g string, v double")
    h = reports.histogram(df, "v", [1.0, 2.0, 4.0], ["g"])
    assert [(r.le, r.n) for r in h.where("g = 'a'").orderBy("i").collect()] == [(1.0, 1), (2.0, 2), (4.0, 3), (None, 4)]
    assert reports.histogram_quantile(h, 0.5, ["g"]).first().value == 2.0
    assert reports.histogram_quantile(h, 0.99, ["g"]).first().value == 4.0


def test_audit_lines(spark):
    body = '{"id":"e1","site_id":"s","timestamp":"2026-01-01T00:00:00Z","type":"click"}'
    df = spark.createDataFrame([(f"2 10 {body}",), ("",), (f"2 x {body}",), ("2 3 {oops",), (None,)], "value string")
    assert [r.readable for r in lines.parse_lines(df).collect()] == [True, False, False, False, False]


def test_bucket_diff(spark):
    kind = "bucket_id string, pageviews long, clicks long, bot_events long"
    a = spark.createDataFrame([("x", 1, 0, 0), ("y", 2, 2, 2), ("z", 0, 1, 0)], kind)
    b = spark.createDataFrame([("x", 1, 0, 0), ("y", 1, 2, 3), ("w", 4, 0, 0)], kind)
    assert sorted(map(tuple, audit.bucket_diff(a, b).collect())) == [("w", -4, 0, 0), ("y", 1, 0, -1), ("z", 0, 1, 0)]


def test_generator(spark):
    df = generator.events(spark, 20_000, seed=7)
    shares = {r.kind: r["count"] / 20_000 for r in df.groupBy("kind").count().collect()}
    assert abs(shares["duplicate"] - 0.02) < 0.005 and abs(shares["invalid"] - 0.01) < 0.004
    assert df.exceptAll(generator.events(spark, 20_000, seed=7, slices=3)).count() == 0
    assert df.exceptAll(generator.events(spark, 20_000, seed=8)).count() > 0
    back = df.where("kind = 'duplicate'").selectExpr("min(seq - source_seq)", "max(seq - source_seq)").first()
    assert back[0] >= 1 and back[1] <= 128


def test_reasons_in_order(spark):
    rows = [(False, ["x"], 9_999_999_999, None), (True, ["x"], 9_999_999_999, None), (True, [], 9_999_999_999, None), (True, [], 0, None), (True, [], 3_600_000_000, "{}")]
    df = spark.createDataFrame(rows, "ok boolean, p array<string>, late long, value string")
    got = [r.r for r in df.select(pipeline.reason_of(c("ok"), c("p"), c("late"), c("value")).alias("r")).collect()]
    assert got == ["invalid_json", "invalid_event", "too_late", "encode_error", None]


def test_routed_messages(spark):
    body = '{"id":"e1","type":"click","site_id":"s","visitor_id":"v","url":"https://e.com/","user_agent":"curl/9","timestamp":"2026-03-01T10:00:00Z","received_at":"2026-03-01T%s:00Z"}'
    rows = [("raw", 0, i, "k", v) for i, v in enumerate([body % "10:00", body % "11:01", "{oops", None, "{}"])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string").withColumn("now", F.lit("2026-03-01 12:00:00").cast("timestamp"))
    got = {r.offset: r for r in pipeline.routed(df, "now").collect()}
    assert [got[i].reason for i in range(5)] == [None, "too_late", "invalid_json", "invalid_json", "invalid_event"]
    assert got[0].enriched.endswith('"browser":"other","device":"bot","is_bot":true}') and got[1].enriched is None
    dead = {r.source.offset: r for r in pipeline.dead_letters(pipeline.routed(df, "now"), "now").collect()}
    assert dead[1].problems == ["event is 1h1m0s late, more than the allowed 1h0m0s"] and dead[3].raw == "" and dead[2].raw == "{oops" and len(dead[4].problems) == 6
    poison = topics.poison(spark, "raw").withColumn("now", F.lit("2026-03-01 12:00:00").cast("timestamp"))
    assert sorted(r.reason for r in pipeline.routed(poison, "now").collect()) == ["invalid_event", "invalid_json"]


def test_server_columns(spark):
    df = spark.createDataFrame([("10.0.0.1", "", None), ("x", "agent", "2001-01-01 00:00:00")], "ip string, user_agent string, received_at string").withColumn("received_at", c("received_at").cast("timestamp"))
    now = F.lit("2026-03-01 12:00:00").cast("timestamp")
    got = pipeline.stamped(df, now, F.lit("192.0.2.77:9"), F.lit("header")).selectExpr("ip", "user_agent", "cast(received_at as string) as t").collect()
    assert [tuple(r) for r in got] == [("192.0.2.0", "header", "2026-03-01 12:00:00"), ("192.0.2.0", "agent", "2026-03-01 12:00:00")]


def test_offsets_equal_one_window(spark):
    web = webevents.web_events(spark, f"{DATA}/sf0.001")
    plain = web.withColumn("want", F.row_number().over(Window.partitionBy("part").orderBy(*webevents.arrival())) - 1)
    for slice_s in (7, 3600, 10**9):
        both = webevents.with_offsets(web, slice_s).select("id", "copy", "offset").join(plain, ["id", "copy"])
        assert both.count() == web.count() and both.where("offset <> want").count() == 0


def test_first_and_rest(spark):
    diff = spark.createDataFrame([(f"b{i:02}", i, 0, 0) for i in range(20)], "bucket_id string, pageviews long, clicks long, bot_events long")
    got = audit.first_and_rest(diff, 3).collect()
    assert [(r.bucket_id, r.remaining) for r in got] == [("b00", 17), ("b01", 17), ("b02", 17)]
    assert [r.remaining for r in audit.first_and_rest(diff.limit(2), 3).collect()] == [0, 0]


def test_load_report(spark):
    rows = [(1, 202, False, 1500), (1, 202, False, 2500), (1, 503, False, 9000), (1, None, False, 1), (1, 202, True, 1), (2, None, False, 5)]
    df = spark.createDataFrame(rows, "step int, status int, dropped boolean, latency_us long")
    got = {r.step: r for r in reports.load_summary(df, "step", F.lit(2)).collect()}
    assert tuple(got[1])[1:] == (5, 1, 1, 1.0, 2500, 9000, 9000, 9000, "202:2 503:1")
    assert tuple(got[2])[1:] == (1, 0, 1, 0.0, 0, 0, 0, 0, "")
    line = reports.step_line({x: c(x) for x in ("dropped", "errors", "codes", "p50", "p95", "p99", "max", "accepted_per_s")} | {"rate": c("step")})
    assert reports.load_summary(df, "step", F.lit(2)).where("step = 1").select(line).first()[0].split() == ["1", "1", "1", "1", "202:2", "503:1", "2.5", "ms", "9.0", "ms", "9.0", "ms", "9.0", "ms"]


def test_open_loop(spark):
    r = random.Random(2)
    rows = [(r.choice("ab"), r.randrange(1000), i, r.randrange(1, 90)) for i in range(200)]
    df = spark.createDataFrame(rows, "worker string, at long, seq long, cost long")
    free, want = {}, {}
    for w, at, seq, cost in sorted(rows, key=lambda x: (x[1], x[2])):
        free[w] = max(free.get(w, 0), at) + cost
        want[seq] = free[w] - at
    assert {x.seq: x.wait_us for x in reports.open_loop(df, "worker", "at", "cost").collect()} == want


def test_batch_metrics(spark):
    df = spark.createDataFrame([("a", 5, "ok"), ("a", 7, "error"), ("a", 2, "ok")], "consumer string, size long, result string")
    got = {(r.consumer, r.result): (r.batches, r.messages) for r in reports.batch_metrics(df, ["a", "b"]).collect()}
    assert got == {("a", "ok"): (2, 7), ("a", "error"): (1, 0), ("b", "ok"): (0, 0), ("b", "error"): (0, 0)}
    lags = spark.createDataFrame([(0, 4), (0, 9), (1, 2)], "partition int, lag long")
    assert {r.partition: r.lag for r in reports.top_lag(lags).collect()} == {"0": 9, "1": 2, "all": 9}
