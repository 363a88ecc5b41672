"""The registered queries: each operator over the whole derived event table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import agents, codec, keys, net, validation
from ..operators import audit, counters, dedupe, pipeline, reports, sessions
from ..schema import MAX_BODY_BYTES, OUTCOMES, REASONS, STATUS_CODES
from ..sources import generator, lines, topics, webevents
from ..streaming import queries as streams
from ..streaming import sinks

c = F.col
TEXT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def _web(spark: SparkSession, d: str) -> DataFrame:
    return webevents.web_events(spark, d)


def _arrival() -> list:
    return [c("received_at"), c("part"), c("event_id"), c("copy")]


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.enriched(pipeline.accepted(_web(spark, d)))


def _sessioned(spark: SparkSession, d: str) -> DataFrame:
    return sessions.assign(_enriched(spark, d), webevents.arrival())


def _counted(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.first_deliveries(_sessioned(spark, d), _arrival())


def _unique(spark: SparkSession, d: str) -> DataFrame:
    """Counted events without sessions: one exchange."""
    return dedupe.first_deliveries(_enriched(spark, d), _arrival())


# counters


def minute_counters(spark: SparkSession, d: str) -> DataFrame:
    return counters.minute_counters(_counted(spark, d)).drop("minute").orderBy("bucket_id")


def breakdown_devices(spark: SparkSession, d: str) -> DataFrame:
    return counters.devices(_unique(spark, d))


def breakdown_browsers(spark: SparkSession, d: str) -> DataFrame:
    return counters.browsers(_unique(spark, d))


def bot_events(spark: SparkSession, d: str) -> DataFrame:
    return _unique(spark, d).where("is_bot").groupBy("site_id").agg(F.count(F.lit(1)).alias("bot_events"))


def sessions_opened(spark: SparkSession, d: str) -> DataFrame:
    return _counted(spark, d).where("new_session").groupBy(keys.bucket_id(c("site_id"), c("ts")).alias("bucket_id")).agg(F.count(F.lit(1)).alias("sessions"))


def minute_counters_from_deltas(spark: SparkSession, d: str) -> DataFrame:
    """Deltas of four batches, then their sum."""
    rows = _counted(spark, d).withColumn("batch", c("event_id") % 4)
    delta = rows.groupBy("batch", "site_id", keys.bucket_id(c("site_id"), c("ts")).alias("bucket_id")).agg(*(x.alias(n) for n, x in counters.counter_columns().items()))
    return counters.merged(delta)


def totals_by_prefix(spark: SparkSession, d: str) -> DataFrame:
    base = counters.minute_counters(_unique(spark, d).withColumn("new_session", F.lit(False)))
    out = None
    for p in ("site-", "site-1", "none"):
        t = counters.totals(base, p).select(F.lit(p).alias("prefix"), "*")
        out = t if out is None else out.unionByName(t)
    return out


def latest_minutes(spark: SparkSession, d: str) -> DataFrame:
    rows = counters.minute_counters(_unique(spark, d).withColumn("new_session", F.lit(False)))
    return rows.orderBy(c("minute").desc(), "site_id").limit(10).select("bucket_id", "pageviews", "clicks", "bot_events")


def bucket_count(spark: SparkSession, d: str) -> DataFrame:
    return _unique(spark, d).select(keys.bucket_id(c("site_id"), c("ts")).alias("b")).distinct().agg(F.count(F.lit(1)).alias("documents"))


def bucket_id(spark: SparkSession, d: str) -> DataFrame:
    return _web(spark, d).select("id", "copy", keys.bucket_id(c("site_id"), c("ts")).alias("bucket_id"))


# sessions


def sessions_assign(spark: SparkSession, d: str) -> DataFrame:
    return _sessioned(spark, d).where("not is_bot").select("id", "copy", "site_id", "visitor_id", "session_id", "new_session")


def sessions_replay(spark: SparkSession, d: str) -> DataFrame:
    """Re-sent events with the number of distinct answers they got (always one)."""
    return _sessioned(spark, d).where("not is_bot").groupBy("site_id", "visitor_id", "id").agg(F.count(F.lit(1)).alias("deliveries"), F.count_distinct("session_id", "new_session").alias("answers")).where("deliveries > 1")


def session_summary(spark: SparkSession, d: str) -> DataFrame:
    return sessions.summary(_unique(spark, d)).select("site_id", "visitor_id", "events", F.date_format("first_ts", TEXT_TIME).alias("first_ts"), F.date_format("last_ts", TEXT_TIME).alias("last_ts"))


def active_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The ten sessions with the latest events."""
    rows = _sessioned(spark, d).where("not is_bot").groupBy("session_id", "site_id", "visitor_id").agg(F.max("ts").alias("last"))
    return rows.orderBy(c("last").desc(), "session_id").limit(10).select("session_id", "site_id", "visitor_id", F.date_format("last", TEXT_TIME).alias("last_ts"))


def session_id_hash(spark: SparkSession, d: str) -> DataFrame:
    return _web(spark, d).where("copy = 0").select("id", keys.session_id(c("site_id"), c("visitor_id"), c("id")).alias("session_id"), keys.event_key(c("site_id"), c("visitor_id"), c("id")).alias("event_key"))


# keys and functions


def partition_key(spark: SparkSession, d: str) -> DataFrame:
    return _web(spark, d).select("id", "copy", keys.partition_key(c("site_id"), c("visitor_id")).alias("key"))


def dedupe_key(spark: SparkSession, d: str) -> DataFrame:
    return _web(spark, d).select("id", "copy", keys.dedupe_key(c("site_id"), c("id")).alias("key"))


def dedupe_owner(spark: SparkSession, d: str) -> DataFrame:
    rows = webevents.with_offsets(_web(spark, d))
    return rows.select("id", "copy", keys.owner(F.lit("enriched-events"), c("part"), c("offset")).alias("owner"))


def ua_parse(spark: SparkSession, d: str) -> DataFrame:
    return agents.classified(_web(spark, d)).select("id", "copy", "browser", "device", "is_bot")


def ip_anonymize(spark: SparkSession, d: str) -> DataFrame:
    """Client address from host:port, truncated; some are IPv6 (mapped, with a zone), some unreadable."""
    e, u = c("event_id"), c("user_id")
    v4 = F.concat(F.lit("198."), u % 256, F.lit("."), e % 256, F.lit("."), e * 7 % 256, F.lit(":443"))
    hexed = F.lower(F.hex(e % 4000 + 1))
    remote = (
        F.when(e % 10 == 3, F.concat(F.lit("[2001:db8:"), hexed, F.lit(":1a:2b:3c:4d:5e]:80")))
        .when(e % 10 == 4, F.lit("no address"))
        .when(e % 10 == 5, F.concat(F.lit("[::ffff:192.0.2."), e % 256, F.lit("]:81")))
        .when(e % 10 == 6, F.concat(F.lit("[fe80::"), hexed, F.lit("%lan]:82")))
        .when(e % 10 == 7, F.concat(F.lit("["), hexed, F.lit("::1::2]:83")))
        .otherwise(v4)
    )
    return _web(spark, d).where("copy = 0").select("id", net.anonymize(net.host(remote)).alias("ip"))


def lateness(spark: SparkSession, d: str) -> DataFrame:
    late = validation.lateness_us(c("ts"), c("received_at"), c("received_at"))
    return _web(spark, d).select("id", "copy", (late / 1_000_000).cast("long").alias("late_s"), validation.too_late(late).alias("too_late"))


# rejection


def _mutated(spark: SparkSession, d: str) -> DataFrame:
    """Web events with one defect each, by event_id modulo 13."""
    m = c("event_id") % 13
    blank = lambda k, col: F.when(m == k, F.lit("")).otherwise(c(col))
    return _web(spark, d).where("copy = 0").select(
        "event_id",
        F.when(m == 1, "").when(m == 2, F.repeat(F.lit("x"), 129)).otherwise(c("id")).alias("id"),
        blank(3, "site_id").alias("site_id"),
        blank(4, "visitor_id").alias("visitor_id"),
        "type",
        F.when(m == 5, "").when(m == 6, "/page/7").when(m == 7, "ftp://files.example/x").when(m == 8, F.concat(F.lit("https://e.com/"), F.repeat(F.lit("y"), 2100))).when(m == 9, "http://:80").otherwise(c("url")).alias("url"),
        F.when(m == 10, F.lit(None)).otherwise(c("ts")).alias("ts"),
        "received_at",
    )


def validate_problems(spark: SparkSession, d: str) -> DataFrame:
    found = validation.problems(c("id"), c("site_id"), c("visitor_id"), c("type"), c("url"), c("ts"), c("received_at"))
    return _mutated(spark, d).select("event_id", F.array_join(found, "; ").alias("problems"))


def too_late(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.judged(_web(spark, d)).where("reason = 'too_late'").select("id", "copy", (c("late_us") / 1_000_000).cast("long").alias("late_s"))


def _spread(rows: DataFrame) -> DataFrame:
    """Deals rows out evenly: by their bytes they would go to a few tasks, and what is made of them costs far more than their bytes."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), "event_id")


def _messages(spark: SparkSession, d: str, offsets: bool = True) -> DataFrame:
    """Raw messages: JSON of every event, with defects by event_id modulo 23, and two poison messages."""
    rows = _web(spark, d)
    rows = _spread(webevents.with_offsets(rows) if offsets else rows.withColumn("offset", F.lit(0).cast("long")))
    good = pipeline.encoded(["id", "type", "site_id", "visitor_id", "url", "user_agent", "ts", "received_at"], ["ts", "received_at"])
    m = c("event_id") % 23
    value = (
        F.when(m == 2, "{oops")
        .when(m == 5, "[1,2,3]")
        .when(m == 7, "")
        .when(m == 11, "{}")
        .when(m == 13, "null")
        .when(m == 17, F.concat(F.lit("{"), F.repeat(F.lit("w"), 9000)))
        .when(m == 19, F.concat(F.lit('{"extra":[1,{"a":2}],'), F.expr("substring(g, 2)")))
        .when(m == 21, F.concat(c("g"), F.lit(" tail")))
        .otherwise(c("g"))
    )
    rows = rows.withColumn("g", good).select(F.lit("raw-events").alias("topic"), c("part").alias("partition"), "offset", keys.partition_key(c("site_id"), c("visitor_id")).alias("key"), value.alias("value"), c("received_at").alias("now"))
    return rows.unionByName(topics.poison(spark, "raw-events").withColumn("now", F.lit("2024-01-01 00:00:00").cast("timestamp")))


def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    rows = pipeline.dead_letters(pipeline.routed(_messages(spark, d), "now"), "now")
    return rows.select("reason", F.array_join("problems", "; ").alias("problems"), F.md5("raw").alias("raw_md5"), "source.topic", "source.partition", "source.offset", F.date_format("failed_at", TEXT_TIME).alias("failed_at"))


def dead_letters_by_reason(spark: SparkSession, d: str) -> DataFrame:
    rows = pipeline.routed(_messages(spark, d, offsets=False), "now")
    return reports.zero_filled(rows.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n")), "reason", REASONS)


def process_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages to publish after processing: topic, key and digest of the value."""
    rows = pipeline.routed(_messages(spark, d), "now").where("reason is null")
    return rows.select(F.lit("enriched-events").alias("topic"), "key", "partition", "offset", F.md5("enriched").alias("value_md5"))


def dead_letter_raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw messages of growing length, cut after 8192 bytes."""
    raw = F.repeat(c("user_agent"), (c("event_id") % 120).cast("int"))
    return _web(spark, d).where("copy = 0").select("id", F.md5(validation.dead_letter_raw(raw)).alias("raw_md5"), F.length(validation.dead_letter_raw(raw)).cast("long").alias("n"))


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    """Request bodies: JSON of the event, one in eight of them defective."""
    m = c("event_id") % 16
    time = codec.rfc3339(c("ts"))
    good = codec.encode([c("id"), c("type"), c("site_id"), c("visitor_id"), c("url"), F.nullif("user_agent", F.lit("")).alias("user_agent"), time.alias("timestamp")])
    body = (
        F.when(m == 3, "{oops")
        .when(m == 2, F.concat(c("g"), F.lit(" tail")))
        .when(m == 4, F.replace(c("g"), F.lit('"site_id"'), F.lit('"Site_ID"')))
        .when(m == 5, F.concat(F.substring(good, 1, 1), F.lit('"extra":1,'), F.expr("substring(g, 2)")))
        .when(m == 7, F.lit('{"id":"a"}'))
        .when(m == 9, F.concat(F.lit('{"pad":"'), F.repeat(F.lit("z"), 66000), F.lit('"}')))
        .when(m == 11, F.lit("[1,2,3]"))
        .when(m == 12, F.lit("null"))
        .when(m == 13, F.lit('{"id":5}'))
        .otherwise(c("g"))
    )
    rows = _spread(_web(spark, d).where("copy = 0")).withColumn("g", good)
    return rows.select("event_id", "id", "type", "ts", "received_at", body.alias("body"))


def _status(spark: SparkSession, d: str) -> DataFrame:
    """Status of each request; publishing fails for some that are valid."""
    rows = codec.decoded(_bodies(spark, d).select("event_id", "received_at", "body"), "body", "e", strict=True)
    found = validation.problems(c("e.id"), c("e.site_id"), c("e.visitor_id"), c("e.type"), c("e.url"), c("e.timestamp"), c("received_at"))
    published = c("event_id") % 50 != 21
    code = F.when(F.octet_length("body") > MAX_BODY_BYTES, 413).when(~c("e.ok"), 400).when(F.size(found) > 0, 422).when(~published, 503).otherwise(202)
    return rows.select("event_id", code.alias("code"))


def collect_status(spark: SparkSession, d: str) -> DataFrame:
    return reports.zero_filled(_status(spark, d).groupBy("code").agg(F.count(F.lit(1)).alias("n")), "code", STATUS_CODES)


def decode_json(spark: SparkSession, d: str) -> DataFrame:
    rows = codec.decoded(_bodies(spark, d).select("event_id", "body"), "body", "e")
    return rows.select("event_id", "e.ok", F.when(c("e.ok"), c("e.id")).alias("id"), F.when(c("e.ok"), c("e.site_id")).alias("site_id"))


def decode_strict(spark: SparkSession, d: str) -> DataFrame:
    return codec.decoded(_bodies(spark, d).select("event_id", "body"), "body", "e", strict=True).select("event_id", "e.ok")


def collect_stamp(spark: SparkSession, d: str) -> DataFrame:
    """Server-owned columns: a client's address and time are overwritten, an empty agent is taken from the header."""
    sent = codec.encode([c("id"), F.nullif("user_agent", F.lit("")).alias("user_agent"), F.lit("10.9.8.7").alias("ip"), F.lit("2001-02-03T04:05:06Z").alias("received_at")])
    got = codec.decode_strict(c("body"))
    rows = _web(spark, d).where("copy = 0").select("event_id", "user_id", "part", c("received_at").alias("now"), sent.alias("body"))
    rows = rows.select("event_id", "user_id", "part", "now", *(got[f].alias(f) for f in ("id", "user_agent", "ip", "received_at"))).withColumn("sent_ip", c("ip"))
    remote = F.concat(F.lit("198.51."), c("user_id") % 256, F.lit("."), c("event_id") % 256, F.lit(":8080"))
    out = pipeline.stamped(rows, c("now"), remote, F.concat(F.lit("header/"), c("part")))
    return out.select("id", "user_agent", "sent_ip", "ip", F.date_format("received_at", TEXT_TIME).alias("received_at"))


def encode_enriched(spark: SparkSession, d: str) -> DataFrame:
    rows = _enriched(spark, d)
    body = codec.encode([c("id"), c("type"), c("site_id"), c("visitor_id"), c("url"), F.nullif("user_agent", F.lit("")).alias("user_agent"), codec.rfc3339(c("ts")).alias("timestamp"), c("browser"), c("device"), c("is_bot")])
    return rows.select("id", "copy", body.alias("value"))


def decode_enriched(spark: SparkSession, d: str) -> DataFrame:
    m = c("event_id") % 11
    body = codec.encode([F.when(m != 2, c("id")).alias("id"), F.when(m != 3, c("site_id")).alias("site_id"), F.when(m != 4, codec.rfc3339(c("ts"))).alias("timestamp"), c("type")])
    rows = _web(spark, d).where("copy = 0").select("event_id", codec.decode_enriched(F.when(m == 5, "{oops").otherwise(body)).alias("e"))
    return rows.select("event_id", c("e").isNotNull().alias("readable"), c("e.id").alias("id"))


# deliveries


def _deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Enriched messages with offsets; every eleventh position is delivered twice, every thirteenth unreadable."""
    rows = webevents.with_offsets(_enriched(spark, d)).withColumn("owner", keys.owner(F.lit("enriched-events"), c("part"), c("offset")))
    rows = rows.withColumn("attempt", F.explode(F.when(c("offset") % 11 == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.withColumn("readable", c("offset") % 13 != 6)


def _positions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p, 20 * p) for p in range(5)], "part int, offset long")


def redelivered(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.redelivered(_deliveries(spark, d), [c("attempt")]).groupBy("part").agg(F.count_if("again").alias("redelivered"), F.count(F.lit(1)).alias("deliveries"))


def dedupe_claim(spark: SparkSession, d: str) -> DataFrame:
    rows = webevents.with_offsets(_enriched(spark, d))
    owner = keys.owner(F.lit("enriched-events"), c("part"), c("offset"))
    return dedupe.claim(rows, owner, _arrival()).select("id", "copy", "claimed")


def dedupe_first(spark: SparkSession, d: str) -> DataFrame:
    return _unique(spark, d).select("site_id", "id", "copy")


def not_yet_applied(spark: SparkSession, d: str) -> DataFrame:
    rows = webevents.with_offsets(_enriched(spark, d))
    return dedupe.not_yet_applied(rows, _positions(spark)).select("id", "copy", "part", c("offset").cast("long").alias("offset"))


def positions_after_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = webevents.with_offsets(_enriched(spark, d))
    return dedupe.advanced(rows, _positions(spark)).select("part", c("offset").cast("long").alias("offset"))


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = dedupe.redelivered(_deliveries(spark, d), [c("attempt")])
    readable = c("readable") & ~c("again")
    first = dedupe.claim(rows.where(readable), c("owner"), [*_arrival(), c("attempt")])
    rest = rows.where(~readable).withColumn("claimed", F.lit(None).cast("string"))
    return dedupe.outcomes(first.unionByName(rest), _positions(spark))


def batch_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return reports.zero_filled(_outcomes(spark, d).groupBy("outcome").agg(F.count(F.lit(1)).alias("n")), "outcome", OUTCOMES)


def route_outputs(spark: SparkSession, d: str) -> DataFrame:
    return streams.route_outputs(spark, d)


# audit


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Audit lines of the enriched topic; every 17th is broken."""
    rows = webevents.with_offsets(_enriched(spark, d))
    body = codec.encode([c("id"), c("type"), c("site_id"), c("visitor_id"), codec.rfc3339(c("ts")).alias("timestamp"), c("is_bot")])
    line = F.concat_ws(" ", c("part").cast("string"), c("offset").cast("string"), body)
    m = c("offset") % 17
    return rows.select(F.when(m == 5, "").when(m == 6, F.concat(F.lit("2 x "), body)).when(m == 7, F.lit("2 3 {oops")).otherwise(line).alias("value"))


def audit_parse_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.parse_lines(_lines(spark, d)).groupBy("readable").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(c("readable"), c("offset"))), F.lit(0)).cast("long").alias("offsets"))


def _positioned(spark: SparkSession, d: str) -> DataFrame:
    return webevents.with_offsets(_enriched(spark, d))


def audit_copies(spark: SparkSession, d: str) -> DataFrame:
    rows = audit.copies(_positioned(spark, d))
    return rows.where("copies > 1").select("site_id", "id", "copies", "partitions", "positions")


def audit_totals(spark: SparkSession, d: str) -> DataFrame:
    base = counters.minute_counters(_unique(spark, d).withColumn("new_session", F.lit(False)))
    return base.select("bucket_id", "pageviews", "clicks", "bot_events")


def _stored(unique: DataFrame) -> DataFrame:
    """Stored counters with planted faults: buckets lost, doubled or unknown, by a digit of their digest."""
    h = F.substring(F.md5("bucket_id"), 1, 1)
    kept = unique.where(h != "0").withColumn("pageviews", c("pageviews") + F.when(h == "1", 1).otherwise(0))
    ghost = unique.where(h == "2").select(F.concat(F.lit("ghost-"), c("bucket_id")).alias("bucket_id"), "pageviews", "clicks", "bot_events")
    return kept.select("bucket_id", "pageviews", "clicks", "bot_events").unionByName(ghost)


def audit_bucket_diff(spark: SparkSession, d: str) -> DataFrame:
    unique = audit_totals(spark, d)
    return audit.bucket_diff(_stored(unique), unique).orderBy("bucket_id")


def audit_copies_in_diff(spark: SparkSession, d: str) -> DataFrame:
    """Differing buckets, a row for each event in several copies that they contain (one row with blanks if there is none)."""
    diff = audit_bucket_diff(spark, d).select("bucket_id")
    multi = audit.copies(_positioned(spark, d)).where("copies > 1").select("bucket_id", "id", "positions")
    blank = F.lit("")
    return diff.join(multi, "bucket_id", "left").select("bucket_id", F.coalesce("id", blank).alias("id"), F.coalesce("positions", blank).alias("positions"))


def audit_verdict(spark: SparkSession, d: str) -> DataFrame:
    unique = audit_totals(spark, d)
    stored = _stored(unique)
    total = lambda df, p: df.agg(*(F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(f"{p}_{x}") for x in audit.TOTALS))
    one = total(unique, "u").crossJoin(total(stored, "s"))  # one row each
    u, s = [c(f"u_{x}") for x in audit.TOTALS], [c(f"s_{x}") for x in audit.TOTALS]
    off = [c("u_pageviews") + 1, *u[1:]]
    cases = F.array(*(F.struct(F.lit(n).alias("what"), audit.verdict(a, b, z).alias("verdict")) for n, a, b, z in (("all equal", u, u, u), ("stored differs", u, u, s), ("log differs", off, u, u), ("both differ", off, u, s))))
    return one.select(F.inline(cases))


# load report


def _requests(spark: SparkSession, d: str) -> DataFrame:
    """Requests with status and latency, from the derived events."""
    web = _web(spark, d)
    status = F.when(c("event_id") % 100 == 99, 503).when(~c("type").isin("pageview", "click"), 422).otherwise(202)
    late = validation.too_late(validation.lateness_us(c("ts"), c("received_at"), c("received_at")))
    return web.select("id", "type", "copy", "part", agents.is_bot(c("user_agent")).alias("bot"), late.alias("too_late"), status.alias("status"), (c("event_id") * 7919 % 1000 + 1).alias("latency_us"), "received_at", "event_id", "user_id")


def expected_totals(spark: SparkSession, d: str) -> DataFrame:
    acked = _requests(spark, d).where("status = 202 and id <> ''").groupBy("id").agg(F.max_by(F.struct("type", "bot", "too_late"), F.struct("received_at", "copy")).alias("a")).select("a.*")
    live = ~c("too_late")
    return acked.agg(F.count_if(live & ~c("bot") & (c("type") != "click")).alias("pageviews"), F.count_if(live & ~c("bot") & (c("type") == "click")).alias("clicks"), F.count_if(live & c("bot")).alias("bots"), F.count_if("too_late").alias("too_late"))


def latency_percentiles(spark: SparkSession, d: str) -> DataFrame:
    p = reports.upper_rank_percentile
    return _requests(spark, d).groupBy(c("part").alias("step")).agg(F.count(F.lit(1)).alias("scheduled"), F.count_if(c("status") >= 500).alias("errors"), p("latency_us", 0.5).alias("p50"), p("latency_us", 0.95).alias("p95"), p("latency_us", 0.99).alias("p99"), F.max("latency_us").alias("max"))


def step_codes(spark: SparkSession, d: str) -> DataFrame:
    counts = _requests(spark, d).groupBy("part", c("status").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(c("part").alias("step")).agg(reports.codes_text(F.collect_list(F.struct("code", "n"))).alias("codes"))


def verify_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts on four snapshots around the expected totals."""
    want = expected_totals(spark, d)
    snap = F.explode(F.array(*(F.struct(F.lit(n).alias("what"), F.lit(dp).alias("dp"), F.lit(st).alias("stable"), F.lit(t).alias("late")) for n, dp, st, t in (("equal", 0, False, False), ("over", 1, False, False), ("stalled", -1, True, False), ("slow", -1, False, True), ("moving", -1, False, False)))))
    rows = want.select("*", snap.alias("s"))
    w = {k: c(k) for k in ("pageviews", "clicks", "bots")}
    got = w | {"pageviews": c("pageviews") + c("s.dp")}
    return rows.select(c("s.what").alias("what"), reports.verify_verdict(w, got, c("s.stable"), c("s.late")).alias("verdict"))


def gen_mix_counts(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of generated requests, as many as there are events."""
    n = spark.read.parquet(f"{d}/events.parquet").count()
    return generator.events(spark, n).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("bot").alias("bots"), F.count_if(c("type") == "click").alias("clicks"))


# metrics


def rate_accepted(spark: SparkSession, d: str) -> DataFrame:
    return reports.rate_per_second(_requests(spark, d).where("status = 202"), "received_at")


def rate_by_code(spark: SparkSession, d: str) -> DataFrame:
    return reports.rate_per_second(_requests(spark, d), "received_at", ["status"])


def rate_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    return reports.rate_per_second(pipeline.judged(_web(spark, d)).where("reason is not null"), "received_at", ["reason"])


def rate_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return reports.rate_per_second(_outcomes(spark, d), "received_at", ["outcome"], 300)


def rate_consumer(spark: SparkSession, d: str) -> DataFrame:
    rows = _web(spark, d).select("received_at", F.explode(F.when(pipeline_reason().isNull(), F.array(F.lit("processor"), F.lit("aggregator"))).otherwise(F.array(F.lit("processor")))).alias("consumer"))
    return reports.rate_per_second(rows, "received_at", ["consumer"])


def pipeline_reason():
    late = validation.lateness_us(c("ts"), c("received_at"), c("received_at"))
    bad = F.size(validation.problems(c("id"), c("site_id"), c("visitor_id"), c("type"), c("url"), c("ts"), c("received_at"))) > 0
    return F.when(bad, "invalid_event").when(validation.too_late(late), "too_late")


def _freshness(spark: SparkSession, d: str) -> DataFrame:
    """Seconds from reception to the write of counted events; events without a time of reception are not measured."""
    rows = _unique(spark, d).withColumn("written_at", F.timestamp_micros(F.unix_micros("received_at") + (c("event_id") * 7919 % 4000 + 5) * 1000))
    rows = rows.withColumn("received_at", F.when(c("event_id") % 9 != 4, c("received_at")))
    return rows.where("received_at is not null").select("site_id", ((F.unix_micros("written_at") - F.unix_micros("received_at")) / 1e6).alias("seconds"))


FRESHNESS_BOUNDS = reports.exponential_bounds(0.005, 17)


def freshness_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reports.histogram(_freshness(spark, d), "seconds", FRESHNESS_BOUNDS, ["site_id"]).select("site_id", c("i").cast("int").alias("i"), "n")


def freshness_quantiles(spark: SparkSession, d: str) -> DataFrame:
    h = reports.histogram(_freshness(spark, d), "seconds", FRESHNESS_BOUNDS)
    out = [reports.histogram_quantile(h, q).select(F.lit(q).alias("q"), F.round("value", 6).alias("seconds")) for q in (0.5, 0.99)]
    return out[0].unionByName(out[1])


def histogram_quantile(spark: SparkSession, d: str) -> DataFrame:
    rows = _requests(spark, d).select(c("part").alias("consumer"), (c("latency_us") / 1000.0).alias("ms"))
    h = reports.histogram(rows, "ms", reports.exponential_bounds(0.001, 14), ["consumer"])
    return reports.histogram_quantile(h, 0.99, ["consumer"]).select("consumer", F.round("value", 6).alias("p99"))


def mean_batch_size(spark: SparkSession, d: str) -> DataFrame:
    batches = webevents.with_offsets(_web(spark, d)).groupBy("part", F.floor(c("offset") / 200).alias("batch")).agg(F.count(F.lit(1)).alias("size"))
    return batches.groupBy(c("part").alias("consumer")).agg(F.count(F.lit(1)).alias("batches"), F.round(F.sum("size") / F.count(F.lit(1)), 6).alias("mean_size"))


def _lags(spark: SparkSession, d: str) -> DataFrame:
    rows = webevents.with_offsets(_web(spark, d)).groupBy("part").agg(F.min("offset").cast("long").alias("first"), (F.max("offset") + 1).cast("long").alias("end"))
    rows = rows.withColumn("committed", F.when(c("part") == 0, F.lit(-1)).when(c("part") == 1, c("end") + 5).otherwise(c("end") - c("part") * 10).cast("long"))
    return reports.lag(rows)


def consumer_lag(spark: SparkSession, d: str) -> DataFrame:
    per = _lags(spark, d).select(c("part").cast("string").alias("partition"), "lag")
    return per.unionByName(per.agg(F.sum("lag").alias("lag")).select(F.lit("total").alias("partition"), "lag"))


def max_lag(spark: SparkSession, d: str) -> DataFrame:
    """Largest lag of each consumer (two partitions each) and of all."""
    return reports.top_lag(_lags(spark, d).withColumn("consumer", F.floor(c("part") / 2).cast("int")), "consumer")


# batches


def _batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of up to 200 messages of a partition, with derived durations; some of them failed."""
    rows = webevents.with_offsets(_web(spark, d)).groupBy("part", F.floor(c("offset") / 200).alias("batch")).agg(F.count(F.lit(1)).alias("size"), F.min("received_at").alias("started"))
    mixed = c("size") * 13 + c("batch") * 37 + c("part") * 101
    failed = (c("batch") * 7 + c("part")) % 11 == 3
    return rows.select(c("part").cast("string").alias("consumer"), "batch", "size", "started", F.when(failed, "error").otherwise("ok").alias("result"), (mixed % 900 + 1).alias("duration_ms"), (mixed % 40 + 1).alias("publish_ms"), (mixed % 70 + 1).alias("store_ms"))


def batch_metrics(spark: SparkSession, d: str) -> DataFrame:
    return reports.batch_metrics(_batches(spark, d), [str(p) for p in range(webevents.PARTITIONS)])


def batch_size_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reports.histogram(_batches(spark, d), "size", reports.exponential_bounds(1, 9), ["consumer"]).select("consumer", c("i").cast("int").alias("i"), "n")


MS_BOUNDS = reports.exponential_bounds(0.001, 14)


def batch_duration_p99(spark: SparkSession, d: str) -> DataFrame:
    h = reports.histogram(_batches(spark, d).withColumn("s", c("duration_ms") / 1000.0), "s", MS_BOUNDS, ["consumer"])
    return reports.histogram_quantile(h, 0.99, ["consumer"]).select("consumer", F.round("value", 6).alias("p99"))


def latency_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Estimated p50 and p99, in seconds, of requests, publishing and storing."""
    done = _batches(spark, d).where("result = 'ok'").select(F.inline(F.array(*(F.struct(F.lit(w).alias("what"), (c(f"{w}_ms") / 1000.0).alias("s")) for w in ("publish", "store")))))
    asked = _requests(spark, d).select(F.lit("request").alias("what"), (c("latency_us") / 1e6).alias("s"))
    h = reports.histogram(done.unionByName(asked), "s", MS_BOUNDS, ["what"])
    out = [reports.histogram_quantile(h, q, ["what"]).select("what", F.lit(q).alias("q"), F.round("value", 6).alias("seconds")) for q in (0.5, 0.99)]
    return out[0].unionByName(out[1])


def rate_batch_errors(spark: SparkSession, d: str) -> DataFrame:
    return reports.rate_per_second(_batches(spark, d).where("result = 'error'"), "started", ["consumer"], 300)


# load


STEP_SECONDS = 61


def _load(spark: SparkSession, d: str) -> DataFrame:
    """Requests of the load steps: some dropped by the client, some without an answer."""
    e = c("event_id")
    return _requests(spark, d).select(
        c("part").alias("step"),
        F.when(e % 101 != 7, c("status")).alias("status"),
        (e % 97 == 5).alias("dropped"),
        (e * 7919 % 9973 * 10 + 3).alias("latency_us"),
        F.unix_micros("received_at").alias("intended_us"),
        (e * 2 + c("copy")).alias("seq"),
        F.concat_ws("/", c("part").cast("string"), (c("user_id") % 4).cast("string")).alias("worker"),
    )


def load_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.load_summary(_load(spark, d), "step", F.lit(STEP_SECONDS))


def step_table(spark: SparkSession, d: str) -> DataFrame:
    """The load report as lines of text, one a step."""
    rows = load_summary(spark, d)
    cells = {x: c(x) for x in rows.columns} | {"rate": (c("step") + 1) * 1000}
    return rows.select("step", reports.step_line(cells).alias("line"))


def open_loop_latency(spark: SparkSession, d: str) -> DataFrame:
    """Latency from the intended time of requests that wait for their worker."""
    p = reports.upper_rank_percentile
    rows = reports.open_loop(_load(spark, d).where("not dropped"), "worker", "intended_us", "latency_us")
    return rows.groupBy("step").agg(p("wait_us", 0.5).cast("long").alias("p50"), p("wait_us", 0.99).cast("long").alias("p99"), F.max("wait_us").cast("long").alias("max"))


def key_order(spark: SparkSession, d: str) -> DataFrame:
    """For every message the one before it of the same visitor, from rows taken one after the other."""
    rows = webevents.with_offsets(_enriched(spark, d)).select("site_id", "visitor_id", "part", "offset", "id", "copy")

    def before(batches):
        last, name = None, None
        for b in batches:
            key = b["site_id"] + "/" + b["visitor_id"]
            prev, same = b["id"].shift(1), key.eq(key.shift(1))
            if len(b):
                prev.iloc[0], same.iloc[0] = name, key.iloc[0] == last
                last, name = key.iloc[-1], b["id"].iloc[-1]
            yield b.assign(previous=prev.where(same, "").fillna(""))[["id", "copy", "previous"]]

    return pipeline.in_key_order(rows, ["site_id", "visitor_id"], ["part", "offset"]).mapInPandas(before, "id string, copy int, previous string")


# stored counters


def latest_minutes_of_site(spark: SparkSession, d: str) -> DataFrame:
    """Latest minutes of a site, from counters stored by site and minute."""
    folder = topics.shared_folder(spark)
    sinks.store_by_site(counters.minute_counters(_unique(spark, d).withColumn("new_session", F.lit(False))), folder)
    return sinks.latest_of_site(spark, folder, "site-1").select("bucket_id", "pageviews", "clicks", "bot_events")


def audit_diff_of_sites(spark: SparkSession, d: str) -> DataFrame:
    """Differing buckets of the sites with a prefix; both sides are filtered before they meet."""
    events = audit.of_sites(_unique(spark, d), "site-1").withColumn("new_session", F.lit(False))
    unique = counters.minute_counters(events).select("bucket_id", *audit.TOTALS)
    return audit.bucket_diff(audit.of_sites(_stored(audit_totals(spark, d)), "site-1"), unique)


def audit_first_diffs(spark: SparkSession, d: str) -> DataFrame:
    unique = audit_totals(spark, d)
    return audit.first_and_rest(audit.bucket_diff(_stored(unique), unique)).select("bucket_id", *audit.TOTALS, "remaining")


def in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query built with UTC as the session's time zone, which is put back afterwards (expressions keep the zone they were built with)."""

    @wraps(query)
    def built(spark: SparkSession, d: str) -> DataFrame:
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return query(spark, d)
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)

    return built


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: in_utc(f)
    for f in (
        minute_counters, breakdown_devices, breakdown_browsers, bot_events, sessions_opened, minute_counters_from_deltas, totals_by_prefix, latest_minutes, bucket_count, bucket_id,
        sessions_assign, sessions_replay, session_summary, active_sessions, session_id_hash,
        partition_key, dedupe_key, dedupe_owner, ua_parse, ip_anonymize, lateness,
        validate_problems, too_late, dead_letters, dead_letters_by_reason, dead_letter_raw, collect_status, decode_json, decode_strict, collect_stamp, encode_enriched, decode_enriched,
        redelivered, dedupe_claim, dedupe_first, not_yet_applied, positions_after_batch, batch_outcomes, route_outputs,
        audit_parse_lines, audit_copies, audit_totals, audit_bucket_diff, audit_copies_in_diff, audit_verdict,
        expected_totals, latency_percentiles, step_codes, verify_verdict, gen_mix_counts,
        rate_accepted, rate_by_code, rate_dead_letters, rate_outcomes, rate_consumer, freshness_histogram, freshness_quantiles, histogram_quantile, mean_batch_size, consumer_lag,
        process_messages, max_lag, batch_metrics, batch_size_histogram, batch_duration_p99, latency_quantiles, rate_batch_errors, load_summary, step_table, open_loop_latency, key_order,
        latest_minutes_of_site, audit_diff_of_sites, audit_first_diffs, streams.topic_scan,
        streams.stream_scan, streams.stream_minute_counters, streams.stream_sessions,
    )
}
