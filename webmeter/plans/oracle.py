"""The registered queries as DuckDB SQL over the driver's tables."""

from __future__ import annotations

from ..operators.reports import exponential_bounds
from ..sources.generator import Mix
from ..sources.webevents import AGENTS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# expected values, written by hand: browser, device and bot of each agent in turn, and the listed values
_BROWSERS = "['chrome', 'edge', 'firefox', 'safari', 'safari', 'chrome', 'chrome', 'other', 'other', 'other', 'other', 'other']"
_DEVICES = "['desktop', 'desktop', 'desktop', 'mobile', 'tablet', 'mobile', 'tablet', 'bot', 'bot', 'bot', 'bot', 'desktop']"
DEVICES = ["desktop", "mobile", "tablet"]
BROWSERS = ["chrome", "firefox", "safari", "edge", "opera"]
REASONS = ["invalid_json", "invalid_event", "too_late", "encode_error"]
OUTCOMES = ["counted", "duplicate", "redelivered", "replayed", "skipped"]
STATUS_CODES = [202, 400, 413, 422, 503]
_LIST = lambda xs: ", ".join(_q(x) for x in xs)
_MINUTE = "site_id || '|' || strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%MZ')"
_MS = "%Y-%m-%dT%H:%M:%S.%g"

WEB = f"""
src AS (
  SELECT event_id, user_id, event_type, ts, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, (event_id * 7 + user_id) % 12 AS ua_idx,
    CASE event_id % 40 WHEN 0 THEN 4000 WHEN 1 THEN 3600 WHEN 2 THEN -600 WHEN 3 THEN 1800 ELSE 1 END AS late_by
  FROM events
), web AS (
  SELECT 'evt-' || event_id AS id,
    CASE WHEN event_type IN ('view', 'signup') THEN 'pageview' WHEN event_type IN ('click', 'purchase') THEN 'click' ELSE event_type END AS type,
    'site-' || (k % 3) AS site_id, 'v-' || user_id AS visitor_id, 'https://example.com/page-' || (event_id % 50) AS url,
    [{_LIST(AGENTS)}][(ua_idx + 1)::INT] AS user_agent, ts, ts + to_seconds(late_by + copy * 60) AS received_at, (user_id % 6)::INT AS part, copy, event_id, user_id, (ua_idx + 1)::INT AS agent
  FROM src JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR event_id % 50 = 7
), judged0 AS (
  SELECT *, (type NOT IN ('pageview', 'click')) AS bad_type, (ts > received_at + INTERVAL 300 SECONDS) AS future,
    epoch_us(received_at) - epoch_us(ts) AS late_us
  FROM web
), judged AS (
  SELECT *, CASE WHEN bad_type OR future THEN 'invalid_event' WHEN late_us > 3600000000 THEN 'too_late' END AS reason,
    agent IN (8, 9, 10, 11) AS is_bot
  FROM judged0
), named AS (
  SELECT *, {_BROWSERS}[agent] AS browser, {_DEVICES}[agent] AS device
  FROM judged
), enriched AS (SELECT * FROM named WHERE reason IS NULL)"""

UNIQUE = """, uniq AS (
  SELECT * FROM enriched QUALIFY row_number() OVER (PARTITION BY site_id, id ORDER BY received_at, part, event_id, copy) = 1
)"""

SESSIONS = f""", memo AS (
  SELECT *, epoch_us(ts) // 1000 AS ms FROM enriched WHERE NOT is_bot
  QUALIFY row_number() OVER (PARTITION BY site_id, visitor_id, id ORDER BY received_at, event_id, copy) = 1
), s1 AS (
  SELECT *, max(ms) OVER (PARTITION BY site_id, visitor_id ORDER BY received_at, event_id, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_ms FROM memo
), s2 AS (
  SELECT *, CASE WHEN last_ms IS NULL OR ms - last_ms > 1800000 THEN id END AS opens FROM s1
), s3 AS (
  SELECT site_id, visitor_id, id, last_value(opens IGNORE NULLS) OVER (PARTITION BY site_id, visitor_id ORDER BY received_at, event_id, copy ROWS UNBOUNDED PRECEDING) AS opener FROM s2
), sess AS (
  SELECT e.*, CASE WHEN NOT is_bot THEN 's_' || substr(sha256(e.site_id || chr(0) || e.visitor_id || chr(0) || opener), 1, 16) END AS session_id,
    coalesce(NOT is_bot AND opener = e.id, false) AS new_session
  FROM enriched e LEFT JOIN s3 ON NOT e.is_bot AND s3.site_id = e.site_id AND s3.visitor_id = e.visitor_id AND s3.id = e.id
), counted AS (
  SELECT * FROM sess QUALIFY row_number() OVER (PARTITION BY site_id, id ORDER BY received_at, part, event_id, copy) = 1
)"""

OFFSETS = """, pos AS (
  SELECT *, (row_number() OVER (PARTITION BY part ORDER BY received_at, event_id, copy) - 1)::BIGINT AS off FROM enriched
), webpos AS (
  SELECT *, (row_number() OVER (PARTITION BY part ORDER BY received_at, event_id, copy) - 1)::BIGINT AS off FROM named
)"""

COUNTS = """count(*) FILTER (WHERE NOT is_bot AND type = 'pageview') AS pageviews, count(*) FILTER (WHERE NOT is_bot AND type = 'click') AS clicks,
  count(*) FILTER (WHERE is_bot) AS bot_events"""
ALL_COUNTS = COUNTS + ", count(*) FILTER (WHERE NOT is_bot AND new_session) AS sessions"
BASE = f"""{UNIQUE}, base AS (SELECT {_MINUTE} AS bucket_id, site_id, date_trunc('minute', ts) AS minute, {COUNTS} FROM uniq GROUP BY ALL)"""


def _web(select: str, *parts: str) -> str:
    return f"WITH {WEB}{''.join(parts)} {select}"


def _rate(source: str, by: str = "", w: int = 60, *parts: str) -> str:
    group = f", {by}" if by else ""
    return _web(f"SELECT (floor(epoch(received_at) / {w}) * {w})::BIGINT AS window_start{group}, count(*) / {w}.0::DOUBLE AS per_second FROM {source} GROUP BY ALL", *parts)


def _filled(column: str, values: list, source: str) -> str:
    listed = ", ".join(f"({_q(v) if isinstance(v, str) else v})" for v in values)
    return f"SELECT l.v AS {column}, coalesce(n, 0)::BIGINT AS n FROM (VALUES {listed}) l(v) LEFT JOIN (SELECT {column} AS v, count(*) AS n FROM {source} GROUP BY 1) g ON g.v = l.v"


MUTATED = """, mut AS (
  SELECT event_id, event_id % 13 AS m, type, received_at,
    CASE event_id % 13 WHEN 1 THEN '' WHEN 2 THEN repeat('x', 129) ELSE id END AS id,
    CASE event_id % 13 WHEN 3 THEN '' ELSE site_id END AS site_id, CASE event_id % 13 WHEN 4 THEN '' ELSE visitor_id END AS visitor_id,
    CASE event_id % 13 WHEN 10 THEN NULL ELSE ts END AS ts
  FROM web WHERE copy = 0
)"""
_PROBLEMS = """concat_ws('; ',
  CASE m WHEN 1 THEN 'id is required' WHEN 2 THEN 'id must be at most 128 characters' END,
  CASE m WHEN 3 THEN 'site_id is required' END, CASE m WHEN 4 THEN 'visitor_id is required' END,
  CASE WHEN type NOT IN ('pageview', 'click') THEN 'type must be "pageview" or "click"' END,
  CASE m WHEN 5 THEN 'url is required' WHEN 8 THEN 'url must be at most 2048 characters' END,
  CASE WHEN m IN (6, 7) THEN 'url must be an absolute http(s) URL' END,
  CASE WHEN ts IS NULL THEN 'timestamp is required' WHEN ts > received_at + INTERVAL 300 SECONDS THEN 'timestamp is in the future' END)"""

# defects of request bodies, by event_id modulo 16
_CODE = """CASE m WHEN 9 THEN 413 WHEN 3 THEN 400 WHEN 5 THEN 400 WHEN 11 THEN 400 WHEN 13 THEN 400 WHEN 7 THEN 422 WHEN 12 THEN 422
  ELSE CASE WHEN bad_type OR date_trunc('second', ts) > received_at + INTERVAL 300 SECONDS THEN 422 WHEN event_id % 50 = 21 THEN 503 ELSE 202 END END"""
_BODY = """'{"id":"' || id || '","type":"' || type || '","site_id":"' || site_id || '","visitor_id":"' || visitor_id || '","url":"' || url || '"' ||
  CASE WHEN user_agent <> '' THEN ',"user_agent":"' || user_agent || '"' ELSE '' END || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"'"""

MESSAGES = f""", msg AS (
  SELECT CASE WHEN m IN (2, 5, 7, 17, 21) THEN 'invalid_json' WHEN m IN (11, 13) THEN 'invalid_event' ELSE reason END AS reason, m IN (11, 13) AS blank, bad_type, future, late_us, part, off, received_at AS now,
    CASE m WHEN 2 THEN '{{oops' WHEN 5 THEN '[1,2,3]' WHEN 7 THEN '' WHEN 11 THEN '{{}}' WHEN 13 THEN 'null' WHEN 17 THEN '{{' || repeat('w', 9000)
      WHEN 19 THEN '{{"extra":[1,{{"a":2}}],' || substr(body, 2) WHEN 21 THEN body || ' tail' ELSE body END AS raw
  FROM (SELECT *, event_id % 23 AS m, {_BODY} || ',"received_at":"' || strftime(received_at, '%Y-%m-%dT%H:%M:%SZ') || '"}}' AS body FROM webpos) x
  UNION ALL SELECT 'invalid_json', false, false, false, 0, 0, -1, TIMESTAMP '2024-01-01 00:00:00', '{{oops'
  UNION ALL SELECT 'poison', false, false, false, 0, 0, -1, TIMESTAMP '2024-01-01 00:00:00', '{{"id":"poison"}}'
)"""
MESSAGES = MESSAGES.replace("'poison', false", "'invalid_event', NULL")
_REST = "site_id is required; visitor_id is required; type must be \"pageview\" or \"click\"; url is required; timestamp is required"
_TOLD = f"""CASE WHEN reason = 'invalid_json' THEN 'invalid JSON' WHEN blank IS NULL THEN '{_REST}' WHEN blank THEN 'id is required; {_REST}'
  WHEN reason = 'too_late' THEN 'event is ' || (late_us // 3600000000) || 'h' || (late_us // 60000000 % 60) || 'm' || (late_us // 1000000 % 60) || 's late, more than the allowed 1h0m0s'
  ELSE concat_ws('; ', CASE WHEN bad_type THEN 'type must be "pageview" or "click"' END, CASE WHEN future THEN 'timestamp is in the future' END) END"""

DELIVERIES = f"""{OFFSETS}, deliv AS (
  SELECT pos.*, attempt, 'enriched-events/' || part || ':' || off AS owner, off % 13 <> 6 AS readable, attempt = 1 AS again,
    CASE WHEN part < 5 THEN 20 * part ELSE -1 END AS upto
  FROM pos JOIN (VALUES (0), (1)) a(attempt) ON attempt = 0 OR off % 11 = 4
), claims AS (
  SELECT *, first_value(owner) OVER (PARTITION BY site_id, id ORDER BY received_at, part, event_id, copy, attempt) AS claimed FROM deliv WHERE readable AND NOT again
), outc AS (
  SELECT CASE WHEN owner <> claimed THEN 'duplicate' WHEN off <= upto THEN 'replayed' ELSE 'counted' END AS outcome, received_at FROM claims
  UNION ALL SELECT CASE WHEN again THEN 'redelivered' ELSE 'skipped' END, received_at FROM deliv WHERE NOT (readable AND NOT again)
)"""

STORED = f"""{BASE}, un AS (SELECT bucket_id, pageviews, clicks, bot_events, substr(md5(bucket_id), 1, 1) AS h FROM base), stored AS (
  SELECT bucket_id, pageviews + CASE WHEN h = '1' THEN 1 ELSE 0 END AS pageviews, clicks, bot_events FROM un WHERE h <> '0'
  UNION ALL SELECT 'ghost-' || bucket_id, pageviews, clicks, bot_events FROM un WHERE h = '2'
), diff AS (
  SELECT coalesce(s.bucket_id, u.bucket_id) AS bucket_id, (coalesce(s.pageviews, 0) - coalesce(u.pageviews, 0))::BIGINT AS pageviews,
    (coalesce(s.clicks, 0) - coalesce(u.clicks, 0))::BIGINT AS clicks, (coalesce(s.bot_events, 0) - coalesce(u.bot_events, 0))::BIGINT AS bot_events
  FROM stored s FULL JOIN un u ON s.bucket_id = u.bucket_id
), off AS (SELECT * FROM diff WHERE pageviews <> 0 OR clicks <> 0 OR bot_events <> 0)"""

COPIES = f""", multi AS (
  SELECT site_id, id, count(*) AS copies, count(DISTINCT part) AS partitions, string_agg(part || ':' || off, ',' ORDER BY part, off) AS positions,
    arg_min({_MINUTE}, part * 1000000000000 + off) AS bucket_id
  FROM pos GROUP BY site_id, id HAVING count(*) > 1
)"""

REQUESTS = """, req AS (
  SELECT *, CASE WHEN event_id % 100 = 99 THEN 503 WHEN bad_type THEN 422 ELSE 202 END AS status, late_us > 3600000000 AS late, event_id * 7919 % 1000 + 1 AS latency_us FROM named
), acked AS (
  SELECT id, arg_max(type, received_at) AS type, arg_max(is_bot, received_at) AS bot, arg_max(late, received_at) AS late FROM req WHERE status = 202 GROUP BY id
), want AS (
  SELECT count(*) FILTER (WHERE NOT late AND NOT bot AND type <> 'click') AS pageviews, count(*) FILTER (WHERE NOT late AND NOT bot AND type = 'click') AS clicks,
    count(*) FILTER (WHERE NOT late AND bot) AS bots, count(*) FILTER (WHERE late) AS too_late FROM acked
)"""


LOTS = """, lots AS (
  SELECT part::VARCHAR AS consumer, size, started, CASE WHEN (batch * 7 + part) % 11 = 3 THEN 'error' ELSE 'ok' END AS result, (mixed % 900 + 1) / 1000.0::DOUBLE AS s, mixed % 40 + 1 AS publish_ms, mixed % 70 + 1 AS store_ms
  FROM (SELECT part, off // 200 AS batch, count(*) AS size, min(received_at) AS started, count(*) * 13 + (off // 200) * 37 + part * 101 AS mixed FROM webpos GROUP BY part, off // 200) a
)"""
LOAD = """, load AS (
  SELECT part AS step, CASE WHEN event_id % 101 <> 7 THEN status END AS status, event_id % 97 = 5 AS dropped, event_id * 7919 % 9973 * 10 + 3 AS latency, epoch_us(received_at) AS intended, event_id * 2 + copy AS seq, part || '/' || (user_id % 4) AS worker FROM req
), summary AS (
  SELECT step, count(*) AS scheduled, count(*) FILTER (WHERE dropped) AS dropped, count(*) FILTER (WHERE NOT dropped AND status IS NULL) AS errors, (count(*) FILTER (WHERE NOT dropped AND status = 202)) / 61.0::DOUBLE AS accepted_per_s,
    coalesce(quantile_disc(t, 0.5), 0)::BIGINT AS p50, coalesce(quantile_disc(t, 0.95), 0)::BIGINT AS p95, coalesce(quantile_disc(t, 0.99), 0)::BIGINT AS p99, coalesce(max(t), 0)::BIGINT AS max, any_value(codes) AS codes
  FROM (SELECT *, CASE WHEN NOT dropped AND status IS NOT NULL THEN latency END AS t FROM load) l
  JOIN (SELECT step AS of, string_agg(status || ':' || n, ' ' ORDER BY status) AS codes FROM (SELECT step, status, count(*) AS n FROM load WHERE NOT dropped AND status IS NOT NULL GROUP BY 1, 2) x GROUP BY 1) k ON k.of = step
  GROUP BY step
)"""


def _disc(q: float) -> str:
    return f"quantile_disc(latency_us, {q})::DOUBLE"


def _histogram(values: str, column: str, bounds: list[float], by: str) -> str:
    rows = ", ".join(f"({i}, {b!r}::DOUBLE)" for i, b in enumerate(bounds)) + f", ({len(bounds)}, NULL)"
    return f""", bounds(i, le) AS (VALUES {rows}), groups AS (SELECT DISTINCT {by} AS g FROM {values}), hist AS (
  SELECT g, i, le, count(v.{column}) FILTER (WHERE le IS NULL OR v.{column} <= le) AS n
  FROM groups CROSS JOIN bounds LEFT JOIN {values} v ON v.{by} = g GROUP BY g, i, le
)"""


def _quantile(q: float) -> str:
    return f"""(SELECT g, CASE WHEN total = 0 THEN NULL WHEN le IS NULL THEN top ELSE low + (le - low) * ({q} * total - before) / greatest(n - before, 1) END AS value FROM (
    SELECT *, max(n) OVER (PARTITION BY g) AS total, coalesce(lag(n) OVER (PARTITION BY g ORDER BY i), 0) AS before, coalesce(lag(le) OVER (PARTITION BY g ORDER BY i), 0.0) AS low,
      max(le) OVER (PARTITION BY g) AS top FROM hist) x WHERE n >= {q} * total QUALIFY row_number() OVER (PARTITION BY g ORDER BY i) = 1)"""


FRESH = """, fresh AS (SELECT 1 AS one, site_id, (event_id * 7919 % 4000 + 5) / 1000.0::DOUBLE AS seconds FROM uniq WHERE event_id % 9 <> 4)"""
_M = Mix()


def _draw(what: str, seq: str) -> str:
    return f"(('0x' || substr(sha256('1:{what}:' || {seq}), 1, 13))::BIGINT::DOUBLE / {16**13}.0)"


ORACLE: dict[str, str] = {
    "minute_counters": _web(f"SELECT {_MINUTE} AS bucket_id, site_id, {ALL_COUNTS} FROM counted GROUP BY 1, 2 ORDER BY 1", SESSIONS),
    "breakdown_devices": _web(f"SELECT {_MINUTE} AS bucket_id, CASE WHEN device IN ({_LIST(DEVICES)}) THEN device ELSE 'other' END AS device, count(*) AS n FROM uniq WHERE NOT is_bot GROUP BY 1, 2", UNIQUE),
    "breakdown_browsers": _web(f"SELECT {_MINUTE} AS bucket_id, CASE WHEN browser IN ({_LIST(BROWSERS)}) THEN browser ELSE 'other' END AS browser, count(*) AS n FROM uniq WHERE NOT is_bot GROUP BY 1, 2", UNIQUE),
    "bot_events": _web("SELECT site_id, count(*) AS bot_events FROM uniq WHERE is_bot GROUP BY 1", UNIQUE),
    "sessions_opened": _web(f"SELECT {_MINUTE} AS bucket_id, count(*) AS sessions FROM counted WHERE new_session GROUP BY 1", SESSIONS),
    "minute_counters_from_deltas": _web(f"SELECT {_MINUTE} AS bucket_id, site_id, {ALL_COUNTS} FROM counted GROUP BY 1, 2", SESSIONS),
    "totals_by_prefix": _web("SELECT prefix, coalesce(sum(pageviews), 0)::BIGINT AS pageviews, coalesce(sum(clicks), 0)::BIGINT AS clicks, coalesce(sum(bot_events), 0)::BIGINT AS bot_events FROM (VALUES ('site-'), ('site-1'), ('none')) p(prefix) LEFT JOIN base ON starts_with(site_id, prefix) GROUP BY 1", BASE),
    "latest_minutes": _web("SELECT bucket_id, pageviews, clicks, bot_events FROM base ORDER BY minute DESC, site_id LIMIT 10", BASE),
    "bucket_count": _web(f"SELECT count(DISTINCT {_MINUTE}) AS documents FROM uniq", UNIQUE),
    "bucket_id": _web(f"SELECT id, copy, {_MINUTE} AS bucket_id FROM web"),
    "sessions_assign": _web("SELECT id, copy, site_id, visitor_id, session_id, new_session FROM sess WHERE NOT is_bot", SESSIONS),
    "stream_sessions": _web("SELECT id, copy, site_id, visitor_id, session_id, new_session FROM sess WHERE NOT is_bot", SESSIONS),
    "sessions_replay": _web("SELECT site_id, visitor_id, id, count(*) AS deliveries, count(DISTINCT session_id || new_session) AS answers FROM sess WHERE NOT is_bot GROUP BY 1, 2, 3 HAVING count(*) > 1", SESSIONS),
    "session_summary": _web(
        f"SELECT site_id, visitor_id, count(*) AS events, strftime(min(t), '{_MS}') AS first_ts, strftime(max(t), '{_MS}') AS last_ts FROM (SELECT *, sum(opens) OVER (PARTITION BY site_id, visitor_id ORDER BY t, event_id) AS s FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY site_id, visitor_id ORDER BY t, event_id) <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS opens FROM (SELECT *, date_trunc('millisecond', ts) AS t FROM uniq WHERE NOT is_bot) a) b) c GROUP BY site_id, visitor_id, s",
        UNIQUE,
    ),
    "active_sessions": _web(f"SELECT session_id, site_id, visitor_id, strftime(max(ts), '{_MS}') AS last_ts FROM sess WHERE NOT is_bot GROUP BY 1, 2, 3 ORDER BY max(ts) DESC, session_id LIMIT 10", SESSIONS),
    "session_id_hash": _web("SELECT id, 's_' || substr(sha256(site_id || chr(0) || visitor_id || chr(0) || id), 1, 16) AS session_id, substr(sha256(site_id || chr(0) || visitor_id || chr(0) || id), 1, 32) AS event_key FROM web WHERE copy = 0"),
    "partition_key": _web("SELECT id, copy, site_id || '/' || visitor_id AS key FROM web"),
    "dedupe_key": _web("SELECT id, copy, 'seen:' || octet_length(encode(site_id)) || ':' || site_id || ':' || id AS key FROM web"),
    "dedupe_owner": _web("SELECT id, copy, 'enriched-events/' || part || ':' || off AS owner FROM webpos", OFFSETS),
    "ua_parse": _web("SELECT id, copy, browser, device, is_bot FROM named"),
    "ip_anonymize": _web("SELECT id, CASE event_id % 10 WHEN 3 THEN '2001:db8:' || format('{:x}', event_id % 4000 + 1) || '::' WHEN 4 THEN '' WHEN 5 THEN '192.0.2.0' WHEN 6 THEN 'fe80::' WHEN 7 THEN '' ELSE '198.' || (user_id % 256) || '.' || (event_id % 256) || '.0' END AS ip FROM web WHERE copy = 0"),
    "lateness": _web("SELECT id, copy, (late_us // 1000000)::BIGINT AS late_s, late_us > 3600000000 AS too_late FROM named"),
    "validate_problems": _web(f"SELECT event_id, {_PROBLEMS} AS problems FROM mut", MUTATED),
    "too_late": _web("SELECT id, copy, (late_us // 1000000)::BIGINT AS late_s FROM named WHERE reason = 'too_late'"),
    "dead_letters": _web(f"SELECT reason, {_TOLD} AS problems, md5(CASE WHEN length(raw) > 8192 THEN substr(raw, 1, 8192) || '...(truncated)' ELSE raw END) AS raw_md5, 'raw-events' AS topic, part AS partition, off AS offset, strftime(now, '{_MS}') AS failed_at FROM msg WHERE reason IS NOT NULL", OFFSETS, MESSAGES),
    "dead_letters_by_reason": _web(_filled("reason", REASONS, "(SELECT reason FROM msg WHERE reason IS NOT NULL)"), OFFSETS, MESSAGES),
    "process_messages": _web(f"""SELECT 'enriched-events' AS topic, site_id || '/' || visitor_id AS key, part AS partition, off AS offset,
      md5({_BODY} || ',"received_at":"' || strftime(received_at, '%Y-%m-%dT%H:%M:%SZ') || '","browser":"' || browser || '","device":"' || device || '","is_bot":' || is_bot || '}}') AS value_md5
      FROM webpos WHERE reason IS NULL AND event_id % 23 NOT IN (2, 5, 7, 11, 13, 17, 21)""", OFFSETS),
    "dead_letter_raw": _web("SELECT id, md5(cut) AS raw_md5, length(cut)::BIGINT AS n FROM (SELECT id, CASE WHEN length(raw) > 8192 THEN substr(raw, 1, 8192) || '...(truncated)' ELSE raw END AS cut FROM (SELECT id, repeat(user_agent, event_id % 120) AS raw FROM web WHERE copy = 0) a) b"),
    "collect_status": _web(_filled("code", STATUS_CODES, f"(SELECT {_CODE} AS code FROM (SELECT *, event_id % 16 AS m FROM named WHERE copy = 0) x)")),
    "decode_json": _web("SELECT event_id, m NOT IN (2, 3, 11, 13) AS ok, CASE WHEN m = 7 THEN 'a' WHEN m IN (2, 3, 9, 11, 12, 13) THEN NULL ELSE id END AS id, CASE WHEN m IN (2, 3, 7, 9, 11, 12, 13) THEN NULL ELSE site_id END AS site_id FROM (SELECT *, event_id % 16 AS m FROM web WHERE copy = 0) x"),
    "decode_strict": _web("SELECT event_id, m NOT IN (3, 5, 9, 11, 13) AS ok FROM (SELECT *, event_id % 16 AS m FROM web WHERE copy = 0) x"),
    "collect_stamp": _web(f"SELECT id, CASE WHEN user_agent = '' THEN 'header/' || part ELSE user_agent END AS user_agent, '10.9.8.7' AS sent_ip, '198.51.' || (user_id % 256) || '.0' AS ip, strftime(received_at, '{_MS}') AS received_at FROM web WHERE copy = 0"),
    "encode_enriched": _web(f"""SELECT id, copy, {_BODY} || ',"browser":"' || browser || '","device":"' || device || '","is_bot":' || is_bot || '}}' AS value FROM enriched"""),
    "decode_enriched": _web("SELECT event_id, m NOT IN (2, 3, 4, 5) AS readable, CASE WHEN m NOT IN (2, 3, 4, 5) THEN id END AS id FROM (SELECT *, event_id % 11 AS m FROM web WHERE copy = 0) x"),
    "redelivered": _web("SELECT part, count(*) FILTER (WHERE again) AS redelivered, count(*) AS deliveries FROM deliv GROUP BY 1", DELIVERIES),
    "dedupe_claim": _web("SELECT id, copy, 'enriched-events/' || first_value(part) OVER w || ':' || first_value(off) OVER w AS claimed FROM pos WINDOW w AS (PARTITION BY site_id, id ORDER BY received_at, part, event_id, copy)", OFFSETS),
    "dedupe_first": _web("SELECT site_id, id, copy FROM uniq", UNIQUE),
    "not_yet_applied": _web("SELECT id, copy, part, off AS offset FROM pos WHERE off > CASE WHEN part < 5 THEN 20 * part ELSE -1 END", OFFSETS),
    "positions_after_batch": _web("SELECT p.part, greatest(p.stored, t.top)::BIGINT AS offset FROM (SELECT range::INT AS part, CASE WHEN range < 5 THEN 20 * range END AS stored FROM range(6)) p LEFT JOIN (SELECT part, max(off) AS top FROM pos GROUP BY 1) t ON t.part = p.part WHERE p.stored IS NOT NULL OR t.top IS NOT NULL", OFFSETS),
    "batch_outcomes": _web(_filled("outcome", OUTCOMES, "outc"), DELIVERIES),
    "route_outputs": _web("SELECT CASE WHEN reason IS NULL THEN 'enriched' ELSE 'dead' END AS output, coalesce(reason, '') AS reason, count(*) AS n FROM named GROUP BY 1, 2"),
    "audit_parse_lines": _web("SELECT off % 17 NOT IN (5, 6, 7) AS readable, count(*) AS n, coalesce(sum(CASE WHEN off % 17 NOT IN (5, 6, 7) THEN off END), 0)::BIGINT AS offsets FROM pos GROUP BY 1", OFFSETS),
    "audit_copies": _web("SELECT site_id, id, copies, partitions, positions FROM multi", OFFSETS, COPIES),
    "audit_totals": _web("SELECT bucket_id, pageviews, clicks, bot_events FROM base", BASE),
    "audit_bucket_diff": _web("SELECT * FROM off ORDER BY bucket_id", STORED),
    "audit_copies_in_diff": _web("SELECT off.bucket_id, coalesce(multi.id, '') AS id, coalesce(positions, '') AS positions FROM off LEFT JOIN multi ON multi.bucket_id = off.bucket_id", STORED, OFFSETS, COPIES),
    "audit_verdict": _web("SELECT what, CASE WHEN u AND s THEN 'consistent' WHEN NOT u AND s THEN 'upstream' WHEN NOT u THEN 'upstream_and_aggregation' ELSE 'aggregation' END AS verdict FROM (SELECT what, u, s OR same AS s FROM (VALUES ('all equal', true, true), ('stored differs', true, false), ('log differs', false, true), ('both differ', false, false)) c(what, u, s), (SELECT (SELECT (sum(pageviews), sum(clicks), sum(bot_events)) FROM un) = (SELECT (sum(pageviews), sum(clicks), sum(bot_events)) FROM stored) AS same) z) y", STORED),
    "expected_totals": _web("SELECT * FROM want", REQUESTS),
    "latency_percentiles": _web(f"SELECT part AS step, count(*) AS scheduled, count(*) FILTER (WHERE status >= 500) AS errors, {_disc(0.5)} AS p50, {_disc(0.95)} AS p95, {_disc(0.99)} AS p99, max(latency_us)::BIGINT AS max FROM req GROUP BY 1", REQUESTS),
    "step_codes": _web("SELECT part AS step, string_agg(status || ':' || n, ' ' ORDER BY status) AS codes FROM (SELECT part, status, count(*) AS n FROM req GROUP BY 1, 2) x GROUP BY 1", REQUESTS),
    "verify_verdict": _web("SELECT what, verdict FROM want, (VALUES ('equal', 'ok'), ('over', 'double_count'), ('stalled', 'loss'), ('slow', 'timeout'), ('moving', 'wait')) v(what, verdict)", REQUESTS),
    "gen_mix_counts": f"""WITH g AS (SELECT range AS seq, {_draw('kind', 'range')} AS roll FROM range((SELECT count(*) FROM events))), k AS (
      SELECT seq, CASE WHEN roll < {_M.invalid} THEN 'invalid' WHEN roll < {_M.invalid + _M.duplicate} AND seq > 0 THEN 'duplicate' ELSE 'valid' END AS kind FROM g
    ), s AS (SELECT kind, CASE WHEN kind = 'duplicate' THEN seq - (floor({_draw('back', 'seq')} * least({_M.recent}, seq)) + 1)::BIGINT ELSE seq END AS src FROM k)
    SELECT kind, count(*) AS n, count(*) FILTER (WHERE {_draw('bot', 'src')} < {_M.bot}) AS bots, count(*) FILTER (WHERE {_draw('type', 'src')} < {_M.click}) AS clicks FROM s GROUP BY 1""",
    "rate_accepted": _rate("(SELECT * FROM req WHERE status = 202)", "", 60, REQUESTS),
    "rate_by_code": _rate("req", "status", 60, REQUESTS),
    "rate_dead_letters": _rate("(SELECT * FROM named WHERE reason IS NOT NULL)", "reason"),
    "rate_outcomes": _rate("outc", "outcome", 300, DELIVERIES),
    "rate_consumer": _rate("(SELECT received_at, 'processor' AS consumer FROM named UNION ALL SELECT received_at, 'aggregator' FROM enriched)", "consumer"),
    "freshness_histogram": _web("SELECT g AS site_id, i::INT AS i, n FROM hist", UNIQUE, FRESH, _histogram("fresh", "seconds", exponential_bounds(0.005, 17), "site_id")),
    "freshness_quantiles": _web(f"SELECT 0.5::DOUBLE AS q, round(value, 6)::DOUBLE AS seconds FROM {_quantile(0.5)} a UNION ALL SELECT 0.99::DOUBLE, round(value, 6)::DOUBLE FROM {_quantile(0.99)} b", UNIQUE, FRESH, _histogram("fresh", "seconds", exponential_bounds(0.005, 17), "one")),
    "histogram_quantile": _web(f"SELECT g AS consumer, round(value, 6)::DOUBLE AS p99 FROM {_quantile(0.99)} a", REQUESTS, ", lat AS (SELECT part, latency_us / 1000.0::DOUBLE AS ms FROM req)", _histogram("lat", "ms", exponential_bounds(0.001, 14), "part")),
    "mean_batch_size": _web("SELECT part AS consumer, count(*) AS batches, round(sum(size) / count(*)::DOUBLE, 6) AS mean_size FROM (SELECT part, off // 200 AS batch, count(*) AS size FROM webpos GROUP BY 1, 2) b GROUP BY 1", OFFSETS),
    "consumer_lag": _web("SELECT coalesce(part::VARCHAR, 'total') AS partition, sum(lag)::BIGINT AS lag FROM (SELECT part, greatest(stop - greatest(CASE part WHEN 0 THEN -1 WHEN 1 THEN stop + 5 ELSE stop - part * 10 END, start), 0) AS lag FROM (SELECT part, min(off) AS start, max(off) + 1 AS stop FROM webpos GROUP BY 1) a) b GROUP BY GROUPING SETS ((part), ())", OFFSETS),
    "max_lag": _web("SELECT coalesce((part // 2)::VARCHAR, 'all') AS consumer, max(lag)::BIGINT AS lag FROM (SELECT part, greatest(stop - greatest(CASE part WHEN 0 THEN -1 WHEN 1 THEN stop + 5 ELSE stop - part * 10 END, start), 0) AS lag FROM (SELECT part, min(off) AS start, max(off) + 1 AS stop FROM webpos GROUP BY 1) a) b GROUP BY GROUPING SETS ((part // 2), ())", OFFSETS),
    "batch_metrics": _web("SELECT s.c AS consumer, r AS result, count(size) AS batches, CASE WHEN r = 'ok' THEN coalesce(sum(size), 0)::BIGINT ELSE 0 END AS messages FROM (SELECT range::VARCHAR AS c, r FROM range(6), (VALUES ('ok'), ('error')) v(r)) s LEFT JOIN lots ON consumer = s.c AND result = r GROUP BY 1, 2", OFFSETS, LOTS),
    "batch_size_histogram": _web("SELECT g AS consumer, i::INT AS i, n FROM hist", OFFSETS, LOTS, _histogram("lots", "size", exponential_bounds(1, 9), "consumer")),
    "batch_duration_p99": _web(f"SELECT g AS consumer, round(value, 6)::DOUBLE AS p99 FROM {_quantile(0.99)} a", OFFSETS, LOTS, _histogram("lots", "s", exponential_bounds(0.001, 14), "consumer")),
    "latency_quantiles": _web(
        f"SELECT g AS what, 0.5::DOUBLE AS q, round(value, 6)::DOUBLE AS seconds FROM {_quantile(0.5)} a UNION ALL SELECT g, 0.99::DOUBLE, round(value, 6)::DOUBLE FROM {_quantile(0.99)} b",
        REQUESTS, OFFSETS, LOTS, ", took AS (SELECT 'request' AS what, latency_us / 1000000.0::DOUBLE AS s FROM req UNION ALL SELECT 'publish', publish_ms / 1000.0::DOUBLE FROM lots WHERE result = 'ok' UNION ALL SELECT 'store', store_ms / 1000.0::DOUBLE FROM lots WHERE result = 'ok')", _histogram("took", "s", exponential_bounds(0.001, 14), "what"),
    ),
    "rate_batch_errors": _web("SELECT (floor(epoch(started) / 300) * 300)::BIGINT AS window_start, consumer, count(*) / 300.0::DOUBLE AS per_second FROM lots WHERE result = 'error' GROUP BY ALL", OFFSETS, LOTS),
    "load_summary": _web("SELECT * FROM summary", REQUESTS, LOAD),
    "step_table": _web("SELECT step, lpad(((step + 1) * 1000)::VARCHAR, 8, ' ') || lpad(printf('%.0f', accepted_per_s), 10, ' ') || lpad(dropped::VARCHAR, 8, ' ') || lpad(errors::VARCHAR, 8, ' ') || lpad(codes, 28, ' ') || lpad(printf('%.1f ms', p50 / 1000.0), 12, ' ') || lpad(printf('%.1f ms', p95 / 1000.0), 12, ' ') || lpad(printf('%.1f ms', p99 / 1000.0), 12, ' ') || lpad(printf('%.1f ms', max / 1000.0), 12, ' ') AS line FROM summary", REQUESTS, LOAD),
    "open_loop_latency": _web("SELECT step, quantile_disc(wait, 0.5)::BIGINT AS p50, quantile_disc(wait, 0.99)::BIGINT AS p99, max(wait)::BIGINT AS max FROM (SELECT step, total + max(intended - (total - latency)) OVER (PARTITION BY worker ORDER BY intended, seq ROWS UNBOUNDED PRECEDING) - intended AS wait FROM (SELECT *, sum(latency) OVER (PARTITION BY worker ORDER BY intended, seq ROWS UNBOUNDED PRECEDING) AS total FROM load WHERE NOT dropped) a) b GROUP BY 1", REQUESTS, LOAD),
    "key_order": _web("SELECT id, copy, coalesce(lag(id) OVER (PARTITION BY site_id, visitor_id ORDER BY part, off), '') AS previous FROM pos", OFFSETS),
    "latest_minutes_of_site": _web("SELECT bucket_id, pageviews, clicks, bot_events FROM base WHERE site_id = 'site-1' ORDER BY minute DESC LIMIT 10", BASE),
    "audit_diff_of_sites": _web("SELECT * FROM off WHERE starts_with(bucket_id, 'site-1')", STORED),
    "audit_first_diffs": _web("SELECT *, greatest((SELECT count(*) FROM off) - 15, 0)::BIGINT AS remaining FROM off ORDER BY bucket_id LIMIT 15", STORED),
    "topic_scan": _web("SELECT part AS partition, count(*) AS n, count(DISTINCT site_id || '/' || visitor_id) AS keys, max(off) AS last_offset FROM webpos GROUP BY 1", OFFSETS),
    "stream_scan": _web("SELECT part, count(*) AS n FROM web GROUP BY 1"),
    "stream_minute_counters": _web("SELECT bucket_id, pageviews, clicks, bot_events FROM base", BASE),
}
