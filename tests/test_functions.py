"""Tables of single-row functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from webmeter.functions import agents, codec, keys, net, validation
from webmeter.sources.webevents import AGENTS

c = F.col


def one(spark, values, column, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", column.alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_agents(spark):
    want = [
        ("chrome", "desktop", False), ("edge", "desktop", False), ("firefox", "desktop", False), ("safari", "mobile", False), ("safari", "tablet", False), ("chrome", "mobile", False),
        ("chrome", "tablet", False), ("other", "bot", True), ("other", "bot", True), ("other", "bot", True), ("other", "bot", True), ("other", "desktop", False),
    ]
    assert list(zip(one(spark, AGENTS, agents.browser(c("v"))), one(spark, AGENTS, agents.device(c("v"))), one(spark, AGENTS, agents.is_bot(c("v"))), strict=True)) == want
    assert one(spark, ["  ", None, " ", "OPR/1 chrome/2", " FXiOS/1 "], agents.browser(c("v"))) == ["other", "other", "other", "opera", "firefox"]


def test_bot_fragments(spark):
    """Expectations written by hand, one agent a fragment."""
    bots = ["AcmeBot", "my-crawler", "spider/2", "Slurp!", "curl/8", "wget/1", "python-requests/2", "Python-urllib/3", "Go-http-client/2", "Apache-HttpClient/4", "HeadlessChrome/9 chrome/9", "PhantomJS/2", "Chrome-Lighthouse", "FacebookExternalHit/1"]
    assert one(spark, [*bots, "curly", "a browser"], agents.is_bot(c("v"))) == [True] * 14 + [False, False]
    browsers = {"EdgiOS/1 safari/2": "edge", "edge/18 chrome/1": "edge", "edga/1": "edge", "OPR/9 Chrome/1": "opera", "Opera Mini": "opera", "CriOS/2 Safari/1": "chrome", "FxiOS/3 Safari/1": "firefox", "version/3 safari/1": "safari", "else": "other"}
    assert one(spark, list(browsers), agents.browser(c("v"))) == list(browsers.values())


def test_addresses(spark):
    table = {
        "192.0.2.171": "192.0.2.0", "198.51.100.0": "198.51.100.0", "2001:db8:5:77:9:a:b:c": "2001:db8:5::", "2001:DB8::1": "2001:db8::", "fe80::7%lan": "fe80::", "fe80::7%": "", "::FFFF:192.0.2.9": "192.0.2.0",
        "::2": "::", "64:ff9b::198.51.100.7": "64:ff9b::", "::192.0.2.300": "", "1:2:3:4:5:6:7": "", "1:2:3:4:5:6:7:8:9": "", "1::2::3": "", "1:2:3:4::5:6:7:8": "", "::": "::", ":": "", "g::": "", "0:0:7::": "0:0:7::", "nowhere": "", "": "", "9.8.7": "", "300.1.1.1": "", "198.51.100.7%lan": "",
    }
    assert dict(zip(table, one(spark, list(table), net.anonymize(c("v"))), strict=True)) == table
    assert one(spark, [None], net.anonymize(c("v"))) == [""]
    assert one(spark, ["192.0.2.1:80", "[::2]:443", "name", "::2"], net.host(c("v"))) == ["192.0.2.1", "::2", "name", "::2"]


def test_addresses_at_random(spark):
    import ipaddress
    import random

    r = random.Random(3)
    values = [str(ipaddress.IPv6Address(sum(r.choice([0, 0, r.randrange(65536)]) << 16 * k for k in range(8)))) for _ in range(200)]
    want = [str(ipaddress.ip_network(f"{v}/48", strict=False).network_address) for v in values]
    assert one(spark, values, net.anonymize_v6(c("v"))) == want


BASE = {"id": "e1", "site": "s", "visitor": "v", "type": "pageview", "url": "https://example.com/", "ts": "2026-01-01 10:00:00"}


def problems(spark, **change):
    row = BASE | change
    df = spark.createDataFrame([tuple(row.values())], "id string, site string, visitor string, type string, url string, ts string")
    found = validation.problems(c("id"), c("site"), c("visitor"), c("type"), c("url"), c("ts").cast("timestamp"), F.lit("2026-01-01 10:00:00").cast("timestamp"))
    plain = validation.valid(c("id"), c("site"), c("visitor"), c("type"), c("url"), c("ts").cast("timestamp"), F.lit("2026-01-01 10:00:00").cast("timestamp"))
    listed, good = df.select(found, F.coalesce(plain, F.lit(False))).first()
    assert good is not bool(listed)
    return listed


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({}, []),
        ({"type": "click"}, []),
        ({"ts": "2025-12-30 10:00:00"}, []),
        ({"ts": "2026-01-01 10:05:00"}, []),
        ({"ts": "2026-01-01 10:05:01"}, ["timestamp is in the future"]),
        ({"id": ""}, ["id is required"]),
        ({"site": None}, ["site_id is required"]),
        ({"visitor": ""}, ["visitor_id is required"]),
        ({"id": "x" * 129}, ["id must be at most 128 characters"]),
        ({"id": "é" * 64}, []),
        ({"id": "é" * 65}, ["id must be at most 128 characters"]),
        ({"type": "scroll"}, ['type must be "pageview" or "click"']),
        ({"url": ""}, ["url is required"]),
        ({"url": "/page/7"}, ["url must be an absolute http(s) URL"]),
        ({"url": "ftp://files.example/x"}, ["url must be an absolute http(s) URL"]),
        ({"url": "HTTP://e.com/a b"}, []),
        ({"url": "https://e.com/%zz"}, ["url must be an absolute http(s) URL"]),
        ({"url": "https://"}, ["url must be an absolute http(s) URL"]),
        ({"ts": None}, ["timestamp is required"]),
        ({"ts": "0001-01-01 00:00:00"}, ["timestamp is required"]),
        ({"id": "", "site": "", "visitor": "", "type": "", "url": "", "ts": None}, ["id is required", "site_id is required", "visitor_id is required", 'type must be "pageview" or "click"', "url is required", "timestamp is required"]),
    ],
)
def test_validation(spark, change, want):
    assert problems(spark, **change) == want


def test_lateness(spark):
    t = "cast('2026-01-01 10:00:00' as timestamp)"
    cases = [("11:00:00", False), ("11:00:01", True), ("10:00:01", False)]
    for at, late in cases:
        us = validation.lateness_us(F.expr(t), F.expr(f"cast('2026-01-01 {at}' as timestamp)"), F.expr("cast('2026-01-01 13:00:00' as timestamp)"))
        assert spark.range(1).select(validation.too_late(us)).first()[0] is late
    gone = validation.lateness_us(F.expr(t), F.lit(None).cast("timestamp"), F.expr("cast('2026-01-01 11:01:00' as timestamp)"))
    assert spark.range(1).select(validation.too_late(gone), validation.lateness_text(gone)).first()[:] == (True, "event is 1h1m0s late, more than the allowed 1h0m0s")


def test_decoding(spark):
    good = '{"id":"a","timestamp":"2026-01-01T10:00:00Z","extra":1}'
    raws = ["{oops", "[1,2,3]", "", "{}", "null", good, good + "x", good + " {}", "{'id':'a'}", '{"id":5}', '{"id":"a","timestamp":"2026-01-01"}', '{"id":"a}{"}', '"text"', '{"id":null}', None]
    ok = one(spark, raws, codec.decode(c("v"))["ok"])
    assert ok == [False, False, False, True, True, True, False, False, False, False, False, True, False, True, False]
    unknown = one(spark, [good, '{"id":"a"}'], codec.unknown_fields(codec.decode(c("v"))["fields"]))
    assert unknown == [True, False]


def test_decoding_any_case(spark):
    raws = ['{"ID":"z"}', '{"ID":"z","id":null}', '{"Id":"z","iD":"y"}', '{"ID":4,"id":"x"}', '{"id":"a","id":"b"}']
    got = codec.decode(c("v"))
    assert one(spark, raws, got["ok"]) == [True, True, True, False, False]
    assert one(spark, raws[:3], got["id"]) == ["z", "z", "y"]


def test_strict_decoding_reads_the_first_value(spark):
    flat = '{"id":"a","timestamp":"2026-01-01T10:00:00Z"}'
    raws = [flat, flat + " tail", flat + '{"id":', "null", "null tail", "{} []", '{"id":"a\\"}","url":"x"} y', '{"SITE_ID":"s"}', '{"id":"a","x":null}', '{"id":"a",}', '{"id":{"a":1}}', '{"id":"a"', "[] {}", "", None]
    assert one(spark, raws, codec.decode_strict(c("v"))["ok"]) == [True] * 8 + [False] * 7
    many = "{" + ",".join('"id":null' for _ in range(7000)) + "}"
    assert one(spark, [many], codec.decode_strict(c("v"))["ok"]) == [False]  # a repeated name


def test_decoding_refuses_tails_and_keeps_nesting(spark):
    """What follows the first value closes nothing before it, whatever its brackets; nested values and odd names are read."""
    raws = ["{} ] [ {}", "{}],[{}", '{}},"b":{{}', '{},"b":{}', '{"id":"a"} null', "nullnull", ' {"id":"a","x":{"id":5,"y":[{}]}}\n', '{"a, b: STRING":1,"id":"c"}', '{"x`y":2,"ID":"d","type":{"z":"w"}}', '{"id":"}{\\"]["}']
    got = codec.decode(c("v"))
    assert one(spark, raws, got["ok"]) == [False] * 6 + [True, True, False, True]
    assert one(spark, raws[6:], got["id"]) == ["a", "c", "d", '}{"][']
    assert one(spark, raws, codec.decode_strict(c("v"))["ok"]) == [True] * 6 + [False] * 3 + [True]
    deep = '{"id":"a","x":' + "[" * 999 + "]" * 999 + "}"
    assert one(spark, [deep, deep + " {}"], got["ok"]) == [True, False]
    assert one(spark, ["{} {}", " null\n", "null,"], codec.decode_strict(c("v"))["ok"]) == [True] * 3


def test_dead_letter_raw(spark):
    cut = one(spark, ["x" * 8192, "x" * 100_001, "é" * 5000, None], validation.dead_letter_raw(c("v")))
    assert cut[0] == "x" * 8192 and cut[1] == "x" * 8192 + "...(truncated)" and cut[2] == "é" * 4096 + "...(truncated)" and cut[3] is None
    assert "�" in one(spark, ["a" + "é" * 5000], validation.dead_letter_raw(c("v")))[0]


def test_keys(spark):
    row = spark.range(1).select(keys.session_id(F.lit("s"), F.lit("v"), F.lit("e")), keys.dedupe_key(F.lit("a:b"), F.lit("c")), keys.dedupe_key(F.lit("a"), F.lit("b:c")), keys.dedupe_key(F.lit("é"), F.lit("x")), keys.owner(F.lit("t"), F.lit(2), F.lit(7))).first()
    import hashlib

    assert row[0] == "s_" + hashlib.sha256(b"s\0v\0e").hexdigest()[:16]
    assert row[1:] == ("seen:3:a:b:c", "seen:1:a:b:c", "seen:2:é:x", "t/2:7")
