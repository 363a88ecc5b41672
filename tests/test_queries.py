"""Every catalogue query against its SQL, and the known counts of the derived events."""

from __future__ import annotations

import compare
import pytest

from webmeter.plans import catalog, oracle

FOLDER = f"{compare.DATA}/sf0.001"


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.ORACLE)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, name):
    compare.same(catalog.QUERIES[name](spark, FOLDER), oracle.ORACLE[name], FOLDER)


@pytest.mark.parametrize("name", ["decode_json", "decode_strict"])
def test_decoders_return_oversized_bodies(spark, name):
    """Padded bodies (event_id % 16 = 9) are decoded like any other."""
    got = catalog.QUERIES[name](spark, FOLDER).cache()
    assert got.count() == spark.read.parquet(f"{FOLDER}/events.parquet").count()
    long = {tuple(r)[1:] for r in got.where("event_id % 16 = 9").collect()}
    assert long == ({(True, None, None)} if name == "decode_json" else {(False,)})


@pytest.mark.parametrize("name", ["dead_letters_by_reason", "collect_status", "decode_json", "process_messages", "dead_letters", "decode_strict"])
def test_raw_messages_are_decoded_once(spark, name):
    """The text is parsed by one expression of the plan, below all filters, in as many tasks as there are cores and more."""
    spark.catalog.clearCache()
    plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and len(plan) < 100_000
    assert plan.count("RepartitionByExpression") == 1


@pytest.mark.parametrize("name", ["minute_counters", "dead_letters", "stream_minute_counters", "rate_by_code", "session_summary"])
def test_other_time_zone(spark, name):
    """The session's time zone neither matters nor changes."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        compare.same(catalog.QUERIES[name](spark, FOLDER), oracle.ORACLE[name], FOLDER)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_positions_cover_all_messages(spark):
    want = oracle._web("SELECT part, greatest(max(off), CASE WHEN part < 5 THEN 20 * part END)::BIGINT AS offset FROM pos GROUP BY part", oracle.OFFSETS)
    compare.same(catalog.positions_after_batch(spark, FOLDER), want, FOLDER)


def test_known_totals(spark):
    """Counts of the derived events at sf0.01."""
    from pyspark.sql import functions as F

    rows = catalog.minute_counters(spark, f"{compare.DATA}/sf0.01").agg(F.count("*"), *(F.sum(c) for c in ("pageviews", "clicks", "bot_events", "sessions"))).first()
    assert tuple(rows) == (7376, 2507, 2498, 2591, 4973)


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_plan_prunes_and_stays_native(spark):
    plan = catalog.minute_counters(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
    assert "value" not in plan.split("ReadSchema")[1].split("\n")[0]
