"""Deterministic synthetic events: every draw is a hash of (seed, sequence number)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .webevents import AGENTS


@dataclass(frozen=True)
class Mix:
    """Shares of the generated kinds."""

    duplicate: float = 0.02
    invalid: float = 0.01
    bot: float = 0.05
    click: float = 0.20
    late: float = 0.02
    too_late: float = 0.005
    sites: int = 3
    visitors: int = 10_000
    recent: int = 128


def draw(seed: int, what: str, seq: Column) -> Column:
    """Uniform in [0, 1) from the first 13 hexadecimal digits of a digest."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.lit(what), seq.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


#: Bodies of invalid requests.
INVALID_BODIES = ["{oops", '{"id":"incomplet"}']


def kind(mix: Mix, seed: int, seq: Column) -> Column:
    roll = draw(seed, "kind", seq)
    return F.when(roll < mix.invalid, "invalid").when((roll < mix.invalid + mix.duplicate) & (seq > 0), "duplicate").otherwise("valid")


def events(spark: SparkSession, n: int, run: str = "run", seed: int = 1, mix: Mix | None = None, start: str = "2026-01-01 00:00:00", rate: float = 1000.0, slices: int | None = None) -> DataFrame:
    """``n`` requests: seq, kind, source_seq, body fields and the labels that the checks need.

    A duplicate repeats the request of up to ``recent`` sequence numbers ago
    (that number's fields, computed again from the hash: no join).
    """
    mix = mix or Mix()
    base = spark.range(0, n, 1, slices).withColumnRenamed("id", "seq")
    seq = F.col("seq")
    back = (F.floor(draw(seed, "back", seq) * F.least(F.lit(mix.recent), seq)) + 1).cast("long")
    base = base.withColumn("kind", kind(mix, seed, seq)).withColumn("source_seq", F.when(F.col("kind") == "duplicate", seq - back).otherwise(seq))
    # a replayed slot that was itself invalid or a replay is taken as a valid event of that number
    src = F.col("source_seq")
    age = draw(seed, "age", src)
    minutes = F.when(age < mix.too_late, 65 + 60 * draw(seed, "jitter", src)).when(age < mix.too_late + mix.late, 1 + 54 * draw(seed, "jitter", src)).otherwise(0.0)
    bot = draw(seed, "bot", src) < mix.bot
    human = F.element_at(F.array(*(F.lit(AGENTS[i]) for i in (0, 2, 3))), (F.floor(draw(seed, "agent", src) * 3) + 1).cast("int"))
    sent = F.unix_micros(F.lit(start).cast("timestamp")) + (src * 1_000_000 / rate).cast("long")
    return base.select(
        "seq",
        "kind",
        "source_seq",
        F.concat(F.lit(f"load-{run}-"), src).alias("id"),
        F.when(draw(seed, "type", src) < mix.click, "click").otherwise("pageview").alias("type"),
        F.concat(F.lit(f"load-{run}-s"), F.floor(draw(seed, "site", src) * mix.sites)).alias("site_id"),
        F.concat(F.lit("v-"), F.floor(draw(seed, "visitor", src) * mix.visitors)).alias("visitor_id"),
        F.concat(F.lit("https://example.com/page-"), F.floor(draw(seed, "page", src) * 50)).alias("url"),
        F.when(bot, AGENTS[7]).otherwise(human).alias("user_agent"),
        F.timestamp_micros(sent - (minutes * 60_000_000).cast("long")).alias("timestamp"),
        F.when(F.col("kind") == "invalid", F.when(seq % 2 == 0, INVALID_BODIES[0]).otherwise(INVALID_BODIES[1])).alias("invalid_body"),
        bot.alias("bot"),
        (age < mix.too_late).alias("too_late"),
    )
