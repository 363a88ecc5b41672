"""Classification of user-agent strings as columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fragments that give automated clients away.
BOT_FRAGMENTS = ["bot", "crawl", "spider", "slurp", "curl/", "wget/", "python-requests", "python-urllib", "go-http-client", "httpclient", "headlesschrome", "phantomjs", "lighthouse", "facebookexternalhit"]
#: Browser by fragment; the first rule that holds wins.
BROWSER_RULES = [("edge", ["edg/", "edge/", "edga/", "edgios/"]), ("opera", ["opr/", "opera"]), ("firefox", ["firefox/", "fxios/"]), ("chrome", ["chrome/", "crios/"]), ("safari", ["safari/"])]


def has_any(text: Column, fragments: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(f)) for f in fragments])


def normal(agent: Column) -> Column:
    """Trimmed (all Unicode white space) and lower-cased; null counts as empty."""
    return F.lower(F.regexp_replace(F.coalesce(agent, F.lit("")), r"(?U)^\s+|\s+$", ""))


def bot_of(low: Column) -> Column:
    """Whether a normal agent is a bot's; an absent agent counts as one."""
    return (low == "") | has_any(low, BOT_FRAGMENTS)


def browser_of(low: Column, bot: Column) -> Column:
    rule = F.when(bot, "other")
    for name, fragments in BROWSER_RULES:
        rule = rule.when(has_any(low, fragments), name)
    return rule.otherwise("other")


def device_of(low: Column, bot: Column) -> Column:
    return (
        F.when(bot, "bot")
        .when(has_any(low, ["ipad", "tablet"]), "tablet")
        .when(F.contains(low, F.lit("android")) & ~F.contains(low, F.lit("mobile")), "tablet")
        .when(has_any(low, ["mobile", "iphone", "android"]), "mobile")
        .otherwise("desktop")
    )


def is_bot(agent: Column) -> Column:
    return bot_of(normal(agent))


def browser(agent: Column) -> Column:
    return browser_of(normal(agent), is_bot(agent))


def device(agent: Column) -> Column:
    return device_of(normal(agent), is_bot(agent))


def classified(events: DataFrame, column: str = "user_agent") -> DataFrame:
    """Adds browser, device and is_bot; the agent is normalised once a row."""
    low = events.withColumn("_low", normal(F.col(column)))
    marked = low.withColumn("is_bot", bot_of(F.col("_low")))
    return marked.withColumns({"browser": browser_of(F.col("_low"), F.col("is_bot")), "device": device_of(F.col("_low"), F.col("is_bot"))}).drop("_low")
