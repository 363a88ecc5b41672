"""Claims, positions and outcomes of deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def claim(messages: DataFrame, owner: Column, order: list[Column]) -> DataFrame:
    """Adds ``claimed``: the owner of the first delivery of (site, id); the same owner may claim again."""
    w = Window.partitionBy("site_id", "id").orderBy(*order)
    return messages.withColumn("claimed", F.first(owner).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def first_deliveries(messages: DataFrame, order: list[Column]) -> DataFrame:
    """The first delivery of each (site, id)."""
    w = Window.partitionBy("site_id", "id").orderBy(*order)
    return messages.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def redelivered(messages: DataFrame, order: list[Column], position: tuple[str, ...] = ("part", "offset")) -> DataFrame:
    """Adds ``again``: true for all but the first delivery of a position."""
    w = Window.partitionBy(*position).orderBy(*order)
    return messages.withColumn("again", F.row_number().over(w) > 1)


def not_yet_applied(messages: DataFrame, positions: DataFrame) -> DataFrame:
    """Messages beyond the stored position of their partition, or of a partition without one.

    Positions hold one row a partition: their number is bounded by the topic.
    """
    p = positions.select(F.col("part"), F.col("offset").alias("_upto"))
    return messages.join(p, "part", "left").where(F.col("offset") > F.coalesce("_upto", F.lit(-1))).drop("_upto")


def advanced(messages: DataFrame, positions: DataFrame) -> DataFrame:
    """Stored positions after a batch, skipped messages included; no position moves back."""
    top = messages.groupBy("part").agg(F.max("offset").alias("_top"))
    return positions.join(top, "part", "full_outer").select("part", F.greatest("offset", "_top").alias("offset"))


def outcomes(messages: DataFrame, positions: DataFrame) -> DataFrame:
    """Adds ``outcome``; needs again, readable, owner and claimed.  Tested in this order: redelivered, skipped, duplicate, replayed, counted."""
    p = positions.select(F.col("part"), F.col("offset").alias("_upto"))
    out = messages.join(p, "part", "left")
    case = F.when(F.col("again"), "redelivered").when(~F.col("readable"), "skipped").when(F.col("owner") != F.col("claimed"), "duplicate").when(F.col("offset") <= F.coalesce("_upto", F.lit(-1)), "replayed").otherwise("counted")
    return out.withColumn("outcome", case).drop("_upto")
