"""Audit lines ``<partition> <offset> <json>``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codec import decode_enriched


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Rows (partition, offset, event, readable); unreadable lines keep nulls and are counted by the flag."""
    parts = F.split(F.col(column), " ", 3)
    whole = F.when(F.size(parts) == 3, True).otherwise(False)
    number = lambda i, kind: F.when(whole, F.get(parts, F.lit(i)).try_cast(kind))
    out = lines.select(number(0, "int").alias("partition"), number(1, "bigint").alias("offset"), F.when(whole, decode_enriched(F.get(parts, F.lit(2)))).alias("event"))
    return out.withColumn("readable", F.col("partition").isNotNull() & F.col("offset").isNotNull() & F.col("event").isNotNull())
