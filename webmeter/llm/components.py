"""Connected components of a distributed edge list (large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import written


#: Parts that the edges of a hub are dealt to.
SALT = 16


def components(edges: DataFrame, most: int = 200) -> DataFrame:
    """Rows (node, root): every node of an edge (u, v) with the least node of its component.

    Alternates the two star operations until nothing changes; each round is
    written to the shared folder, so that a lost executor costs no more than
    one round, and no group is ever collected: a hub's edges are aggregated in
    parts and joined in ``SALT`` parts.  The number of rounds grows with the
    logarithm of the nodes; RuntimeError if ``most`` are not enough.
    """
    spark = edges.sparkSession
    edges = written(spark, edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(most):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        dealt = both.where("v > u").withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALT)).cast("int"))
        copies = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        large = dealt.join(copies, ["u", "salt"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = written(spark, small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {most} rounds of components")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))
