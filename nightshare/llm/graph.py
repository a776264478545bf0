"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightshare.llm.common import saved

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of comparable ids -> (node, root): the smallest id each linked node reaches.

    Each round is two aggregates and two joins on node ids; hub nodes are combined before the
    shuffle and their rows split by adaptive execution. The table of links shrinks to stars in
    a logarithmic number of rounds; each round is written to the shared folder. Links of a
    node with itself and nulls are left out; nodes without other links are not returned.
    """
    stars = saved(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        lowest = saved(lowest, "lowest")  # plain shuffles on both sides of the join, so that a hub's rows are split
        large = saved(both.join(lowest, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct(), "large")
        least = saved(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n"), "least")
        joined = large.join(least, F.col("a") == F.col("n"))
        small = joined.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l")).select("l.a", "l.b").where("a > b").distinct()
        stars = saved(small, "links")
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = state
    raise RuntimeError("components did not settle")
