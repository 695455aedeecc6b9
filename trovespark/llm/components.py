"""Connected components of a table of links, by alternating large and small stars.

Each round links every node to the smallest node around it, first towards larger neighbours, then among smaller ones,
until only stars are left. Rounds are joins and sums over the links alone; each is written to the shared folder, so that
lineage stays short and a lost executor costs one round's part. Nothing but two numbers reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from trovespark.frames import materialise, pick, release


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node that a link (a, b) joins to another; a table to release.

    Repeated links, links both ways and links of a node to itself count once, once and not; links with a null are left out.
    An empty table gives none; other columns are left out whatever their names.
    """
    pairs = pick(links, a="bigint", b="bigint").where("a != b")
    now = materialise(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (state := now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != before:
        before = state
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        up = now.select(F.col("b").alias("a"), F.col("a").alias("far"))  # each link once, from its smaller end
        large = up.join(low, "a").select(F.col("far").alias("a"), F.col("low").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct(F.col("a"), F.col("low").alias("b")))).alias("e"))
        new = materialise(small.select("e.a", "e.b").where("a != b").distinct(), "links")
        release(now)
        now = new
    out = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out._shared_path = now._shared_path
    return out
