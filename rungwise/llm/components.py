"""Connected components of a link table by alternating large and small stars.

Each round points every node at the smallest node it sees; the rounds needed grow
with the logarithm of the longest path. Nodes are never brought to the driver:
every step is a minimum by key and a join on that key, which adaptive execution
can split where one node has very many links. Each round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rungwise.session import checkpointed


def _star(pairs: DataFrame) -> DataFrame:
    """``u, v`` (v any neighbour to keep) to links from v to the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``u, v`` links; component is the smallest node reachable.

    Null ends and loops are ignored; repeated and reversed links count once. No links: no rows.
    """
    stars = links.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = checkpointed(stars.distinct())
    state = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = _star(large.distinct())
        moved = small.select(F.col("v").alias("u"), F.col("least").alias("v"))
        own = small.select("u", F.col("least").alias("v"))
        stars = checkpointed(moved.unionByName(own).filter(F.col("u") != F.col("v")).distinct())
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
