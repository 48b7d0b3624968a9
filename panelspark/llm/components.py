"""Connected components of a link table by alternating star contraction.

Each round points every node's larger neighbours, then its smaller ones, to
the smallest node it knows; rounds halve the depth of the stars, so their
number grows with the logarithm of the longest chain.  Links stay a table:
nothing is collected, and each round is cut with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import ship
from panelspark.session import checkpoint_dir

ship(__name__)


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node
    reachable from it (itself included)."""
    checkpoint_dir(links.sparkSession)
    edges = (links.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b"))
             .filter("a <> b").distinct().checkpoint())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.filter("a <> b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(small_low, "a")
        edges = (star.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small_low.select("a", F.col("m").alias("b")))
                 .filter("a <> b").distinct().checkpoint())
        # the links have settled when a round leaves their number and sums as they were
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
