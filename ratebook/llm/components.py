"""Connected components of a table of links, by alternating star operations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.storage import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; links go downwards."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node that is reachable; of nodes with links only.

    `links`: a and b, in any order, repeated or to oneself. Each round is stored; the number of
    rounds grows with the logarithm of the longest path. No node's links meet in one task but in
    joins, whose large keys adaptive execution splits.
    """
    now = stored(
        links.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        new = stored(_small_star(_large_star(now)), "links")
        sums = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == state or sums[0] == 0:
            return new.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                new.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state, now = sums, new
