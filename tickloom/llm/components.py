"""Connected components of a graph of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long); root is the smallest
    node that can be reached.

    Large-star and small-star steps in turn: every node hands its smallest neighbour to
    the larger, then to the smaller of its neighbours, until nothing changes. The number
    of rounds follows the logarithm of the longest chain. Each round is a written table,
    so neither lineage nor lost executors carry over; the driver sees one number a round.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that a join with a hub's edges has shuffles of its own, which can be split
        low = stored(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m")), "lowest")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "links")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = (
            large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct()
        )
        edges = stored(small, "links")
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stored(roots.union(roots.select("root", "root")).distinct(), "components")
