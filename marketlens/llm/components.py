"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges(a, b)`; root is the smallest node reachable.

    Edges with a null end and loops are ignored, repeated ones harmless, no edges give no rows. Each
    round costs two reductions by node and two joins on them; the number of rounds grows
    with the logarithm of the longest path. Rounds are cut by a stored table, so a lost
    executor costs one round at most.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges"
    )
    state = _state(current)
    while True:
        both = current.union(current.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        parent = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(parent, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        current = stored(small.union(parent).distinct(), "edges")
        before, state = state, _state(current)
        if state == before:
            return current.toDF("node", "root").union(current.select("lo", "lo").distinct())


def _state(edges: DataFrame) -> tuple:
    """Changes whenever a round changes the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
