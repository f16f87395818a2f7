"""Connected components of a graph of links, by alternating star contraction.

Each round replaces links by links to the smallest neighbour (large star,
small star); the rounds are a logarithm of the longest path.  Every round
is a few aggregations and joins on the links; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest one around each vertex."""
    both = edges if not large else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("v"), F.least("a", "m").alias("m"))
    met = both.join(least, both["a"] == least["v"])
    if large:
        new = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = met.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
    return new.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
                                       ).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``v``, ``component`` (the smallest vertex reachable) for each vertex of links ``a``, ``b``.

    Vertices without a link are not listed; a link of a vertex to itself or
    a null end counts as none.
    """
    edges = materialise(links.filter("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == state:
            break
        state = seen
        edges = materialise(_star(_star(edges, True), False), "links")
    # every remaining link now points at its component's smallest vertex
    return edges.select(F.col("a").alias("v"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("b").alias("component")).distinct())
