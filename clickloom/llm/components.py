"""Connected components by alternating large-star and small-star.

Large-star: every node sends its larger neighbours to the smallest node of its neighbourhood. Small-star: every node
sends its smaller neighbours and itself to the smallest of them. Repeated, the edges become one star for each
component. The smallest neighbour is an aggregation that Spark combines before the shuffle, and joined back to the edges;
a node with very many edges is split by the skew join. No neighbourhood is ever collected. Edges are written to the shared
folder after each turn, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node reachable, for each node with an edge to another one.

    Loops, repeated and reversed edges and edges with a null end change nothing. Runs jobs when called.
    """
    edges = (
        edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    edges = stored(edges, "edges")  # every turn reads its edges several times
    last = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        last = tuple(state)
