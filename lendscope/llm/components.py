"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.sources.workspace import stored


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """Stored, so that a hub's rows meet it in a join that Spark can split."""
    return stored(pairs.groupBy("u").agg(F.min("v").alias("least")), "components-least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).withColumn("least", F.least("u", "least"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    least = _least_neighbour(edges)
    moved = edges.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its least node.

    Rounds of large star and small star until nothing moves: about the logarithm
    of the longest path. Each round is a written table, so a lost executor costs
    a part of one round. Edges with a NULL end and self-loops count for nothing.
    """
    x, y = F.col(a), F.col(b)
    edges = edges.filter(x.isNotNull() & y.isNotNull() & (x != y))
    edges = stored(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "components")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(stored(_large_star(edges), "components-large")), "components")
        if state == (state := _state(edges)):
            break
    hubs = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(hubs)
