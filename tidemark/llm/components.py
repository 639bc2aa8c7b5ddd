"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import forget
from tidemark.session import stored


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of ``pairs``; root is the smallest node reachable.

    ``pairs`` has two columns of one orderable type. Null ends and loops are ignored.
    Large-star and small-star steps alternate until nothing changes: each hangs every
    neighbour of a node under the smallest of them, with a map-side minimum and a join
    that adaptive execution splits where one node has very many neighbours. Each round
    is written to the shared folder, so the plan stays short and a lost executor costs one round.
    """
    one, other = pairs.columns
    edges = pairs.select(F.greatest(one, other).alias("hi"), F.least(one, other).alias("lo"))
    edges = stored(edges.where("hi != lo").distinct(), "edges")
    before = None
    while (now := _signature(edges)) != before:
        old, edges, before = edges, stored(_small_star(_large_star(edges)), "edges"), now
        forget(old)
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.union(edges.select("lo", "lo").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    return hung.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())
