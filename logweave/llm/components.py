"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import durable


def _spread(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """pairs (u, v) with m, the least of u.

    least is written down first: a join on an aggregate of the same shuffle couldn't split a hub's rows.
    """
    held = durable(least.withColumnRenamed("u", "w"))
    return pairs.join(held, pairs["u"] == held["w"])


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of edges (a, b), component being the smallest node that it reaches.

    Large-star and small-star rounds: every neighbour is linked to the smallest one in sight, so the number of rounds
    goes with the logarithm of the longest path and no round makes more edges than there are. Smallest neighbours
    are a partial aggregate, written down, so that the join that spreads them splits a hub. Edges to oneself and
    repeated edges do no harm; an empty graph gives no rows; nulls aren't allowed.
    """
    now = durable(edges.select("a", "b").where("a <> b").distinct())
    before = None
    for _ in range(max_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        nearest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _spread(both, nearest).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = durable(large.distinct())
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = _spread(down, least).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        now = durable(small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"the components of the graph took more than {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
