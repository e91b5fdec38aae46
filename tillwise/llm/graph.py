"""Connected components of a graph that is a table of edges."""

from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import Scratch


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) with the smallest of u and all its v; the minimum is taken before the join."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return pairs.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node it can reach.

    Alternating large and small stars: every round moves each node's larger neighbours,
    then its smaller ones, to the smallest neighbour, until all edges are (node, root).
    Rounds grow with the logarithm of the longest path. Each round is a written table.
    Loops and repeated edges change nothing; a frame without edges gives no rows.
    """
    edges = edges.toDF("u", "v").where("u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = scratch.save(edges, "edges0")
    state, turn = _state(edges), 0
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = _with_least(large.distinct())
        moved = small.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = moved.unionByName(small.select("u", F.col("least").alias("v"))).distinct()
        turn += 1
        edges = scratch.save(edges, f"edges{turn}")
        scratch.drop(f"edges{turn - 1}")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
