"""Connected components of an edge list by alternating large-star and small-star steps.

Both steps only compute, per node, the smallest neighbour (a map-side combined minimum) and join it back;
a node with very many edges is a skewed join key, which adaptive execution splits. Every round is written
to the shared checkpoint folder. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import settle


def _towards_smallest(edges: DataFrame, keep_larger: bool) -> DataFrame:
    low = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    joined = edges.join(low, "u")
    if keep_larger:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return (joined.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(low.select("u", F.col("low").alias("v"))))


def _settled(state: DataFrame) -> bool:
    """True if every edge leads from a node with no other edge to the smallest node of its component."""
    ends = state.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("n_up")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("n_up")))).alias("e"))
    seen = ends.groupBy("e.node").agg(F.sum("e.n_up").alias("n_up"), F.count("*").alias("n"))
    return not seen.where("n_up > 0 and n > 1").agg(F.count("*")).first()[0]


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """edges: columns a, b (of a written table; they are read twice). Returns node, root: the smallest node
    of its component.

    Loops, repeated and null edges are ignored; nodes without an edge to another node are not returned.
    """
    state = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    for _ in range(max_rounds):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_smallest(both, keep_larger=True).where("u <> v")
        state = settle(_towards_smallest(large, keep_larger=False).where("u <> v").distinct(), "components")
        if _settled(state):
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
