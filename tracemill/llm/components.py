"""Connected components by repeated contraction, with built-in functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import spread_join
from tracemill.session import materialise


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, root`` for every node of ``edges``; the root is the smallest node it is connected with.

    Each round points every node to its smallest neighbour (or itself) and contracts the
    edges; a round leaves at most half of the nodes that still have edges. The pointers
    of all rounds are then followed one after the other.
    """
    rest = materialise(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b").distinct())
    rounds = []
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = materialise(both.groupBy("a").agg(F.min("b").alias("b"))
                               .select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
        rounds.append(pointers)
        first = spread_join(rest, pointers.select(F.col("node").alias("a"), F.col("root").alias("x")), ["a"], "b")
        both_ends = spread_join(first, pointers.select(F.col("node").alias("b"), F.col("root").alias("y")), ["b"], "a")
        rest = materialise(both_ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                           .filter("a <> b").distinct())
    if not rounds:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[0]
    for pointers in rounds[1:]:
        step = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        hit = spread_join(found, step, ["root"], "node", "left")
        found = materialise(hit.select("node", F.coalesce("next", "root").alias("root")))
    return found
