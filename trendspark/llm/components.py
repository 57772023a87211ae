"""Connected components by contraction, as DataFrame joins.

Each round every vertex joins its first neighbour (itself included) in an order of the vertices, and the graph is
replaced by the joined vertices. The first two rounds order by id, which settles stars at their smallest vertex; later
ones order by a hash that changes with the round, so chains shrink by a constant factor too. Rounds are few (logarithmic
in the longest path) and each round's graph is cut from its lineage by a reliable checkpoint. A vertex with very many edges is only
ever in a minimum, which is reduced before the shuffle, and in joins that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import cut

#: Rounds ordered by id alone.
PLAIN_ROUNDS = 2


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of every vertex of ``edges`` (long columns a, b); root is the smallest vertex reachable.
    Edges with a null end or from a vertex to itself are left out; no edges give no rows."""
    edges = cut(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a != b").distinct())
    steps: list[DataFrame] = []
    round_ = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if round_ < PLAIN_ROUNDS:
            step = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("to"))
        else:
            order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(round_)).alias("h"), F.col(c).alias("v"))
            step = both.groupBy("a").agg(F.min(order("b")).alias("b")).select(F.col("a").alias("v"), F.least(order("a"), F.col("b"))["v"].alias("to"))
        steps.append(step)
        left = step.select(F.col("v").alias("a"), F.col("to").alias("na"))
        right = step.select(F.col("v").alias("b"), F.col("to").alias("nb"))
        edges = cut(edges.join(left, "a").join(right, "b").select(F.col("na").alias("a"), F.col("nb").alias("b")).where("a != b").distinct())
        round_ += 1
    if not steps:
        return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        found = found.join(step.select(F.col("v").alias("to"), F.col("to").alias("next")), "to", "left").select("v", F.coalesce("next", "to").alias("to"))
    if len(steps) > PLAIN_ROUNDS:  # roots of hashed rounds are not the smallest
        found = cut(found)
        least = found.groupBy("to").agg(F.min("v").alias("root"))
        return found.join(least, "to").select(F.col("v").alias("vertex"), "root")
    return found.select(F.col("v").alias("vertex"), F.col("to").alias("root"))
