"""Connected components by contraction: each node joins its first neighbour, and the edges between the joined go on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.session import staged

MAX_STEPS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) with another neighbour; the component is its smallest node.

    In each step a node joins the first of itself and its neighbours in a pseudo-random order of all nodes, and
    edges are carried over to what was joined. Two steps share an order, which is what a star needs, whatever
    its size. The first neighbour is aggregated (combined before the shuffle) and stored, so joining it back
    lets Spark split the neighbours of a hub. Repeated edges and loops are allowed; no edges give no rows.
    """
    between = F.col("a") != F.col("b")
    now, moves = staged(edges.where(between).select("a", "b")), []
    for step in range(MAX_STEPS):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        place = lambda name: F.struct(F.xxhash64(name, F.lit(step // 2)).alias("rank"), F.col(name).alias("node"))  # noqa: B023, E731
        first = both.groupBy("a").agg(F.min(place("b")).alias("first")).select(F.col("a").alias("node"), F.least(place("a"), F.col("first"))["node"].alias("to"))
        moves.append(staged(first))
        side = lambda name: moves[-1].select(F.col("node").alias(name), F.col("to").alias(f"{name}_to"))
        moved = now.join(side("a"), "a").join(side("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        now = staged(moved.where(between).distinct())
        if now.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    out = moves[0].withColumnRenamed("to", "component")
    for later in moves[1:]:
        # A node without edges left stays where it is.
        out = out.join(later.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    smallest = staged(out.groupBy("component").agg(F.min("node").alias("least")))
    return out.join(smallest, "component").select("node", F.col("least").alias("component"))
