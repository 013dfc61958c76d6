"""Connected components by alternating large-star and small-star.

Both steps only ever send a node's smallest neighbour along its edges, so no
task gathers a neighbourhood: minima combine before the shuffle, and the join
that spreads them is split by Spark where one node has very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import materialise

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than the node is linked to the smallest of
    neighbours and node."""
    both = edges.select("hi", "lo").union(edges.select("lo", "hi")).toDF("node", "near")
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    joined = both.join(least.hint("merge"), "node").where(F.col("near") > F.col("node"))
    return joined.select(F.col("near").alias("hi"), F.least("node", "least").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the node, are linked to the smallest one."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    joined = edges.join(least.hint("merge"), "hi").where(F.col("lo") != F.col("least"))
    moved = joined.select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.union(least.select("hi", F.col("least").alias("lo"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """(node, component) for every node that is not the smallest of its
    component; ``component`` is the smallest node reachable.

    Self-links, repeated links and links with a null end are ignored; without
    links the result is empty.
    """
    work = (edges.where(F.col(a) != F.col(b))
            .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    work = materialise(work, name)
    before = _state(work)
    for _ in range(MAX_ROUNDS):
        work = materialise(_small_star(_large_star(work)), name)
        now = _state(work)
        if now == before:
            return work.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
