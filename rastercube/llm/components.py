"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.shared import cut


def _print_of(edges: DataFrame):
    """A number that changes when the set of edges does, and how many there are."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge list (u, v); root is the component's least node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): each star is a
    grouped minimum (combined before the shuffle) joined back to its edges, so a node with
    very many edges is split by the skew join and never gathered. Every round is written to
    the shared folder; a lost executor costs one round at most. Nulls are no nodes.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    e = cut(e, "edges")
    seen = _print_of(e)
    if seen[0] == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(rounds):
        # large star: every larger neighbour moves to the least neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(low, both.u == low.w).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        moved = large.join(low, large.u == low.w).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e2 = moved.filter("u <> v").unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()
        e2 = cut(e2, "edges")
        now = _print_of(e2)
        e = e2
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
