"""Connected components of an edge table by alternating large and small stars.

Every round is two joins on aggregated minima; nothing but the edge count and a checksum
reaches the driver. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import staged

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    rest = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return rest.unionByName(least.select("a", F.col("least").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns); root is the least node."""
    u, v = (F.col(c) for c in links.columns)
    edges = staged(
        links.filter(u != v).select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).distinct(), "links"
    )
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
