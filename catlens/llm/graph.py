"""Connected components of link tables by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link each larger neighbour to the least of the neighbourhood; small star: the others."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("a > b")
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    if large:
        hit = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hit = both.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hit = hit.union(least.select("a", F.col("m").alias("b")))
    return hit.where("a != b").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root (the least node of its component) for every node of links (a, b: any ordered type).

    A hot node is pre-aggregated (groupBy min) and met again by a join, which adaptive execution
    splits. Every round is written to the shared folder, so a lost executor costs one round at most.
    The driver sees one count and one checksum a round. Raises if max_rounds don't suffice.
    Repeated links and self links are harmless; null ends are ignored.
    """
    # a star reads its edges several times, so they are always a written table
    edges = saved(links.select("a", "b").where("a is not null and b is not null and a != b").distinct(), "components")
    mark = None
    for _ in range(max_rounds):
        half = saved(_star(edges, large=True), "components")
        drop(edges)
        edges = saved(_star(half, large=False), "components")
        drop(half)
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == mark or now["n"] == 0:
            break
        mark = now
    else:
        raise RuntimeError("components: no fixed point within max_rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
