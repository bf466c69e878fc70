"""Connected components by iterated joins, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written


def connected(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Rows (``node``, ``label``): every node of ``links`` and the smallest node it is connected with.

    Large-star and small-star steps alternate: each turns the graph into stars around smaller nodes
    and keeps its components, and the number of rounds grows with the logarithm of the longest
    chain. Neighbourhoods are only aggregated (a minimum per node), never listed, and each round is
    written to the shared folder, which cuts the lineage.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    edges = written(pairs.where("a <> b and a is not null and b is not null").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(rounds):
        edges = written(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.union(stars.select("label", "label").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest node around it."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least).where("a <> b").distinct()
