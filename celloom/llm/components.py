"""Connected components of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from celloom.llm.common import landed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours hang on its smallest neighbour or itself."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours hang on the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node either hangs on one other or is hung on."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    return ends.groupBy("v").agg(F.sum("hangs").alias("n"), F.max("holds").alias("holds")).where("n > 1 OR n = 1 AND holds = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) for every node but the smallest of its component: b is that smallest.

    Alternates the two star steps, each of which keeps the components, until
    all are stars; the number of rounds grows with the logarithm of the size.
    Links of a node with itself and repeated links are no matter.
    """
    edges = landed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(edges):
        edges = landed(_small_star(_large_star(edges)), "links")
    return edges
