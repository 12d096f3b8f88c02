"""Classes of a graph given by its edges, with a number of rounds logarithmic in the length of chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.session import materialise


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang neighbours on the smallest node nearby: all larger ones (large star), or all smaller ones and the node itself
    (small star). Minima are pre-aggregated, so a node with very many neighbours is no single task's work; the join that
    follows is split by adaptive execution where it is uneven."""
    if small:
        pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        joined = pairs.join(low, "u")
        hung = joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return hung.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (pairs.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def classes(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of an edge, root being the smallest node of its class.

    Alternates large and small stars until the edges stop changing; they then are stars around the smallest node. Every
    round is written to the shared folder, so lineage stays short and a lost executor costs one round at most.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    print_of = lambda df: df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    before = print_of(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        now = materialise(_star(_star(now, False), True), "stars")
        after = print_of(now)
        if tuple(after) == tuple(before):
            break
        before = after
    else:
        raise RuntimeError("classes did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
