"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction of undirected ``edges`` (``a > b``). Large star: every larger neighbour of a node is
    linked to the least of the node and its neighbours; small star: every smaller one, and the node.

    The least neighbour comes from a partial aggregate and meets the edges in an equi-join that Spark
    may split, so a node with very many neighbours is no single group."""
    if larger:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
    return moved.where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``, longs, any order; null or equal ends
    are dropped): the least node reachable. Each round is a written table, so lineage stays short
    and lost executors cost one round; the number of rounds grows with the logarithm of the longest chain."""
    edges = written(links.where(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = F.struct(F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).alias("a"), F.sum(F.col("b").cast("decimal(20,0)")).alias("b"))
    before = None
    while True:
        now = edges.agg(mark.alias("mark")).first()["mark"]  # one row
        if now == before or now["n"] == 0:
            break
        before = now
        edges = written(_star(_star(edges, larger=True), larger=False), name)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
