"""Connected components of a table of links, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runscope.llm.shared import discard, landed


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(edges: DataFrame, least: DataFrame, rows: int, hub: int = 100_000) -> DataFrame:
    """edges (a, b) with the m of their a; least: a, m, n: rows of a; rows: of edges, at most.

    Nodes with more than `hub` rows, of which there are one in `hub` rows at most, are sent along; fewer rows hold none.
    """
    if rows <= hub:
        return edges.join(least.select("a", "m"), "a").select("a", "b", "m")
    hubs = F.broadcast(least.filter(F.col("n") > hub).select(F.col("a").alias("_a"), F.col("m").alias("_m")))
    marked = edges.join(hubs, F.col("a") == F.col("_a"), "left")
    rest = marked.filter("_a is null").select("a", "b").join(least.filter(F.col("n") <= hub).select("a", "m"), "a")
    return rest.unionByName(marked.filter("_a is not null").select("a", "b", F.col("_m").alias("m")))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
    return _with_least(near, least, 2 * rows).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them; here a > b in every row."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    moved = _with_least(edges, least, rows).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of links (a, b): component is the smallest node reachable.

    Hubs: only minima per node are aggregated, before the shuffle; neighbour lists are never gathered in one row, and a hub's rows
    stay where they are. Each round is written to the shared folder, so lineage stays short, and the one before it is deleted. Rows with
    a null or with a = b are no links; an empty table gives none.
    """
    edges = landed(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, rows = None, edges.count()
    for _ in range(most_rounds):
        last, edges = edges, landed(_small_star(_large_star(edges, rows), 2 * rows), "links")
        discard(last)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before, rows = now, now[0]
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
