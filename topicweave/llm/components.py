"""Connected components of a link table, distributed (large star, small star).

Each round links every node's larger neighbours to the smallest node around
it, then the smaller ones; the labels settle in about log(n) rounds.  Rounds
are written to the shared folder, and only a sum reaches the driver.  Star
steps use aggregates and joins, so a hub with very many links is
pre-aggregated before the shuffle and no list of links is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.llm.common import stage_table


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    # u's smallest neighbour, itself included
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("c", "m").alias("m"))
    joined = both.join(low, F.col("u") == F.col("c"))
    if larger:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select(F.col("c").alias("u"), F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links`` (u, v) long -> (node, component): the smallest node reachable.

    Only nodes with a link appear.  Self links and repeats are allowed.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    edges = stage_table(edges, f"{name}-links")

    def state(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("u", "v").cast("decimal(25,0)"))).first()
        return tuple(r)

    before, step = state(edges), 0
    while before[0]:
        edges = stage_table(_star(_star(edges, True), False), f"{name}-{step}")
        now, step = state(edges), step + 1
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
