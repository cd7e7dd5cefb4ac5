"""Connected components of a graph given as edges, by alternating large and small stars.

Each round replaces edges so that nodes point to smaller neighbours; it ends when every component is a star around
its smallest node. Only aggregates and joins on node ids are used: no list of a node's neighbours and no component is ever
in one task or at the driver, and a node that a third of all edges have is joined by broadcast (``common.joined``). Each round's edges are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, few_files, hot_keys, joined, written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large(edges: DataFrame, hubs: list) -> DataFrame:
    both = _both(edges)
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return joined(both.where("v > u"), least, "u", hubs).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small(edges: DataFrame, hubs: list) -> DataFrame:
    """edges with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = joined(edges, least, "u", hubs).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def stars(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v): every node of a component but its smallest, with that smallest node. edges: (u, v) of any order, no nulls."""
    pairs = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = written(few_files(pairs), "edges"), None
    for _ in range(rounds):
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.coalesce(F.sum(F.expr("cast(pmod(xxhash64(v, u), 4294967296L) as decimal(38,0))")), F.lit(0))).collect()[0]
        if mark == before or not mark[0]:
            return now
        before = mark
        hubs = hot_keys(_both(now).groupBy("u").agg(F.count("*").alias("n")), "u", 2 * mark[0])  # after the large star no node has more edges than now
        new = written(few_files(_small(_large(now, hubs), hubs)), "edges")
        dropped(now)
        now = new
    raise RuntimeError(f"components did not settle in {rounds} rounds")
