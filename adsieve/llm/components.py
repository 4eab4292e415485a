"""Connected components of a graph that stays distributed: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm.storage import keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of a node to the least of them: the larger ones (both directions seen), or the smaller ones."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(least, "u")
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    own = linked.select("u", F.col("m").alias("v"))
    others = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.union(others)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the least node that it reaches."""
    way = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now, before = keep(way, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        now = keep(_star(_star(now, True).distinct(), False).distinct(), "edges")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(now.select(F.col("v"), F.col("v")).distinct())
