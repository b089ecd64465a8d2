"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

#: A node's links are dealt over parts of about so many, so that one node with very many links isn't one task.
PART_LINKS = 1 << 18


def _least(links: DataFrame, n_links: int) -> DataFrame:
    """``links`` (u, v) with column ``m``: the least v of that u."""
    dealt = links.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(1 + n_links // PART_LINKS)))
    parts = dealt.groupBy("u", "s").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"))
    return dealt.join(parts.select("u", "s").join(least, "u"), ["u", "s"]).drop("s")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the links; the component is its smallest node.

    Alternating large-star and small-star steps: each step points the larger neighbours of a node, then
    its smaller ones, at the smallest, and the links stay as many or fewer.  Every step is written to the
    shared folder; it ends when a step changes nothing.  Links with a null end and loops are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges, seen = save(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct())
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both, 2 * state[0]).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _least(large, state[0])
        moved = small.select("u", F.col("m").alias("v")).union(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = save(moved.distinct(), "links")
