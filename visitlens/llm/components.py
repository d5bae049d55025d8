"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import cut


def _to_least(edges: DataFrame, only_larger: bool) -> DataFrame:
    """Connect neighbours (and the node itself) to the least node of each neighbourhood."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = edges.join(least, "u")
    if only_larger:
        return hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
        least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every node of ``edges`` (a, b: long); the label is the component's least node.

    The edge table shrinks to stars and is checkpointed in each round; rounds grow with the logarithm of the
    longest path. Only a count and a checksum reach the driver.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(ordered)
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _to_least(both, only_larger=True).where("a <> b").distinct()
        small = _to_least(large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), only_larger=False)
        edges = cut(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return members.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())
