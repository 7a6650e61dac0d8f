"""Connected components of a table of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import lookup_join
from .common import stored


def _least(links: DataFrame, strict: bool) -> DataFrame:
    """(node, other) with the least neighbour of ``node``; ``strict``: of the smaller ones only."""
    both = links if strict else links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return lookup_join(both, least, "node", "inner")


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step; ``other < node`` before and after."""
    near = _least(links, strict=False).withColumn("least", F.least("node", "least"))
    large = near.where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other")).where("other < node").distinct()
    near = _least(large, strict=True)
    small = near.select(F.col("other").alias("node"), F.col("least").alias("other")).unionByName(near.select("node", F.col("least").alias("other")))
    return small.where("other < node").distinct()


def _done(links: DataFrame) -> bool:
    """Whether every node has one ``other``, which is nobody's node: stars, whose centres are the roots."""
    ends = links.select(F.explode(F.array(F.struct(F.col("node").alias("x"), F.lit(1).alias("as_node")), F.struct(F.col("other").alias("x"), F.lit(0).alias("as_node")))).alias("e"))
    roles = ends.groupBy("e.x").agg(F.sum("e.as_node").alias("as_node"), F.min("e.as_node").alias("only_node"))
    return roles.where("as_node > 1 OR (as_node = 1 AND only_node = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (node, other: numbers): the least of its component.

    Alternating large-star and small-star rounds; every round is written to the shared folder,
    and the driver learns whether another is needed. Order, direction, repeats and loops don't matter;
    links with a null end are left out. No links give an empty table.
    """
    ends = links.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    current = stored(ends.where("other < node").distinct(), "links")
    while not _done(current):
        current = stored(_round(current), "links")
    roots = current.select("other").distinct().select(F.col("other").alias("node"), F.col("other").alias("root"))
    return current.select("node", F.col("other").alias("root")).unionByName(roots)
