"""Connected components of a table of links, by alternating stars; nothing reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.lookup import lookup_join
from tidelog.session import stage

# Beyond this size a lookup is joined by a shuffle, in which a hot key is split.
LOOKUP_BYTES = 8 << 20


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``links`` (``a, b``): the smallest id it is linked with.

    Each round a node hands its larger neighbours (large star), then its smaller ones (small star),
    to its smallest neighbour. Only minima are aggregated, so that a node with very many links
    never gathers them, and every round's links are stored in the shared folder.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")), "least")
        near = lookup_join(both, least, "u", "inner", LOOKUP_BYTES).where("v > u")
        large = near.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        least = least.where("m < u").select("u", F.col("m").alias("v"))
        large = stage(large.unionByName(least).distinct(), "large-star")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        near = lookup_join(large, low, "u", "inner", LOOKUP_BYTES).where("v > m")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stage(
            small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star"
        )
        if _digest(small) == _digest(edges):
            return small.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                small.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        edges = small


def _digest(edges: DataFrame) -> tuple:
    """Equal for equal tables: rows, and a sum that does not depend on their order."""
    low = F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1)))
    return tuple(edges.agg(F.count("*"), F.coalesce(low, F.lit(0))).first())
