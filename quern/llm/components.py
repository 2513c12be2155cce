"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, salted_join, written


def _starred(links: DataFrame, key: str, other: str) -> DataFrame:
    """``links`` with each key's least neighbour; keys with many links are salted."""
    links = written(links, "links")
    least = written(links.groupBy(key).agg(F.min(other).alias("least"), F.count("*").alias("n")), "least")
    total = least.agg(F.sum("n")).first()[0] or 0
    return salted_join(links, least.drop("n"), key, hot_keys(least, key, "n", total), F.xxhash64(other))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b) but the roots, which are the least of their component.

    Each round moves links to smaller nodes and is a few shuffles of the links;
    the number of rounds grows with the logarithm of the longest path.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("p")).distinct()
    edges = written(edges, "edges")
    state = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("v", "p").cast("decimal(20,0)")), F.lit(0))).first())
        if now == state or not now[0]:
            return edges.select(F.col("v").alias("node"), F.col("p").alias("root"))
        state = now
        both = edges.select(F.col("v").alias("u"), F.col("p").alias("n")).unionByName(edges.select(F.col("p").alias("u"), F.col("v").alias("n")))
        large = _starred(both, "u", "n").where("n > u").select(F.col("n").alias("v"), F.least("least", "u").alias("p")).distinct()
        small = _starred(large, "v", "p")
        kept = small.where("p = least").select("v", "p")
        moved = small.where("p <> least").select(F.col("p").alias("v"), F.col("least").alias("p"))
        edges = written(kept.unionByName(moved).distinct(), "edges")
