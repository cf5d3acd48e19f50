"""Connected components of a link table, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b): root is the smallest node that it reaches.

    Alternates large and small stars until nothing changes: every node's larger (then smaller)
    neighbours are tied to its smallest one, so that each component ends as a star. The smallest
    neighbour per node is written before it is joined, which lets adaptive execution split the join of a
    node with very many neighbours.
    """
    pairs = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = cut(pairs.distinct())
    before, now = None, _state(edges)
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, now = now, _state(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
