"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import cut_lineage


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the neighbours of each node (larger or not larger ones) to its smallest neighbour or itself.

    ``edges`` has pairs u > v. The smallest neighbour is aggregated and joined back: a node's neighbours never meet in one group.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b); the label is the smallest node of the component.

    Large and small stars alternate until the edges stay the same; then each node points at its label. The number of
    rounds grows with the logarithm of the nodes.
    """
    pairs = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current, before = cut_lineage(pairs), None
    while True:
        current = cut_lineage(star(star(current, True), False))
        state = current.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if before == state:
            break
        before = state
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
