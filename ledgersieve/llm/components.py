"""Connected components of a table of links, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgersieve.llm.store import written


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of the component.

    Alternates two steps until nothing changes: every larger neighbour of a node is
    linked with the node's smallest neighbour, then every smaller one.  Each step keeps
    the components and shortens paths, so the number of rounds grows with the logarithm
    of the longest path.  Every round is written, so no lineage grows.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    edges = written(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    last = None
    while (now := _digest(edges)) != last:
        last = now
        # Larger neighbours go to the smallest of the neighbourhood.
        two = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = two.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = two.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v"), label)
        # Smaller neighbours, and the node itself.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        edges = written(small.where("u <> v").distinct(), label)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
