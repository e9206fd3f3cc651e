"""Connected components of an edge table, as rounds of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs of longs to (node, root): the least node reachable from each.

    Every round hangs the larger neighbours of a node, then the smaller ones, on the least
    of them, and writes the edges to the shared folder; it ends when a round changes nothing.
    The number of rounds grows with the logarithm of the longest path."""
    star = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .distinct(), "edges")
    before = None
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # larger neighbours move to the least neighbour (or the node itself)
        star = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        # smaller neighbours, and the node, move to the least of them
        star = star.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").where("a <> b").distinct()
        star = cut_lineage(star, "edges")
        now = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = star.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
