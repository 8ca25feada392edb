"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.session import stage_table


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for every node but that one itself.

    By turns every node's larger neighbours, then its smaller ones, are tied to the smallest node around it,
    until only stars are left. The smallest neighbour is a partial aggregate, and a round's links are
    written to the shared folder, so a lost executor costs one round at most. No neighbourhood is collected.
    """
    both = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage_table(both, "links")
    before = None
    while True:
        # Larger neighbours of every node to the smallest of its neighbours and itself.
        sides = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = (
            edges.select(F.col("b").alias("node"), F.col("a").alias("larger"))
            .join(least, "node")
            .where("larger <> least")
            .select(F.col("larger").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        large = stage_table(large, "links")
        # Every node and its smaller neighbours to the smallest of these.
        least = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        small = large.join(least, F.col("a") == F.col("node")).where("b <> least")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stage_table(small.union(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = tuple(now)
