"""Connected components over an edge table by alternating min-label stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and sum of hashes: equal for equal sets of edges, in one pass without a shuffle of rows."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): component is the smallest node reachable.

    Large-star / small-star rounds (each a grouped minimum and a join on the
    node); every round is written to the shared folder, so lineage stays flat
    and nothing is gathered on the driver but a count and a sum per round. Self links
    and repeated links are harmless; an empty table gives an empty result.
    A node with very many neighbours is handled by partial aggregation and
    the skew-join splitting of Spark: no neighbour list is ever built.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    e = stored(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    nodes = e.select(F.col("a").alias("node")).union(e.select(F.col("b").alias("node"))).distinct()
    state = _fingerprint(e)
    while True:
        # large star: every neighbour larger than the node points to the least one around it
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: the node and its smaller neighbours point to the least of them
        small_min = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(small_min, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.*").where("a <> b").distinct()
        )
        e = stored(small, "cc")
        before, state = state, _fingerprint(e)
        if state == before:
            break
    return nodes.join(e.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
