"""Connected components of a link table (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import materialize, release


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` (the smallest node of its component) for every node of
    ``links`` (columns ``a, b``, long; any direction, repeats allowed).

    Each round hangs the neighbours of a node onto its smallest neighbour, first
    the larger ones, then the smaller ones, until the table of edges (node,
    smaller node) is a set of stars. Only the number and a checksum of the
    edges reach the driver; every round is written to the shared folder. Stars
    of any size are split by plain joins.
    """
    greatest, least = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = materialize(links.where("a <> b").select(greatest, least).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours go to the smallest.
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, "large-star")
        # Small star: the node and its smaller neighbours go to the smallest.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        small = materialize(small, "small-star")
        after = _state(small)
        release(edges, large)
        edges = small
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
