"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to one row per node (node, root), root the smallest node of its component.

    Each round does a large star and a small star: every neighbour of a node is
    tied to the smallest one. Minima are aggregated before the shuffle, and the
    join that spreads them has one row a node on its right side, so a node with
    very many neighbours can be split. The edges are written to the shared
    folder after each round. Self-loops and repeated edges are harmless; an
    edge with a null end is left out; no edges give no rows.
    """
    e = (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("whole"))
        .where("whole AND a <> b")
        .select("a", "b")
        .distinct()
    )
    e = staged(e, "components")
    before = None
    while True:  # the number of rounds grows with the logarithm of the largest component
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        star = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        e = staged(star.where("a <> b").distinct(), "components")
        after = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b"), F.col("b")).distinct())
