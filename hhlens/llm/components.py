"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _are_stars(e: DataFrame) -> bool:
    """Whether every larger end hangs on one smaller end that hangs on nothing."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("up")).union(
        e.select(F.col("v").alias("n"), F.lit(0).alias("up")))
    return not ends.groupBy("n").agg(F.sum("up").alias("ups"), F.min("up").alias("low")).where(
        "ups > 1 or (ups = 1 and low = 0)").count()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) of any integer ids -> (node, root), root the smallest id reachable.

    Each round hooks every larger neighbour to the smallest neighbour (first seen from the
    centre, then from the larger end); it halts when the edges are stars.  A node's minimum
    is aggregated with partial aggregation and joined back, so a hub needs no single task.
    Every round is written to the shared folder; nothing but a count reaches the driver."""
    e = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                 F.least("u", "v").alias("v")).distinct())
    while not _are_stars(e):
        sym = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join sees two plain exchanges and can split a hub's rows.
        low = cut_lineage(sym.groupBy("u").agg(F.min("v").alias("m"))
                          .select("u", F.least("u", "m").alias("m")))
        large = sym.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u")
        small = pairs.select("u", F.col("m").alias("v")).union(
            pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = cut_lineage(small.distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
