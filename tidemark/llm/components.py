"""Connected components of an edge table, as Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges(u, v)``; root is the smallest
    node that it reaches.

    Alternating large-star and small-star rounds: each round links neighbours
    to the smallest node seen, so the rounds grow with the logarithm of the
    longest path. Minima are aggregated before they meet the edges; no
    neighbour list is ever collected. Each round's edges are written to the
    shared folder. Self loops and repeated edges do no harm; no edges give no
    rows.
    """
    edges = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = _signature(edges)
    while seen[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")) \
            .union(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
