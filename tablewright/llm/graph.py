"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage


def _stars(links: DataFrame) -> bool:
    """Whether every u has one v and no v is a u: then each v is the root of its component."""
    several = links.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    inner = links.select("u").join(links.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
    return not several.union(inner).take(1)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root``: every node of ``edges`` (a, b) with the smallest node it can reach.

    Alternates two star contractions: every node sends its larger neighbours
    to its smallest one, then its smaller neighbours.  The number of
    rounds grows with the logarithm of the longest path.  Minima are partial
    aggregates and the other step is a plain join, so a hub with any number of
    links is never gathered in one task.  Every round is staged in the shared
    folder.  Self links and repeated links are allowed.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct(), "links")
    while not _stars(now):
        # larger neighbours go to the smallest neighbour (or the node itself)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        # every node has only smaller neighbours now: send them to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        after = stage(small, "links")
        discard(now)
        now = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
