"""Connected components of a table of links, by large-star and small-star rounds.

Every round is a few equi-joins and minima on the links' ends; a hot end is a
pre-aggregated key, never a collected group, and the links themselves never
reach the driver, which sees a count and a checksum for each round.  Each round
is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of any ordered type; returns (node, root): root is the least node that is reachable.

    Nodes without a link are absent.  Loops and repeated links do no harm.
    """
    edges = kept(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = kept(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        if (now := _signature(edges)) == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
