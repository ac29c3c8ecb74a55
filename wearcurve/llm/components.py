"""Connected components of a table of links, by alternating star rounds.

Each round hangs every node on the smallest node it sees: first its larger neighbours, then its smaller ones. The
number of rounds grows with the logarithm of the longest chain. Links stay in Spark; the driver sees one count and
one digest a round. Each round is a written table, so a lost executor costs that round alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.work import stage

MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component``: the smallest node reachable, for each node that has a link.

    Links are pairs of longs; nulls and links of a node with itself are ignored, repeats and directions do not matter.
    No links give an empty table.
    """
    a, b = F.col(a).cast("long"), F.col(b).cast("long")
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (a != b).alias("own"))
    pairs = stage(pairs.filter("own AND u IS NOT NULL AND v IS NOT NULL").select("u", "v").distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        pairs = stage(_small_star(_large_star(pairs)).distinct(), "links")
        count, digest = pairs.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (count, digest) == seen:
            break
        seen = (count, digest)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    hubs = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(hubs)


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest node among it and its neighbours."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of these."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))
