"""Connected components of a table of links, by alternating star contraction.

Every round rewrites the links so that nodes point at the smallest node they
know of: the large step moves larger neighbours, the small step smaller ones.
It ends when a round changes nothing, as stars whose hub is the smallest node
of its component.  Each round is written to the shared folder, which cuts the
lineage and survives lost executors.  A node with many links is spread by
partial aggregation and by skew-join splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.tables import materialize


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links written and read again, and their number and a sum over their hashes, observed by the write."""
    seen = Observation()
    table = materialize(links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "links")
    return table, (seen.get["n"], seen.get["sum"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link to another node; component = smallest node reachable.

    Null ends and self links are ignored; repeated links and both directions are allowed.
    """
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    edges, state = _written(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        small = (small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        edges, after = _written(small)
        if after == state:
            break
        state = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
