"""Connected components of a link table by alternating large-star and small-star steps.

Each step groups links by node with a partial minimum and joins it back, so a node with very many links is
combined on the map side and its join side may be split by AQE. Every step is a written table; the driver
only sees a count and a checksum to tell when nothing changes any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostage.llm.common import saved


def _sum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links`` but the roots themselves; a root is its component's smallest node."""
    edges = saved(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    state = _sum(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u points to the smallest of u and its neighbours
        edges = saved(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        # small star: u and its smaller neighbours point to the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = saved(edges.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct(), "small-star")
        before, state = state, _sum(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
