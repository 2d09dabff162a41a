"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); root is the component's smallest node.

    Large-star and small-star steps (Kiveris and others, "Connected Components in
    MapReduce and Beyond", 2014) until the edges no longer change: rounds grow
    with the logarithm of the diameter, edges never outnumber the links, and
    nothing is gathered anywhere. Each round is a written table.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.write(edges, f"{name}0")
    before = None
    for number in count(1):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = scratch.write(small.select("e.u", "e.v").where("u <> v").distinct(), f"{name}{number}")
        scratch.drop(f"{name}{number - 1}")
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
        if now == before or now[0] == 0:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
