"""Connected components of a graph of links, by alternating large and small stars until nothing changes.

The links stay distributed; only their count and a checksum reach the driver. Each step is a minimum per node, reduced
before its shuffle, joined back to the links. The join goes by the complement of the node, which the aggregate's shuffle does not
serve: so it has exchanges of its own, and adaptive execution can split the rows of a node with very many links, or broadcast the
minima where they are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.storage import stored


def _stars(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): v tied to the smallest of u and all of u's."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.bitwise_not("u").alias("key"), F.least("u", "m").alias("m"))
    return pairs.withColumn("key", F.bitwise_not("u")).join(least, "key").drop("key")


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of long ids -> (node, component): the smallest id reachable, for every node that has a link."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        tied = _stars(large)
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u <> v").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
