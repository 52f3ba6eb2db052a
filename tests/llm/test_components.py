import random

from pyspark.sql import functions as F

from ledgerlake.llm.components import components


def plain(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_against_union_find(frame):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5), (-7, -9), (2**62, -9)]
    got = {r.node: r.component for r in components(frame("a long, b long", links)).collect()}
    assert got == plain([x for x in links if x[0] != x[1]])


def test_a_node_with_very_many_links(spark):
    """A star, its center neither the smallest nor the largest, tied to another."""
    star = spark.range(1, 100_001).select(F.lit(50_000).cast("long").alias("a"), F.col("id").alias("b"))
    more = spark.range(1000).select(F.lit(200_000).cast("long").alias("a"), (F.col("id") + 300_000).alias("b"))
    tie = spark.createDataFrame([(100_000, 300_500), (400_001, 400_000)], "a long, b long")
    sizes = components(star.unionByName(more).unionByName(tie)).groupBy("component").count()
    assert {r.component: r["count"] for r in sizes.collect()} == {1: 101_001, 400_000: 2}
    hub = components(star).agg(F.min("component"), F.max("component"), F.count("*")).first()
    assert tuple(hub) == (1, 1, 100_000)
