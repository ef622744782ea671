"""Connected components of a link table by star contraction.

Rounds of large stars (every greater neighbour links to the least one) and small
stars (every smaller neighbour does) flatten each component into a star around
its least node, in a number of rounds that grows with the logarithm of its
diameter. Each round is a few joins of links, whose result is written to the
shared folder; nothing is collected but two numbers that tell when to stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import cut, drop_cut, salted_lookup


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return salted_lookup(both.where("b > a"), least, ["a"], "b").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = salted_lookup(down, least, ["a"], "b")
    return (near.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(least.select("a", F.col("m").alias("b"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b, long); root is the
    least node reachable. Self links and repeated links are harmless."""
    state, now = None, cut(_small_star(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))), "links")
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == tuple(seen):
            break
        before, state, now = now, tuple(seen), cut(_small_star(_large_star(now)), "links")
        drop_cut(before)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
