"""Connected components of an undirected link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, release


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(links: DataFrame, max_rounds: int = 60, tidy: bool = False) -> DataFrame:
    """(node, component) for every node of links(a, b); the component is its smallest node.

    Each round is two group-by-minimum passes and a join back; links shrink towards stars around the smallest node, in a
    number of rounds that grows with the logarithm of the longest chain. Every round is written to the shared folder, so
    the plan stays short; ``tidy`` lets Spark drop a round's shuffle files after it. Nodes of no link are not listed. Self links
    and null ends are ignored.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links = materialize(links, "links")
    before = _mark(links)
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lows, "a").where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lows = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(lows, "a")
        small = joined.select(F.col("a"), F.col("low").alias("b")).unionByName(joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")))
        old, links = links, materialize(small.where("a > b").distinct(), "links")
        discard(old)
        after = _mark(links)
        if tidy:
            release(links.sparkSession)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    stars = links.groupBy("a").agg(F.min("b").alias("component"))
    roots = stars.select(F.col("component").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), "component").unionByName(roots.select("node", F.col("node").alias("component")))
