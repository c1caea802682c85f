"""Connected components of links between long ids, by alternating large-star and small-star steps.

Each step moves links by aggregations that combine before their shuffle and joins whose hot sides Spark splits; the links
of every round are written to the shared folder. Nothing is collected but a count and a checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _pointed(edges: DataFrame, small: bool) -> DataFrame:
    """Every node's neighbours (small: its smaller ones; else larger ones) get its least neighbour or itself instead."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if small:
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node that links reach) for every node of ``links`` (columns a, b; any order, repeats and loops allowed)."""
    edges = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        large = _pointed(edges, small=False).filter("a <> b").distinct()
        edges = settle(_pointed(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), small=True).filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
