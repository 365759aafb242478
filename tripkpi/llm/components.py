"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.tables import staged


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): each linked id and the smallest id it reaches; ``links`` has columns a and b.

    Each round hooks every id's larger neighbours to its smallest one, then its
    smaller ones; stars need O(log n) rounds in practice. A round is written
    to shared storage. Hot ids are aggregated map-side; no group is collected.
    """
    edges = staged(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(low, both.a == low.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        near = large.join(low, large.a == low.u)
        small = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(near.select("a", F.col("m").alias("b")))
        edges = staged(small.where("a != b").distinct(), "cc")
        # a star forest has one edge per leaf and no centre that is a leaf
        n, mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, mark) == seen:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen = (n, mark)
    raise RuntimeError("components did not settle")
