"""Connected components by joins: every node is led to the smallest node it can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import stage


def connected(links: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of the undirected ``links`` (a, b); ``root`` is the smallest node of its component.

    Alternates two steps until nothing changes: every node hands its larger neighbours to the smallest one it knows, then its
    smaller neighbours. Each round writes its links, so a lost executor costs one round.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{label}-links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        # Larger neighbours of u go to the least of u and its neighbours.
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u").select(
            F.col("v").alias("u"), F.least("u", "low").alias("v")
        ).distinct()
        large = stage(large, f"{label}-large")
        # Smaller neighbours of u, and u, go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n"))
        told = large.join(least.filter("n > 1").select("u", "low"), "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        new = stage(told.union(least.select("u", F.col("low").alias("v"))).distinct(), f"{label}-small")
        total = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == total:
            break
        state, edges = total, new
    return new.select(F.col("u").alias("node"), F.col("v").alias("root")).union(new.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
