"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.storage import store


def _star(edges: DataFrame, folder: str, name: str, large: bool) -> DataFrame:
    """One star step: every node hands its larger (large) or its smaller neighbours (small) to the smallest one."""
    ends = edges if not large else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ends.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    joined = ends.join(store(least, folder, f"{name}-least"), "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        own = joined.select("a", F.col("low").alias("b"))
        moved = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(own)
    return store(moved.where("a <> b").distinct(), folder, name)


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node and root (smallest node that can be reached) for every end of the edges (a, b); roots themselves are not listed.

    Large-star and small-star steps alternate until nothing changes, some log n rounds. Each step's edges are written to ``folder``,
    and a node's neighbours are never gathered: its smallest one is an aggregate that is joined back.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current, before, step = store(pairs, folder, "edges"), None, 0
    while True:
        seen = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = seen
        current = _star(current, folder, f"large-{step}", large=True)
        current = _star(current, folder, f"small-{step}", large=False)
        step += 1
