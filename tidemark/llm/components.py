"""Connected components by alternating large and small stars; every step is a join and a grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours of every node to the smallest one: the larger neighbours, or the smaller ones and the node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        tied = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        tied = both.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = tied.unionByName(least.select("u", F.col("m").alias("v")))
    return tied.distinct()


def components(edges: DataFrame, left: str, right: str, most_rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) for every node of an edge; nodes without an edge give no row.

    Loops, repeated edges and null ends are ignored. Each round is written to the shared folder, so lineage
    stays short; the number of rounds grows with the logarithm of the longest path.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    now = settle(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u != v").distinct(),
        "edges",
    )
    marks = (F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = now.agg(*marks).first()
    for _ in range(most_rounds):
        if not before[0]:
            break
        now = settle(_star(_star(now, True), False), "edges")
        after = now.agg(*marks).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components have not settled")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
