"""Connected components of an edge table by alternating large and small stars.

Each round every node points its larger neighbours, then its smaller ones, at
the smallest node it sees; the edges end as one star per component. Rounds are
grouped aggregations and joins on nodes, each result written to the shared
checkpoint folder, so neither edges nor labels ever gather in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, settle


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: link larger neighbours to the smallest of a node and all its neighbours.
    Small star: link smaller neighbours and the node itself to the smallest of them."""
    both = edges.select("a", "b")
    if larger:
        both = both.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
    linked = both.join(low, "a")
    out = linked.where(F.col("b") > F.col("a") if larger else F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not larger:
        out = out.unionByName(low.select("a", F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns a, b of any orderable type. Returns (node, component), component the
    smallest node reachable, for every node that has an edge to another one."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = settle(e, "edges")
    mark = None
    while True:
        before, e = e, settle(_star(_star(e, True), False), "edges")
        forget(before)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
