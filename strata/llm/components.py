"""Connected components by alternating stars, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges`` (a, b), any orderable type -> ``node, component``: the smallest
    node that each node with an edge reaches. Self-loops, repeated edges and
    edges with a null end link nothing and are ignored; no edges, no rows.

    Large star: every node sends its larger neighbours to the smallest node it
    knows. Small star: it sends its smaller neighbours and itself there. The
    two alternate until the edges stay the same: then each component is a star
    around its smallest node. A round is one partial aggregate for the minima
    and one join with them per star; both sides of the join are plain tables,
    so Spark splits the rows of a hub over tasks. Nothing reaches the driver
    but a count and a checksum.
    """
    big, small = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    linked = edges.select("a", "b").where(F.col("a") != F.col("b"))
    now = scratch.put(linked.select(big, small).distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        after = _star(_star(now, scratch, large=True), scratch, large=False)
        state = _state(after)
        scratch.drop(now)
        now = after
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct()
    )


def _star(edges: DataFrame, scratch: Scratch, large: bool) -> DataFrame:
    """Edges are (a, b) with a > b, once each, before and after."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        pairs = pairs.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = scratch.put(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    joined = pairs.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    result = scratch.put(out.distinct(), "edges")
    scratch.drop(least, *([edges] if not large else []))
    return result


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
