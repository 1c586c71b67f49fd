"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pagemill.session import cut_lineage, drop_cut


def _stored(e: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and their number and check sum, counted while they are written."""
    seen = Observation()
    e = cut_lineage(e.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")), "edges")
    return e, (seen.get["n"], seen.get["s"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u BIGINT, v BIGINT): root is the component's
    smallest node. Nodes without an edge to another do not come out; nulls are no edges.

    Every step either changes the edges, which become stars of ever smaller nodes, or is the last,
    so the loop ends by itself; a component of n nodes takes some log(n) squared steps. A step is
    two aggregations with map-side combine and two joins. In these a hub has one row on the one
    side and its edges on the other, which adaptive execution divides among tasks where they are
    skewed (session.get_session turns that on). Every step's edges are written to the shared
    folder, so a lost executor costs one step at most.
    """
    e, before = _stored(edges.where("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new, after = _stored(moved.unionByName(low.withColumnRenamed("m", "v")).distinct())
        drop_cut(e)
        e = new
        if after == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = after
