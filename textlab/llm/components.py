"""Connected components of an edge table, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.shared import drop_written, written


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _linked(rows: DataFrame, node: Column, low: Column) -> DataFrame:
    return rows.select(node.alias("u"), low.alias("v")).where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for every id of an edge.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each
    hangs a node's neighbours on the smallest of them. A node of any degree is
    aggregated map-side first, and the joins are plain equi-joins whose large
    partitions the adaptive planner splits. The driver sees two numbers a step.

    Nulls at either end and loops are ignored, repeated edges count once; an
    empty table gives an empty one.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    cur = written(_linked(e, F.greatest("u", "v"), F.least("u", "v")), "cc")
    seen = _fingerprint(cur)
    if not seen[0]:
        return cur.select(F.col("u").alias("id"), F.col("v").alias("component"))
    while True:
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _linked(both.join(low, "u").where("v > u"), F.col("v"), F.col("m"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = hung.union(low.select("u", F.col("m").alias("v"))).distinct()
        nxt = written(small, "cc")
        now = _fingerprint(nxt)
        drop_written(cur)
        cur = nxt
        if now == seen:
            return cur.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen = now
