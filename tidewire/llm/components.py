"""Connected components by alternating large-star and small-star steps, as joins and aggregates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import cut


PARTITION_EDGES = 100_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v), u > v.

    large-star: every node joins its larger neighbours to the smallest of its neighbours and itself.
    small-star: every node joins itself and its smaller neighbours to the smallest of them.
    Minima are pre-aggregated; a node's neighbours are never gathered in one place."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select("v", "m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(id, component) for every id on an edge; component is the smallest id reachable.

    Each round's edges are written to the shared folder. An empty edge table gives an empty result; rows with
    a null end and self links are left out."""
    now = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    )
    rows, mark = now.count(), None
    for _ in range(most):
        # few edges lie in few partitions: one partition needs no exchange at all
        now = cut(_star(_star(now.coalesce(max(1, math.ceil(rows / PARTITION_EDGES))), True), False))
        # the sum of hashes names the set of edges; at a fixed point every node has one edge, to its root
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == mark:
            break
        rows, mark = row[0], row
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
