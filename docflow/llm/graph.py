"""Connected components of edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star algorithm: neighbours move to the smallest id around a vertex.

    The least neighbour comes from a partial aggregate and meets the edges in an equi-join, so a vertex with
    a third of all edges is split like any hot join key.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    met = near.join(least, near.a == least.k)
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex in ``edges`` (a, b); component is the smallest id reachable.

    Rounds follow the logarithm of the longest path. Each round is written to the checkpoint folder.
    """
    current = cut_lineage(edges.select("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(current)
    while before[0]:
        current = cut_lineage(_star(_star(current, True), False))
        now = _state(current)
        if now == before:
            break
        before = now
    out = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return out.unionByName(out.select(F.col("component").alias("id"), "component").distinct())
