"""Property-graph operators: theta pairs, pattern hops and variable-length trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.runtime import cut_lineage, lookup, small


def theta_pairs(left: DataFrame, right: DataFrame, condition: Column, blocks: list[Column] | None = None) -> DataFrame:
    """Pairs of two vertex sets under an arbitrary condition.

    ``blocks`` adds equalities, which make it an equi-join at any size. Without an
    equality the pairs are a product by definition: the right side must then be
    counted to be small enough for a broadcast, else it is an error.
    """
    if blocks:
        for b in blocks:
            condition = condition & b
        return left.join(right, condition)
    right = cut_lineage(right)
    if not small(right):
        raise ValueError("pairs without an equality need a small right side")
    return left.join(F.broadcast(right), condition)


def pattern_hop(nodes: DataFrame, edges: DataFrame, targets: DataFrame, start: Column, edge_types: tuple[str, ...], end: Column | None = None) -> DataFrame:
    """(node)-[edge]->(target): filtered start nodes, edges of the given types, target nodes.

    ``nodes`` and ``targets`` have id (unique), label and name; filters run before the joins.
    """
    n = nodes.where(start).select(F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    e = edges.where(F.col("relationship_type").isin(*edge_types)).select("source_id", "target_id", "relationship_type")
    t = (targets.where(end) if end is not None else targets).select(F.col("id").alias("target_id"), F.col("name").alias("target_name"))
    return lookup(lookup(e, cut_lineage(n), ["source_id"], "inner"), cut_lineage(t), ["target_id"], "inner").select("source_id", "source_name", "relationship_type", "target_id", "target_name")


def trails(edges: DataFrame, start: DataFrame, edge_types: tuple[str, ...] | None = None, max_hops: int = 10) -> DataFrame:
    """(start, end, hops, path) of all trails from the start nodes, one to ``max_hops`` edges long.

    A trail uses no edge twice, so cycles end. ``edges``: edge_id, source_id,
    target_id, relationship_type; ``start``: id. Each hop is one equi-join on the
    frontier, which is materialised, so no hop is computed twice.
    """
    e = edges.where(F.col("relationship_type").isin(*edge_types)) if edge_types else edges
    e = e.select("edge_id", F.col("source_id").alias("at"), F.col("target_id").alias("to"))
    front = start.select(F.col("id").alias("start"), F.col("id").alias("at"), F.array().cast("array<string>").alias("used"), F.array(F.col("id").cast("string")).alias("path"))
    out = None
    for hop in range(1, max_hops + 1):
        front = (
            front.join(e, "at")
            .where(~F.array_contains("used", F.col("edge_id").cast("string")))
            .select("start", F.col("to").alias("at"), F.array_append("used", F.col("edge_id").cast("string")).alias("used"), F.array_append("path", F.col("to").cast("string")).alias("path"))
        )
        front = cut_lineage(front)
        step = front.select("start", F.col("at").alias("end"), F.lit(hop).alias("hops"), F.array_join("path", ">").alias("path"))
        out = step if out is None else out.unionByName(step)
        if front.isEmpty():
            break
    return out


def earliest_then_follow(nodes: DataFrame, edges: DataFrame, first: Column, follow: tuple[str, ...], last: tuple[str, ...], limit: int = 10, max_hops: int = 6) -> DataFrame:
    """The earliest node that passes ``first`` (by year, then id), trails of ``follow`` edges from it, one ``last`` edge; the first ``limit`` rows by path."""
    begin = nodes.where(first).orderBy(F.col("year").asc_nulls_last(), "id").limit(1).select("id")
    walk = trails(edges, begin, follow, max_hops)
    end = edges.where(F.col("relationship_type").isin(*last)).select(F.col("source_id").alias("end"), F.col("target_id").alias("reached"))
    return walk.join(end, "end").select("start", "end", "hops", "path", "reached").orderBy("path", "reached").limit(limit)
