"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum joined back to the edges, so a hub's edges are combined before
the shuffle and its join partition can be split; no component or neighbour list is collected.
The edge table of each round is written to the shared folder and the one before is dropped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camstat.session import drop_path, written_at


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (a, b) of one block contracted: each node with the smallest node it reaches there,
    nodes that reach none smaller left out.  Same components, at most one edge for each node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, root = at[: len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v."""
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = both.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of an edge, the smallest node of its component.

    Nodes are of any ordered type.  Loops, repeated edges and edges in both directions are welcome;
    edges with a null end are ignored; no edges give no rows."""
    spark = edges.sparkSession
    now, path = written_at(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    seen = None
    while True:
        # Order-free fingerprint of the edge set: unchanged when every node points at its root.
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        after, new = written_at(_star(_star(now, True), False), "edges")
        drop_path(spark, path)
        now, path = after, new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
