"""Repeated-detection removal.

A static false detection (a branch, a rock) repeats at nearly the same box in
many images of one folder.  Pairs with IoU >= t are found without comparing
every box of a folder:

* IoU >= t forces the widths and the heights of the two boxes within a factor t, so boxes
  fall into size classes ``k = floor(log(side) / log(c))``, ``c = t^-4``, for each side;
* it also forces ``|dx| <= (1-t) max(w)`` and ``|dy| <= (1-t) max(h)``, at most
  ``(1-t)/t`` times the own side of either box; a class has tiles four such reaches wide.

A node lies in the tile of its own corner and class, and once more in the next tile (or class)
of each of the four dimensions only where its reach (or its side over t) goes beyond the border:
about two rows a node.  Both boxes of a pair are then found in the tile of the larger x, y, w
and h, and there alone, for each dimension, one of the two is at home (``_own`` has a bit
for each): so an equi join on the tile yields each pair once, and the exact IoU filters.

Equal boxes of a folder are collapsed to one weighted node first, so a static box
repeated n times is one row, not n^2 pairs.

A tile with more than ``BLOCK`` nodes (only folders with more than that many can have one) is
divided into blocks by a hash of the box.  Pairs come from a join of every two blocks.  Repeat
groups need no pair rows from such a tile: each pair of blocks returns a forest of its links
(numpy, bounded block sizes), and the groups are the connected components of those forests
and of the pairs of the other tiles.
"""

from __future__ import annotations

import functools
import math
import operator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camstat.functions.geometry import iou
from camstat.operators.components import components, forest
from camstat.operators.joins import join_back
from camstat.session import written

#: Most nodes of a tile that are joined row by row, and most that meet in one block.
BLOCK = 1024
#: Dimensions of a tile: class of width and of height, place of x and of y.
TILE = ["_kw", "_kh", "_gx", "_gy"]


def _at(lo, hi, bit: int):
    """One row for ``lo``, which is home, and one for ``lo + 1`` if ``hi`` lies beyond ``lo``."""
    home = F.struct(lo.alias("at"), F.lit(bit).alias("own"))
    return F.explode(F.when(hi > lo, F.array(home, F.struct((lo + 1).alias("at"), F.lit(0).alias("own")))).otherwise(F.array(home)))


def _tiles(nodes: DataFrame, t: float, keep: list[str], folder: str, x: str, y: str, w: str, h: str) -> DataFrame:
    """Each node in the tiles where it can meet a partner: ``folder``, the tile, ``_own``, the box
    as ``_x, _y, _w, _h`` and the columns to keep.  Boxes without an area, or with a value that
    is null or not finite, overlap with nothing."""
    c, beyond = math.log(t) * -4, 1 + 1e-6  # reaches are a little longer, against rounding
    out = nodes.select(folder, *keep, *[F.col(v).cast("double").alias(n) for n, v in zip(("_x", "_y", "_w", "_h"), (x, y, w, h))])
    finite = [F.abs(v) < float("inf") for v in ("_x", "_y", "_w", "_h")]
    out = out.filter(F.col(folder).isNotNull() & (F.col("_w") > 0) & (F.col("_h") > 0) & functools.reduce(operator.and_, finite))
    for bit, (k, side) in enumerate((("_kw", "_w"), ("_kh", "_h"))):
        lo = F.floor(F.log(side) / c).cast("int")
        out = out.withColumn(k, _at(lo, F.floor((F.log(side) - math.log(t) * beyond) / c).cast("int"), 1 << bit))
    for bit, (g, corner, k, side) in enumerate((("_gx", "_x", "_kw", "_w"), ("_gy", "_y", "_kh", "_h")), 2):
        wide = F.lit(4 * (1 - t) / t) * F.exp((F.col(f"{k}.at") + 1) * c)
        reach = F.col(corner) + F.col(side) * ((1 - t) / t * beyond)
        out = out.withColumn(g, _at(F.floor(F.col(corner) / wide), F.floor(reach / wide), 1 << bit))
    own = functools.reduce(lambda p, q: p.bitwiseOR(q), [F.col(f"{d}.own") for d in TILE])
    return out.select(folder, *[F.col(f"{d}.at").alias(d) for d in TILE], own.alias("_own"), "_x", "_y", "_w", "_h", *keep)


def box_nodes(boxes: DataFrame, folder: str, key: str, x: str, y: str, w: str, h: str) -> DataFrame:
    """One row per distinct box of a folder: ``node`` (a number), ``rep`` (its smallest key)
    and ``n`` boxes; written once, so the numbers stay."""
    g = boxes.groupBy(folder, x, y, w, h).agg(F.min(key).alias("rep"), F.count("*").alias("n"))
    return written(g.withColumn("node", F.monotonically_increasing_id()), "box-nodes")


def _crowded(nodes: DataFrame, tiles: DataFrame, folder: str) -> DataFrame | None:
    """Tiles with more than ``BLOCK`` nodes and the number of their blocks; none: there are no such.
    A node is in a tile once, so only folders with as many nodes are looked at."""
    large = written(nodes.groupBy(folder).count().filter(F.col("count") > BLOCK).select(folder), "large-folders")
    if large.isEmpty():
        return None
    big = (tiles.join(large, folder, "left_semi").groupBy(folder, *TILE)
           .agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_parts")).filter("_parts > 1"))
    big = written(big, "big-tiles")
    return None if big.isEmpty() else big


def _side(tiles: DataFrame, name: str, keys: list[str]) -> DataFrame:
    return tiles.toDF(*[c if c in keys else name + c for c in tiles.columns])


def _meetings(nodes: DataFrame, t: float, keep: list[str], folder: str, x: str, y: str, w: str, h: str):
    """(pairs of nodes that share a tile, each once; the blocks ``a`` and ``b`` of crowded tiles, or
    none; the keys on which those meet).  Columns of the two nodes begin with ``a`` and ``b``."""
    tiles = _tiles(nodes, t, keep, folder, x, y, w, h)
    keys, big = [folder, *TILE], _crowded(nodes, tiles, folder)
    few = tiles if big is None else tiles.join(big, keys, "left_anti")
    box = ("_x", "_y", "_w", "_h")
    once = F.struct(*[f"a{c}" for c in box]) < F.struct(*[f"b{c}" for c in box])
    pairs = _side(few, "a", keys).join(_side(few, "b", keys), keys).filter(once)
    if big is None:
        return pairs, None, None, keys
    blocks = tiles.join(big, keys).withColumn("_part", F.pmod(F.xxhash64(*box), F.col("_parts")).cast("int"))
    a = _side(blocks.withColumn("_ap", F.col("_part")).withColumn("_bp", F.explode(F.expr("sequence(_part, _parts - 1)"))).drop("_part", "_parts"),
              "a", [*keys, "_ap", "_bp"])
    b = _side(blocks.withColumn("_bp", F.col("_part")).withColumn("_ap", F.explode(F.expr("sequence(0, _part)"))).drop("_part", "_parts"),
              "b", [*keys, "_ap", "_bp"])
    return pairs, a, b, [*keys, "_ap", "_bp"]


def _overlapping(met: DataFrame, t: float) -> DataFrame:
    """Pairs with IoU >= t, in the one tile where a home of either is in every dimension."""
    v = iou("a_x", "a_y", "a_w", "a_h", "b_x", "b_y", "b_w", "b_h")
    return met.filter(F.col("a_own").bitwiseOR(F.col("b_own")) == 15).withColumn("iou", v).filter(F.col("iou") >= t)


def repeat_pairs(boxes: DataFrame, iou_t: float = 0.85, conf_t: float = 0.1,
                 folder: str = "folder", key: str = "box_id", x: str = "x", y: str = "y",
                 w: str = "w", h: str = "h", conf: str = "confidence") -> DataFrame:
    """Pairs ``(a, b)`` of different boxes of one folder with IoU >= ``iou_t``, both
    with confidence >= ``conf_t``.  Equal boxes are one: ``a < b`` are the smallest keys of the
    two, ``n_a`` and ``n_b`` the number of boxes each stands for (all equal boxes pair at 1)."""
    nodes = box_nodes(boxes.filter(F.col(conf) >= conf_t), folder, key, x, y, w, h)
    met, a, b, keys = _meetings(nodes, iou_t, ["rep", "n"], folder, x, y, w, h)
    p = _overlapping(met, iou_t)
    if a is not None:
        box = ("_x", "_y", "_w", "_h")
        once = (F.col("_ap") < F.col("_bp")) | (F.struct(*[f"a{c}" for c in box]) < F.struct(*[f"b{c}" for c in box]))
        p = p.unionByName(_overlapping(a.join(b, keys).filter(once), iou_t).select(*p.columns))
    swap = F.col("arep") > F.col("brep")
    return p.select(
        folder, F.least("arep", "brep").alias("a"), F.greatest("arep", "brep").alias("b"), "iou",
        F.when(swap, F.col("bn")).otherwise(F.col("an")).alias("n_a"), F.when(swap, F.col("an")).otherwise(F.col("bn")).alias("n_b"))


def _overlaps(p, q, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i of p, j of q) of boxes with IoU >= t."""
    ax, ay, aw, ah = (p[c].to_numpy(float)[:, None] for c in ("a_x", "a_y", "a_w", "a_h"))
    bx, by, bw, bh = (q[c].to_numpy(float)[None, :] for c in ("b_x", "b_y", "b_w", "b_h"))
    inter = np.maximum(0.0, np.minimum(ax + aw, bx + bw) - np.maximum(ax, bx))
    inter *= np.maximum(0.0, np.minimum(ay + ah, by + bh) - np.maximum(ay, by))
    union = aw * ah + bw * bh - inter
    return np.nonzero((union > 0) & (inter >= t * union))


def repeat_links(nodes: DataFrame, iou_t: float = 0.85, folder: str = "folder", x: str = "x", y: str = "y",
                 w: str = "w", h: str = "h") -> DataFrame:
    """Links ``(a, b)`` of nodes whose connected components are those of all overlapping pairs:
    each pair of blocks of a crowded tile returns at most one link for each of its nodes."""
    import pandas as pd

    met, pr, ins, keys = _meetings(nodes, iou_t, ["node"], folder, x, y, w, h)

    def meet(probes, inserted):
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        pa, pb = probes["anode"].to_numpy(np.int64), inserted["bnode"].to_numpy(np.int64)
        for i in range(0, len(probes), 512):
            u, v = _overlaps(probes.iloc[i:i + 512], inserted, iou_t)
            u, v = pa[i:i + 512][u], pb[v]
            own = u != v
            if own.any():
                p, q = forest(u[own], v[own])
                a.append(p)
                b.append(q)
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            a, b = forest(a, b)
        return pd.DataFrame({"a": a, "b": b})

    few = _overlapping(met, iou_t).select(F.col("anode").alias("a"), F.col("bnode").alias("b"))
    if pr is None:
        return few
    return few.unionByName(pr.groupBy(*keys).cogroup(ins.groupBy(*keys)).applyInPandas(meet, "a long, b long"))


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """``nodes(node)``, ``edges(a, b)`` -> ``(node, component)``; the component id is the smallest
    node of it, a node without edges is its own."""
    found = components(edges).withColumnRenamed("node", "_n")
    return (nodes.select(node).distinct().join(found, F.col(node) == F.col("_n"), "left")
            .select(node, F.coalesce("component", node).alias("component")))


def suppress_repeats(boxes: DataFrame, min_count: int = 3, iou_t: float = 0.85, conf_t: float = 0.1,
                     folder: str = "folder", key: str = "box_id", x: str = "x", y: str = "y",
                     w: str = "w", h: str = "h", conf: str = "confidence") -> DataFrame:
    """Boxes in a repeat group of at least ``min_count`` boxes get a negative
    confidence (``-abs``); adds ``repeat_group`` (the smallest key of the group) and
    ``group_size``.  Boxes below ``conf_t`` are left as they are."""
    cand = boxes.filter(F.col(conf) >= conf_t)
    nodes = box_nodes(cand, folder, key, x, y, w, h)
    linked = components(repeat_links(nodes, iou_t, folder, x, y, w, h))
    # a node without links is a group of its own: only if it stands for enough boxes
    named = (nodes.join(linked, "node", "left").filter(F.col("component").isNotNull() | (F.col("n") >= min_count))
             .withColumn("component", F.coalesce("component", "node")))
    named = written(named, "repeat-nodes")
    groups = (named.groupBy(F.col("component").alias("_c"))
              .agg(F.sum("n").alias("group_size"), F.min("rep").alias("repeat_group"))
              .filter(F.col("group_size") >= min_count))
    tagged = written(named.join(groups, F.col("component") == F.col("_c"), "inner")
                     .select(folder, x, y, w, h, "repeat_group", "group_size"), "repeat-groups")
    out = join_back(boxes, tagged, [folder, x, y, w, h], "left")
    hit = F.col("repeat_group").isNotNull() & (F.col(conf) >= conf_t)
    return (out.withColumn("_hit", F.coalesce(hit, F.lit(False)))
            .withColumns({conf: F.when(F.col("_hit"), -F.abs(F.col(conf))).otherwise(F.col(conf)),
                          "repeat_group": F.when(F.col("_hit"), F.col("repeat_group")),
                          "group_size": F.when(F.col("_hit"), F.col("group_size"))}).drop("_hit"))
