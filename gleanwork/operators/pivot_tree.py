"""Exact nearest neighbours over a tree of pivots.

A node with more points than a leaf may hold picks pivots among its points by
their hash, and every point goes to the nearest pivot. Levels are added until
all parts are leaves, so no part grows with the table and no list of all
pivots exists anywhere. A search descends the levels as rows
``(point, node)``: triangle inequalities and the planes between sibling
pivots bound the distance to a node from below, the nearest points of each
node bound the k-th distance from above, and nodes out of reach are dropped.
The bounds are safe, so no neighbour is ever missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gleanwork.functions.joins import fits_broadcast, term_join
from gleanwork.functions.numbering import numbered
from gleanwork.operators.blocks import BLOCK_ROWS, packed, squared_distances
from gleanwork.session import settle

#: Most points of a leaf, and most pivots of a node.
LEAF_ROWS = 4 * BLOCK_ROWS
FAN = 256

_BOUND_FROM = 16  # children that give a first bound
_SLACK = 1e-9
_PROBE = 4096  # points that tell whether a tree is worth it
_PROBE_PIVOTS = 32
_REACHED = 0.5  # share of the parts that a search may have to visit


class Tree(NamedTuple):
    """``points`` are the train points with the leaf ``node`` they ended in;
    ``levels`` the nodes of each depth that were split: ids of their children,
    their pivots in a row, and per child its radius and the smallest offsets
    from its pivot (padded with infinity). The root is node 0."""

    points: DataFrame
    levels: list[DataFrame]


def _blocks_of(rows: DataFrame, nodes: DataFrame, carry: list[str]) -> DataFrame:
    """Blocks of rows of one node each, with the node's pivots: broadcast while
    they are few, else shuffled with salts, as one node may hold most blocks."""
    blocks = packed(rows, "node", carry)
    return term_join(blocks, nodes, "node", "block", fits_broadcast(nodes))


def build(train: DataFrame, key: str, carry: Sequence[str], k: int) -> Tree:
    """The tree of ``<key, carried..., _x>``; the offsets of the ``k`` nearest
    points are kept per node."""
    kept = [key, *carry]
    points = train.select(*kept, "_x", F.lit(0).cast("long").alias("node"))
    levels: list[DataFrame] = []
    if points.count() <= LEAF_ROWS:
        return Tree(points, levels)
    next_node = 1
    while True:
        # A node of one point, however often repeated, cannot be split. Each
        # of two or more pivots keeps its own points, so every part is smaller.
        sizes = points.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")
        )
        large = sizes.filter((F.col("n") > LEAF_ROWS) & (F.col("low") != F.col("high")))
        wanted = F.least(F.ceil(F.col("n") / LEAF_ROWS) + 1, F.lit(FAN)).alias("wanted")
        open_ = settle(numbered(large.select("node", "n", wanted), [F.col("node")], "number"))
        count = open_.count()
        if not count:
            return Tree(points, levels)
        small = fits_broadcast(open_)
        inner = settle(term_join(points, open_, "node", key, small))
        by_hash = Window.partitionBy("node").orderBy("_hash", "_x")
        # Children are numbered over the whole tree.
        child = F.lit(next_node) + (F.col("number") - 1) * FAN + F.col("_place") - 1
        pivots = settle(
            inner.select("node", "number", "wanted", "_x", F.xxhash64("_x").alias("_hash"))
            .withColumn("_place", F.dense_rank().over(by_hash))
            .filter((F.col("_place") <= FAN) & (F.col("_place") <= F.col("wanted")))
            .select("node", child.cast("long").alias("child"), "_x")
            .distinct()
        )
        listed = F.array_sort(F.collect_list(F.struct("child", "_x")))
        chosen = pivots.groupBy("node").agg(listed.alias("p")).select(
            "node",
            F.col("p.child").alias("children"),
            F.flatten("p._x").alias("pivots"),
        )
        dealt = settle(_assigned(inner.select(*kept, "_x", "node"), chosen, kept))
        level = settle(_bounds(dealt, pivots, key, k))
        smaller = level.join(open_.select("node", "n"), "node").filter(F.array_max("held") < F.col("n"))
        if smaller.isEmpty():
            # Points too close for their squared distances to tell them apart.
            return Tree(points, levels)
        levels.append(level)
        rest = points.join(
            F.broadcast(open_.select("node")) if small else open_.select("node"),
            "node",
            "left_anti",
        )
        moved = dealt.select(*kept, "_x", F.col("child").alias("node"))
        points = settle(rest.select(*moved.columns).unionByName(moved))
        next_node += count * FAN


def _assigned(rows: DataFrame, chosen: DataFrame, kept: list[str]) -> DataFrame:
    """Points with the ``child`` of the nearest pivot and the distance to it."""
    blocks = _blocks_of(rows, chosen, kept)
    types = {f.name: f for f in rows.schema}
    made = T.StructType(
        [
            *(types[c] for c in [*kept, "_x", "node"]),
            T.StructField("child", T.LongType()),
            T.StructField("off", T.DoubleType()),
        ]
    )

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.to_dict("records"):
                children = np.asarray(block["children"])
                pivots = np.asarray(block["pivots"]).reshape(len(children), -1)
                points = np.asarray(block["points"]).reshape(block["rows"], -1)
                away = squared_distances(points, pivots)
                nearest = away.argmin(axis=1)
                yield pd.DataFrame(
                    {
                        **{c: block[c] for c in kept},
                        "_x": list(points),
                        "node": block["node"],
                        "child": children[nearest],
                        "off": np.sqrt(away[np.arange(len(points)), nearest]),
                    }
                )

    return blocks.mapInPandas(assign, made)


def _bounds(dealt: DataFrame, pivots: DataFrame, key: str, k: int) -> DataFrame:
    """The nodes with children, pivots, radius, nearest offsets and rows held;
    a child without points is out of any reach."""
    by_off = Window.partitionBy("child").orderBy("off", key)
    nearest = (
        dealt.select("child", "off", key)
        .withColumn("i", F.row_number().over(by_off))
        .filter(F.col("i") <= k)
        .groupBy("child")
        .agg(F.array_sort(F.collect_list("off")).alias("closest"))
    )
    far = dealt.groupBy("child").agg(F.max("off").alias("radius"), F.count(F.lit(1)).alias("held"))
    known = pivots.join(far, "child", "left").join(nearest, "child", "left")
    none = F.array().cast("array<double>")
    padded = F.slice(
        F.concat(F.coalesce("closest", none), F.array_repeat(F.lit(math.inf), k)), 1, k
    )
    child = F.struct(
        "child",
        F.col("_x").alias("pivot"),
        F.coalesce("radius", F.lit(-math.inf)).alias("radius"),
        padded.alias("closest"),
        F.coalesce("held", F.lit(0)).alias("held"),
    )
    listed = known.groupBy("node").agg(F.array_sort(F.collect_list(child)).alias("c"))
    return listed.select(
        "node",
        F.col("c.child").alias("children"),
        F.flatten("c.pivot").alias("pivots"),
        F.col("c.radius").alias("radius"),
        F.flatten("c.closest").alias("closest"),
        F.col("c.held").alias("held"),
    )


def visits(test: DataFrame, tree: Tree, key: str, k: int) -> DataFrame:
    """``<key, _x, node>``: the leaves that can hold one of the ``k`` nearest
    train points of each test point."""
    rows = test.select(
        key,
        "_x",
        F.lit(0).cast("long").alias("node"),
        F.lit(0.0).alias("lower"),
        F.lit(math.inf).alias("bound"),
    )
    for depth, level in enumerate(tree.levels):
        if not depth:
            rows = settle(_reached(rows, level, key, k))
            continue
        # Leaves of earlier levels wait; all rows of a point share the best
        # bound that one of them has found.
        nodes = level.select("node")
        nodes = F.broadcast(nodes) if fits_broadcast(nodes) else nodes
        down = _reached(rows.join(nodes, "node", "left_semi"), level, key, k)
        leaves = rows.join(nodes, "node", "left_anti").select(*down.columns)
        both = settle(down.unionByName(leaves))
        best = both.groupBy(key).agg(F.min("bound").alias("_best"))
        limit = F.col("_best") * (1 + _SLACK) + _SLACK
        rows = settle(
            both.join(best.hint("merge"), key)
            .filter(F.col("lower") <= limit)
            .select(key, "_x", "node", "lower", F.col("_best").alias("bound"))
        )
    return rows.select(key, "_x", "node")


def _reached(rows: DataFrame, level: DataFrame, key: str, k: int) -> DataFrame:
    """Children of the rows' nodes within the bound of each point."""
    blocks = _blocks_of(rows, level, [key, "lower", "bound"])

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.to_dict("records"):
                children = np.asarray(block["children"])
                pivots = np.asarray(block["pivots"]).reshape(len(children), -1)
                closest = np.asarray(block["closest"]).reshape(len(children), k)
                points = np.asarray(block["points"]).reshape(block["rows"], -1)
                bound, lower = _limits(points, pivots, np.asarray(block["radius"]), closest)
                bound = np.minimum(bound, block["bound"])
                lower = np.maximum(lower, np.asarray(block["lower"])[:, None])
                hit, child = np.nonzero(lower <= (bound * (1 + _SLACK) + _SLACK)[:, None])
                if not len(hit):
                    continue  # better bounds were found in other nodes
                yield pd.DataFrame(
                    {
                        key: np.asarray(block[key])[hit],
                        "_x": list(points[hit]),
                        "node": children[child],
                        "lower": lower[hit, child],
                        "bound": bound[hit],
                    }
                )

    return blocks.mapInPandas(choose, rows.select(key, "_x", "node", "lower", "bound").schema)


def _limits(
    points: np.ndarray, pivots: np.ndarray, radius: np.ndarray, closest: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Upper bound of the k-th distance per point, lower bound per child."""
    away = np.sqrt(squared_distances(points, pivots))
    line = np.arange(len(points))
    # The k smallest sums over the children that start nearest.
    use = min(_BOUND_FROM, len(pivots))
    near = np.argpartition(away, use - 1, axis=1)[:, :use]
    sums = (away[line[:, None], near][:, :, None] + closest[near]).reshape(len(points), -1)
    k = closest.shape[1]
    bound = np.partition(sums, k - 1, axis=1)[:, k - 1]
    return bound, _lower(away, pivots, radius)


def _lower(away: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Lower bound per child from the distances to the pivots."""
    own = away.argmin(axis=1)
    apart = np.sqrt(squared_distances(pivots, pivots))[own]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (away**2 - away[np.arange(len(away)), own][:, None] ** 2) / (2 * apart)
    return np.maximum(away - radius, np.where(apart > 0, plane, 0.0))


def prunes(train: DataFrame, total: int, k: int) -> bool:
    """Whether a tree over the ``total`` points ``_x`` spares searches most parts.

    Judged on a sample of bounded size, cut once by pivots. In many dimensions
    nearly every part can hold a neighbour; then the tree is only a burden.
    The answer chooses the plan, not the result.
    """
    share = -(-total // _PROBE)
    hashed = F.xxhash64("_x")
    rows = (
        train.filter(F.pmod(hashed, F.lit(share)) == 0)
        .select(hashed.alias("h"), "_x")
        .distinct()
        .limit(4 * _PROBE)
        .collect()
    )
    x = np.array([r["_x"] for r in sorted(rows, key=lambda r: r["h"])], dtype=float)
    if len(x) < 4 * _PROBE_PIVOTS + k or not np.isfinite(x).all():
        return True
    pivots = x[:_PROBE_PIVOTS]
    off = np.sqrt(squared_distances(x, pivots))
    own = off.argmin(axis=1)
    radius = np.zeros(len(pivots))
    np.maximum.at(radius, own, off[np.arange(len(x)), own])
    asked = x[-4 * _PROBE_PIVOTS :]
    # The point itself is among its neighbours here.
    bound = np.partition(squared_distances(asked, x), k, axis=1)[:, k]
    lower = _lower(off[-len(asked) :], pivots, radius)
    return bool((lower <= np.sqrt(bound)[:, None]).mean() <= _REACHED)
