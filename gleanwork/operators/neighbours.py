"""Exact nearest neighbours, votes and the neighbour-distance curve.

The search runs over a tree of pivots (``pivot_tree``): train points gather in
leaves, test points descend to the leaves that can hold a neighbour, and only
those parts meet. Where a sample shows that searches would visit most leaves,
as in many dimensions, all blocks meet in cells of bounded size instead.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanwork.functions.joins import attach, bounded_broadcast
from gleanwork.functions.numbering import running_total
from gleanwork.operators import pivot_tree
from gleanwork.operators.blocks import (
    BLOCK_ROWS,
    as_point,
    packed,
    run_kernel,
    squared_distances,
    weighted_points,
)
from gleanwork.session import settle

ASKING_BLOCKS = 64  # test blocks that ask one leaf in a task
CELL_NUMBERS = 2_000_000  # coordinates on each side of a cell
_FIRST = 2048  # train points of a cell that give a first bound
_TILE = 4_000_000  # distances held at a time


def nearest(
    test: DataFrame,
    train: DataFrame,
    k: int,
    test_key: str,
    train_key: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``<test_key, place, train_key, carried..., distance>`` with the ``k``
    nearest train points of every test point, ties by ``train_key``.

    Both tables hold points ``_x`` and unique keys. Callers hand in distinct
    points, so no part can be filled by copies of one point.
    """
    carry = list(carry)
    train = settle(train.select(F.col(train_key).alias("_train"), *carry, "_x"))
    test = test.select(F.col(test_key).alias("_test"), "_x")
    types = {f.name: f.dataType.simpleString() for f in [*train.schema, *test.schema]}
    schema = ", ".join(
        [f"_test {types['_test']}", f"_train {types['_train']}", "distance double"]
        + [f"{c} {types[c]}" for c in carry]
    )
    total = train.count()
    if total <= pivot_tree.LEAF_ROWS or pivot_tree.prunes(train, total, k):
        found = _by_tree(test, train, k, carry, schema)
    else:
        found = _by_cells(test, train, k, carry, schema)
    order = Window.partitionBy("_test").orderBy("distance", "_train")
    ranked = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return ranked.select(
        F.col("_test").alias(test_key),
        "place",
        F.col("_train").alias("train_key" if train_key == test_key else train_key),
        *carry,
        "distance",
    )


def _by_tree(
    test: DataFrame, train: DataFrame, k: int, carry: list[str], schema: str
) -> DataFrame:
    """Train points near each test point, the ``k`` nearest among them."""
    tree = pivot_tree.build(train, "_train", carry, k)
    train_blocks = packed(tree.points, "node", ["_train", *carry])
    visits = pivot_tree.visits(test, tree, "_test", k)
    test_blocks = packed(visits, "node", ["_test"])
    # A leaf that very many blocks ask for is asked in several tasks. Both sides
    # grow with the tables, so neither is sent through the driver.
    sizes = test_blocks.groupBy("node").agg(
        F.ceil(F.count(F.lit(1)) / ASKING_BLOCKS).cast("int").alias("salts")
    )
    hot = bounded_broadcast(settle(sizes.filter("salts > 1")))
    salts = F.coalesce("salts", F.lit(1))
    asking = test_blocks.join(hot, "node", "left").select(
        "node",
        F.pmod(F.xxhash64("block"), salts).cast("int").alias("salt"),
        *[F.col(c).alias(f"l_{c}") for c in ["points", "_test"]],
    )
    asked = train_blocks.join(hot, "node", "left").select(
        "node",
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        *[F.col(c).alias(f"r_{c}") for c in ["points", "_train", *carry]],
    )
    joined = asking.join(asked.hint("merge"), ["node", "salt"]).drop("node", "salt")

    def kernel(row: dict) -> dict:
        a = np.asarray(row["l_points"]).reshape(len(row["l__test"]), -1)
        b = np.asarray(row["r_points"]).reshape(len(row["r__train"]), -1)
        away = squared_distances(a, b)
        if len(b) > k:
            # Keeps ties with the k-th; the ranking below settles them.
            limit = np.partition(away, k - 1, axis=1)[:, k - 1]
            i, j = np.nonzero(away <= limit[:, None])
        else:
            i, j = np.indices(away.shape).reshape(2, -1)
        made = {
            "_test": np.asarray(row["l__test"])[i],
            "_train": np.asarray(row["r__train"])[j],
            "distance": np.sqrt(away[i, j]),
        }
        made.update({c: np.asarray(row[f"r_{c}"])[j] for c in carry})
        return made

    return run_kernel(joined, kernel, schema)


def _by_cells(
    test: DataFrame, train: DataFrame, k: int, carry: list[str], schema: str
) -> DataFrame:
    """The same over all pairs of points.

    A cell is a bounded number of test blocks and of train blocks; a block
    travels once per cell of its row or column. Matrix products find the
    pairs that can be among the nearest, and only those are measured
    coordinate by coordinate.
    """
    everything = F.lit(0).alias("all")
    test_blocks = packed(test.select("*", everything), "all", ["_test"])
    train_blocks = packed(train.select("*", everything), "all", ["_train", *carry])
    d = train.select(F.size("_x").alias("d")).first()["d"]
    side = max(1, CELL_NUMBERS // (BLOCK_ROWS * d))
    held, asking = train_blocks.count(), test_blocks.count()
    columns = -(-held // side)
    cores = test.sparkSession.sparkContext.defaultParallelism
    rows = min(asking, max(-(-asking // side), -(-4 * cores // columns)))
    place = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    along = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = test_blocks.select(place(rows).alias("i"), along(columns).alias("j"), "_test", "points")
    right = train_blocks.select(
        along(rows).alias("i"), place(columns).alias("j"), "_train", *carry, "points"
    )
    dealt = [t.repartition(max(1, rows * columns), "i", "j").groupBy("i", "j") for t in (left, right)]
    names = ["_test", "_train", "distance", *carry]

    def search(tests: pa.Table, trains: pa.Table) -> pa.Table:
        flat = lambda t, c: t.column(c).combine_chunks().flatten()
        points = lambda t: flat(t, "points").to_numpy(zero_copy_only=False).reshape(-1, d)
        i, j, away = _near_pairs(points(tests), points(trains), k)
        made = [
            flat(tests, "_test").take(pa.array(i)),
            flat(trains, "_train").take(pa.array(j)),
            pa.array(np.sqrt(away)),
            *[flat(trains, c).take(pa.array(j)) for c in carry],
        ]
        return pa.Table.from_arrays(made, names=names)

    return dealt[0].cogroup(dealt[1]).applyInArrow(search, schema)


def _near_pairs(a: np.ndarray, b: np.ndarray, k: int) -> tuple:
    """Row numbers and squared distances of each row of ``a`` and its ``k``
    nearest rows of ``b``, with all ties of the last."""
    d = a.shape[1]
    none = np.zeros(0, dtype=int)
    if not len(a) or not len(b):
        return none, none, np.zeros(0)
    own, other = (a * a).sum(axis=1), (b * b).sum(axis=1)
    rough = np.isfinite(own).all() and np.isfinite(other).all()
    by_coordinate = np.ascontiguousarray(b.T)
    found = []
    step = max(1, _TILE // len(b))
    for start in range(0, len(a), step):
        part = a[start : start + step]
        if rough:
            away = part @ by_coordinate
            away *= -2.0
            away += own[start : start + step, None]
            away += other
            # Far above what rounding can add to a sum of d products.
            slack = 1e-14 * (d + 8) * (own[start : start + step] + other.max())
        else:
            away, slack = squared_distances(part, b), np.zeros(len(part))
        if len(b) > k:
            first = np.partition(away[:, : max(_FIRST, k)], k - 1, axis=1)[:, k - 1]
            i, j = np.nonzero(away <= (first + 2 * slack)[:, None])
        else:
            i, j = np.indices(away.shape).reshape(2, -1)
        total = np.zeros(len(i))
        across = part.T
        for c in range(d):
            gap = across[c][i] - by_coordinate[c][j]
            total += gap * gap
        if len(b) > k:
            order = np.lexsort((total, i))
            i, j, total = i[order], j[order], total[order]
            begin = np.searchsorted(i, np.arange(len(part)))
            last = np.append(begin[1:], len(i)) - 1
            limit = np.append(total, np.inf)[np.minimum(begin + k - 1, np.maximum(last, begin))]
            keep = total <= limit[i]
            i, j, total = i[keep], j[keep], total[keep]
        found.append((i + start, j, total))
    return tuple(np.concatenate(column) for column in zip(*found))


def neighbour_lists(
    test: DataFrame,
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    k: int,
    id_col: str,
    leave_out_self: bool = False,
) -> DataFrame:
    """Test rows with ``neighbours``: the ``k`` nearest train rows as sorted
    ``array<struct<distance, id, label>>`` (C-4).

    Equal test rows are searched once; of equal train rows the ``k`` with the
    smallest ids can be neighbours at all. With ``leave_out_self`` the train
    row with the id of the test row does not count.
    """
    columns = list(columns)
    wide = k + 1 if leave_out_self else k
    copies = Window.partitionBy("_x").orderBy(id_col)
    candidates = (
        train.select(id_col, label, as_point(columns).alias("_x"))
        .withColumn("_copy", F.row_number().over(copies))
        .filter(F.col("_copy") <= wide)
        .drop("_copy")
    )
    points = settle(weighted_points(test, id_col, columns))
    found = nearest(
        points, candidates.withColumnRenamed(id_col, "_id"), wide, "pid", "_id", [label]
    )
    # Written, as the join below reads them more than once.
    lists = settle(
        found.groupBy("pid").agg(
            F.sort_array(
                F.collect_list(
                    F.struct("distance", F.col("_id").alias("id"), F.col(label).alias("label"))
                )
            ).alias("neighbours")
        )
    )
    per_point = points.join(lists.hint("merge"), "pid").drop("pid").hint("merge")
    rows = test.withColumn("_x", as_point(columns))
    joined = attach(rows, per_point, ["_x"], "w").select(*test.columns, "neighbours")
    kept = F.col("neighbours")
    if leave_out_self:
        kept = F.filter(kept, lambda n: n["id"] != F.col(id_col))
    return joined.withColumn("neighbours", F.slice(kept, 1, k))


def vote(neighbours: Column, k: int) -> Column:
    """Most frequent label of the first ``k`` neighbours, smallest on ties."""
    labels = F.transform(F.slice(neighbours, 1, k), lambda n: n["label"])
    counts = F.transform(
        F.array_distinct(labels),
        lambda own: F.struct(
            (-F.size(F.filter(labels, lambda other: other == own))).alias("votes"),
            own.alias("label"),
        ),
    )
    return F.array_min(counts)["label"]


def distance_curve(df: DataFrame, columns: Sequence[str], neighbour: int = 10) -> DataFrame:
    """Distances of all rows to their ``neighbour``-th other row, ascending (K-8).

    Run-length form ``<distance, rows, upto>``: ``rows`` rows share the
    distance and ``upto`` rows have it or a smaller one.
    """
    counted = df.groupBy(as_point(columns).alias("_x")).agg(F.count(F.lit(1)).alias("w"))
    points = settle(counted.withColumn("pid", F.monotonically_increasing_id()))
    wanted = neighbour + 1  # the row itself is its first neighbour
    other = points.withColumnRenamed("pid", "_other")
    found = nearest(points, other, wanted, "pid", "_other", ["w"])
    seen = Window.partitionBy("pid").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = found.withColumn("_seen", F.sum("w").over(seen)).filter(F.col("_seen") >= wanted)
    per_point = reached.groupBy("pid").agg(F.min("distance").alias("distance"))
    counts = (
        per_point.join(points.select("pid", "w"), "pid")
        .groupBy(F.round("distance", 9).alias("distance"))
        .agg(F.sum("w").alias("rows"))
    )
    return running_total(counts, [F.col("distance")], F.col("rows"), "upto")


def knee(curve: DataFrame) -> DataFrame:
    """The point of an increasing convex curve farthest below its chord (K-9).

    ``<position, distance>``; the position counts from 0. The curve is the
    output of ``distance_curve``.
    """
    ends = curve.agg(
        F.min("distance").alias("low"), F.max("distance").alias("high"), F.max("upto").alias("n")
    ).first()
    if ends["n"] is None:
        return curve.select(F.col("upto").alias("position"), "distance").limit(0)
    across = float(max(ends["n"] - 1, 1))
    up = (ends["high"] - ends["low"]) or 1.0
    below = (F.col("upto") - 1) / F.lit(across) - (F.col("distance") - ends["low"]) / F.lit(up)
    return (
        curve.select((F.col("upto") - 1).alias("position"), "distance", below.alias("_below"))
        .orderBy(F.desc(F.round("_below", 12)), "position")
        .limit(1)
        .drop("_below")
    )
