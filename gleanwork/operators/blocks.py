"""Bounded blocks of points for work on pairs.

Points are laid out by a key and cut into rows of at most ``BLOCK_ROWS``
points. Pairs of points are never rows: two blocks meet in one row and a numpy
kernel returns the few numbers that are wanted per point. A key that holds
much of the data becomes many blocks in many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.joins import attach
from gleanwork.session import settle

BLOCK_ROWS = 512
_EMIT_ROWS = 200_000


def as_point(columns: Sequence[str]) -> Column:
    """The columns as one array of doubles.

    Operators on points use this single column ``_x``, whatever the number of
    coordinates.
    """
    return F.expr("array(" + ", ".join(f"cast(`{c}` as double)" for c in columns) + ")")


def weighted_points(df: DataFrame, id_col: str, columns: Sequence[str], *also: str) -> DataFrame:
    """Distinct points ``_x`` with the number of rows ``w`` and the smallest id
    ``pid``. Ids have to be unique.

    Everything quadratic runs on these: repeated rows cost nothing.
    """
    values = df.select(id_col, *also, as_point(columns).alias("_x"))
    return values.groupBy(*also, "_x").agg(
        F.count(F.lit(1)).alias("w"), F.min(id_col).alias("pid")
    )


def with_clusters(
    df: DataFrame,
    columns: Sequence[str],
    labelled: DataFrame,
    total: int | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``df`` with the ``cluster`` of their point, from
    ``<_x, w, cluster>`` and the columns ``also``."""
    kept = [c for c in df.columns if c not in ("cluster", *also)]
    rows = df.select(*kept, as_point(columns).alias("_x"))
    return attach(rows, labelled, ["_x"], "w", total).select(*kept, "cluster", *also)


def packed(
    points: DataFrame,
    key: str,
    carry: Sequence[str],
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """``<block, key, rows, low, high, points, carried arrays...>``.

    Rows are range-partitioned on (key, coordinates), so blocks of one key are
    thin slices in space, a hot key spans many partitions and small keys stay
    whole. The result is written, hence block numbers do not change.
    """
    carry = list(carry)
    laid_out = (
        points.select(key, *carry, "_x")
        .repartitionByRange(key, "_x")
        .sortWithinPartitions(key, "_x")
    )
    types = {f.name: f.dataType for f in laid_out.schema}
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [
            T.StructField(key, types[key]),
            T.StructField("rows", T.IntegerType()),
            T.StructField("low", doubles),
            T.StructField("high", doubles),
            T.StructField("points", doubles),
            *[T.StructField(c, T.ArrayType(types[c])) for c in carry],
        ]
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[key].to_numpy()
            values = np.stack(batch["_x"].to_numpy())
            extras = {c: batch[c].to_numpy() for c in carry}
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            ends = np.append(starts[1:], len(keys))
            rows = []
            for start, end in zip(starts, ends):
                for a in range(start, end, size):
                    b = min(a + size, end)
                    part = values[a:b]
                    rows.append(
                        [
                            keys[a],
                            b - a,
                            part.min(axis=0),
                            part.max(axis=0),
                            part.ravel(),
                            *[extras[c][a:b] for c in carry],
                        ]
                    )
            yield pd.DataFrame(rows, columns=[f.name for f in schema])

    blocks = laid_out.mapInPandas(pack, schema)
    return settle(blocks.withColumn("block", F.monotonically_increasing_id()))


def summaries(blocks: DataFrame, prefix: str, *keep: str) -> DataFrame:
    """Block number, bounds and key columns without the points."""
    return blocks.select(
        *[F.col(c).alias(f"{prefix}_{c}") for c in ["block", "low", "high", *keep]]
    )


def gap(a: str = "l", b: str = "r") -> Column:
    """Smallest possible distance between points of two blocks."""
    steps = F.zip_with(
        F.zip_with(f"{a}_low", f"{b}_high", lambda x, y: x - y),
        F.zip_with(f"{b}_low", f"{a}_high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    return F.sqrt(F.aggregate(steps, F.lit(0.0), lambda acc, s: acc + s * s))


def reach(a: str = "l", b: str = "r") -> Column:
    """Largest possible distance between points of two blocks."""
    steps = F.zip_with(
        F.zip_with(f"{a}_high", f"{b}_low", lambda x, y: x - y),
        F.zip_with(f"{b}_high", f"{a}_low", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y),
    )
    return F.sqrt(F.aggregate(steps, F.lit(0.0), lambda acc, s: acc + s * s))


def meet(
    pairs: DataFrame,
    left: DataFrame,
    right: DataFrame,
    left_columns: Sequence[str],
    right_columns: Sequence[str],
    kernel: Callable[[dict], dict | None],
    schema: str,
) -> DataFrame:
    """Run ``kernel`` on every pair ``<l_block, r_block>``.

    The kernel gets a dict of ``l_*`` and ``r_*`` arrays and returns the
    columns of ``schema`` as arrays of equal length, or None. Pairs are dealt
    to the cores before the points are joined to them, so a small number of
    pairs does not end up in one task.
    """
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in ["block", "points", *left_columns]])
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in ["block", "points", *right_columns]])
    cores = left.sparkSession.sparkContext.defaultParallelism
    dealt = pairs.select("l_block", "r_block").repartition(cores, "l_block", "r_block")
    return run_kernel(dealt.join(a, "l_block").join(b, "r_block"), kernel, schema)


def run_kernel(joined: DataFrame, kernel: Callable[[dict], dict | None], schema: str) -> DataFrame:
    """``kernel`` on every row of ``joined``, a pair of blocks."""
    names = joined.columns
    fields = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: list[dict] = []
            held = 0
            for row in batch.itertuples(index=False, name=None):
                made = kernel(dict(zip(names, row)))
                if made is not None and len(made[fields[0]]):
                    found.append(made)
                    held += len(made[fields[0]])
                if held >= _EMIT_ROWS:
                    yield _stacked(found, fields)
                    found, held = [], 0
            if found:
                yield _stacked(found, fields)

    return joined.mapInPandas(run, schema)


def _stacked(parts: list[dict], fields: list[str]) -> pd.DataFrame:
    return pd.DataFrame({f: np.concatenate([p[f] for p in parts]) for f in fields})


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between the rows of two small matrices, summed
    coordinate by coordinate so that close points keep their precision."""
    total = np.zeros((len(a), len(b)))
    step = np.empty_like(total)
    for j in range(a.shape[1]):
        np.subtract(a[:, j, None], b[None, :, j], out=step)
        np.multiply(step, step, out=step)
        total += step
    return total


#: Squared distances below this share of the largest possible one are summed
#: coordinate by coordinate; above it a product loses at most the last digits.
_CLOSE = 1e-4


def distances(a: np.ndarray, b: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """All distances between the rows of two small matrices, by one matrix
    product around the middle of the first. ``out`` may take the result."""
    middle = a.mean(axis=0)
    p, q = a - middle, b - middle
    own, other = (p * p).sum(axis=1), (q * q).sum(axis=1)
    most = own.max(initial=0.0) + other.max(initial=0.0)
    if not np.isfinite(most):
        return np.sqrt(squared_distances(a, b), out=out)
    left = np.column_stack([-2.0 * p, own, np.ones(len(p))])
    away = np.matmul(left, np.vstack([q.T, np.ones(len(q)), other]), out=out)
    close = away <= _CLOSE * most
    rows = np.flatnonzero(close.any(axis=1))  # seldom more than a few
    i, j = np.nonzero(close[rows])
    i = rows[i]
    away[i, j] = ((a[i] - b[j]) ** 2).sum(axis=1)
    return np.sqrt(away, out=away)
