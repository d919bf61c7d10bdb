"""Overview of a learning table: types, gaps, counts, shapes, correlation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.joins import bounded_broadcast
from gleanwork.functions.quantiles import exact_quantiles
from gleanwork.operators.preparation import is_missing, numeric_columns
from gleanwork.session import settle


def _long(df: DataFrame, values: dict[str, Column], key: str, value: str) -> DataFrame:
    """One row of named values turned into (key, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(k).alias(key), v.alias(value)) for k, v in values.items()]
    )
    return df.select(F.inline(pairs))


def table_overview(df: DataFrame) -> DataFrame:
    """``<column, type, non_null, rows>`` in one pass (A-7)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f.name).alias("non_null"),
                F.col("_rows").alias("rows"),
            )
            for f in df.schema
        ]
    )
    return counted.select(F.inline(entries))


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A first look at the table (A-7)."""
    return df.limit(n)


def missing_counts(df: DataFrame) -> DataFrame:
    """``<column, missing>`` in one pass (A-8); NULL and NaN are missing."""
    counted = df.agg(*[F.count_if(is_missing(f)).alias(f.name) for f in df.schema])
    return _long(counted, {c: F.col(c) for c in df.columns}, "column", "missing")


def category_counts(df: DataFrame, category: str, label: str) -> DataFrame:
    """Rows per category and class (A-9)."""
    return df.groupBy(category, label).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str, label: str, bins: int | str = "auto") -> DataFrame:
    """``<label, bin, bin_start, n>`` over equal bins of the whole range (A-10).

    Bins are numbered from 0 and the last one holds the maximum. ``"auto"``
    takes the smaller width of the Sturges and Freedman-Diaconis rules. NULL
    and NaN are missing; a table without values has no bins.
    """
    df = df.filter(~is_missing(df.schema[column]))
    stats = df.agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count(column).alias("n")
    ).first()
    low, high = float(stats["low"] or 0.0), float(stats["high"] or 0.0)
    if bins == "auto":
        bins = 1
        if high > low:
            lower, upper = exact_quantiles(df, [column], [0.25, 0.75])[column]
            width = (high - low) / (math.log2(stats["n"]) + 1)
            spread = 2.0 * (upper - lower) / stats["n"] ** (1.0 / 3.0)
            bins = math.ceil((high - low) / (min(width, spread) if spread > 0 else width))
    step = (high - low) / bins if high > low else 1.0
    position = F.floor((F.col(column) - F.lit(low)) / F.lit(step)).cast("int")
    return (
        df.withColumn("bin", F.least(position, F.lit(bins - 1)))
        .groupBy(label, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.lit(low) + F.col("bin") * F.lit(step))
    )


def _grid_sums(values: DataFrame, label: str, grid: np.ndarray, held: int = 4096) -> DataFrame:
    """``<label, point, weight>``: kernel sums of ``<label, _v, _h>`` rows.

    A task adds up one array of grid points per class and returns each once;
    at ``held`` classes it returns what it has and goes on.
    """
    points = len(grid)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        kind = None

        def out() -> pa.RecordBatch:
            names = [name for name in sums for _ in range(points)]
            at = np.tile(np.arange(points, dtype=np.int32), len(sums))
            weights = np.concatenate(list(sums.values()))
            sums.clear()
            columns = [pa.array(names, kind), pa.array(at), pa.array(weights)]
            return pa.RecordBatch.from_arrays(columns, [label, "point", "weight"])

        for batch in batches:
            kind = batch.column(0).type
            coded = batch.column(0).dictionary_encode()
            codes = coded.indices.to_numpy()
            v, h = (batch.column(i).to_numpy() for i in (1, 2))
            for code, name in enumerate(coded.dictionary.to_pylist()):
                mine = codes == code
                value, times = np.unique(v[mine], return_counts=True)
                width = h[mine][0]
                total = sums.setdefault(name, np.zeros(points))
                for i in range(0, len(value), 1024):
                    z = (grid - value[i : i + 1024, None]) / width
                    total += times[i : i + 1024] @ np.exp(-z * z / 2.0)
                if len(sums) >= held:
                    yield out()
        if sums:
            yield out()

    kinds = values.select(label).schema.add("point", "integer").add("weight", "double")
    return values.select(label, "_v", "_h").mapInArrow(gather, kinds)


def density(df: DataFrame, column: str, label: str, points: int = 200) -> DataFrame:
    """``<label, point, density, x>``: Gaussian density per class (A-11).

    The grid has ``points`` steps over the whole range; the bandwidth of a
    class is ``stddev_samp * n^(-1/5)``. NULL and NaN are missing, classes with
    no spread and rows without a class have no curve, an empty table has none.
    Every task sums a class on the grid, so the shuffle carries at most
    tasks x classes x points rows, whatever the number of values.
    """
    values = df.filter(~is_missing(df.schema[column])).select(
        F.col(label), F.col(column).cast("double").alias("_v")
    )
    per_class = values.groupBy(label).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.stddev_samp("_v") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("_h"),
    )
    per_class = bounded_broadcast(settle(per_class.filter(F.col("_h") > 0)))
    ends = values.agg(F.min("_v").alias("low"), F.max("_v").alias("high")).first()
    low, high = ends["low"], ends["high"]
    step = (high - low) / (points - 1) if low is not None and high > low else 1.0
    low = 0.0 if low is None else low
    sums = _grid_sums(values.join(per_class, label), label, low + np.arange(points) * step)
    area = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2.0 * math.pi))
    return (
        sums.groupBy(label, "point")
        .agg(F.sum("weight").alias("weight"))
        .join(per_class, label)
        .select(
            label,
            "point",
            (F.col("weight") / area).alias("density"),
            (F.lit(low) + F.col("point") * F.lit(step)).alias("x"),
        )
    )


_MOMENTS = "a int, b int, n long, mean_a double, mean_b double, aa double, bb double, ab double"


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<a, b, n, mean_a, mean_b, aa, bb, ab>`` per pair of columns.

    Every task keeps one matrix of counts, means and centred products over its
    rows, block by block, and returns it once; a missing value (NULL, NaN)
    leaves out the pairs of its column only. So a table of any size sends a
    matrix per task, and centred sums do not lose digits to large means.
    """
    names = list(columns)
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    first, second = (np.array(side) for side in zip(*pairs))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(pairs)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            x = x.astype(float)
            held = ~np.isnan(x)
            total = merged(total, _block_moments(x, held, first, second))
        if total[0].any():
            columns = [first, second, *total]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c.astype(t.to_pandas_dtype()), t)
                    for c, t in zip(columns, _MOMENT_TYPES)
                ],
                [c.split()[0] for c in _MOMENTS.split(", ")],
            )

    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    return values.mapInArrow(gather, _MOMENTS)


_MOMENT_TYPES = [pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * 5]


def _block_moments(x: np.ndarray, held: np.ndarray, first, second) -> np.ndarray:
    """Count, both means and the three centred products of every pair."""
    whole = np.where(held, x, 0.0)
    seen = held.astype(float)
    shift = whole.sum(axis=0) / np.maximum(seen.sum(axis=0), 1)
    whole = np.where(held, x - shift, 0.0)
    n = (seen.T @ seen)[first, second]
    ab = (whole.T @ whole)[first, second]
    # Sums of one column over the rows that hold the other one too.
    sums, squares = whole.T @ seen, (whole * whole).T @ seen
    sum_a, sum_b = sums[first, second], sums[second, first]
    aa, bb = squares[first, second], squares[second, first]
    rows = np.maximum(n, 1)
    return np.array(
        [
            n,
            shift[first] + sum_a / rows,
            shift[second] + sum_b / rows,
            aa - sum_a * sum_a / rows,
            bb - sum_b * sum_b / rows,
            ab - sum_a * sum_b / rows,
        ]
    )


def merged(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together."""
    n = one[0] + two[0]
    rows = np.maximum(n, 1)
    step_a, step_b = two[1] - one[1], two[2] - one[2]
    weight = one[0] * two[0] / rows
    return np.array(
        [
            n,
            one[1] + step_a * two[0] / rows,
            one[2] + step_b * two[0] / rows,
            one[3] + two[3] + step_a * step_a * weight,
            one[4] + two[4] + step_b * step_b * weight,
            one[5] + two[5] + step_a * step_b * weight,
        ]
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``<a, b, corr>`` for every pair of numeric columns (A-12).

    One scan; the matrices of the tasks are merged by pair. NULL and NaN are
    missing: a pair uses the rows that hold both values. A constant column and
    an empty table have no correlation (NULL).
    """
    names = list(columns) if columns else numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "a string, b string, corr double")
    parts = settle(co_moments(df, names))
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("n")), F.sum("n"))
    # A row per pair of columns: fits a broadcast.
    centres = parts.groupBy("a", "b").agg(mean("mean_a").alias("ca"), mean("mean_b").alias("cb"))
    off_a, off_b = F.col("mean_a") - F.col("ca"), F.col("mean_b") - F.col("cb")
    sums = (
        parts.filter("n > 0")
        .join(F.broadcast(centres), ["a", "b"])
        .groupBy("a", "b")
        .agg(
            F.sum(F.col("aa") + F.col("n") * off_a * off_a).alias("aa"),
            F.sum(F.col("bb") + F.col("n") * off_b * off_b).alias("bb"),
            F.sum(F.col("ab") + F.col("n") * off_a * off_b).alias("ab"),
        )
    )
    corr = F.try_divide(F.col("ab"), F.sqrt("aa") * F.sqrt("bb"))
    listed = F.array(*[F.lit(c) for c in names])
    both = F.array_distinct(
        F.array(
            F.struct(F.get(listed, "a").alias("a"), F.get(listed, "b").alias("b")),
            F.struct(F.get(listed, "b").alias("a"), F.get(listed, "a").alias("b")),
        )
    )
    found = sums.select(F.explode(both).alias("p"), corr.alias("corr")).select("p.a", "p.b", "corr")
    asked = df.sparkSession.createDataFrame([(a, b) for a in names for b in names], "a string, b string")
    return asked.join(found, ["a", "b"], "left")
