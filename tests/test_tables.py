import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwork.functions.joins import attach, term_join
from gleanwork.functions.numbering import numbered, running_total
from gleanwork.functions.quantiles import exact_quantiles
from gleanwork.operators import preparation, profiling, scalers

VALUES = [(1, 1.0, 5.0, None), (2, 2.0, 5.0, 4.0), (3, 4.0, 5.0, 8.0), (4, -1.0, 5.0, None)]
SCHEMA = "id int, a double, constant double, gaps double"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(VALUES, SCHEMA)


def column(df, name):
    return [r[name] for r in df.orderBy("id").select(name).collect()]


def test_scalers(df):
    a = np.array([v[1] for v in VALUES])
    q = np.quantile(a, [0.25, 0.5, 0.75])
    want = {
        "standard": (a - a.mean()) / a.std(),
        "min_max": (a - a.min()) / (a.max() - a.min()),
        "robust": (a - q[1]) / (q[2] - q[0]),
        "max_abs": a / 4,
    }
    for name in scalers.SCALERS:
        made = scalers.scale(df, ["a", "constant", "gaps"], name)
        assert np.allclose(column(made, "a"), want[name])
        assert column(made, "constant") == ([1.0] * 4 if name == "max_abs" else [0.0] * 4)
        assert column(made, "gaps")[0] is None
    two = scalers.scale_chained(df, ["a"], ["standard", "min_max"])
    assert np.allclose(column(two, "a"), want["min_max"])


def test_fill_and_encode(df):
    assert column(preparation.fill_means(df), "gaps") == [6.0, 4.0, 8.0, 6.0]
    coded = preparation.encode_labels(
        df.withColumn("k", F.when(F.col("id") < 3, "yes").when(F.col("id") == 3, "no").otherwise("?")),
        "k",
        {"yes": 1, "no": 0},
    )
    assert column(coded, "k") == [1, 1, 0, None]
    with pytest.raises(ValueError):
        preparation.drop_columns(df, ["nope"])
    assert preparation.feature_subset(df, [["a"], ["gaps", "a"]], 1).columns == ["gaps", "a"]


def test_profile(df):
    missing = {r["column"]: r["missing"] for r in profiling.missing_counts(df).collect()}
    assert missing == {"id": 0, "a": 0, "constant": 0, "gaps": 2}
    overview = {r["column"]: (r["type"], r["non_null"], r["rows"]) for r in profiling.table_overview(df).collect()}
    assert overview["gaps"] == ("double", 2, 4)
    assert profiling.first_rows(df, 2).count() == 2


def test_histogram_and_density(spark):
    rng = random.Random(1)
    rows = [(rng.choice("xy"), round(rng.gauss(0, 2), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label string, v double")
    made = profiling.histogram(df, "v", "label")
    edges = np.histogram_bin_edges([v for _, v in rows], "auto")
    assert sum(r["n"] for r in made.collect()) == 300
    assert made.agg(F.max("bin")).first()[0] == len(edges) - 2
    for label in "xy":
        values = [v for k, v in rows if k == label]
        counts, _ = np.histogram(values, edges)
        got = {r["bin"]: r["n"] for r in made.filter(F.col("label") == label).collect()}
        # Values on an edge may fall to either side by the last bit.
        assert sum(abs(got.get(i, 0) - c) for i, c in enumerate(counts)) <= 6
        h = np.std(values, ddof=1) * len(values) ** -0.2
        curve = profiling.density(df, "v", "label", 30).filter(F.col("label") == label).collect()
        assert len(curve) == 30
        for r in curve:
            z = (r["x"] - np.array(values)) / h
            want = np.exp(-z * z / 2).sum() / (len(values) * h * math.sqrt(2 * math.pi))
            assert r["density"] == pytest.approx(want)


def test_empty_histogram(spark):
    empty = spark.createDataFrame([], "label string, v double")
    assert profiling.histogram(empty, "v", "label").count() == 0
    assert profiling.density(empty, "v", "label").count() == 0


def test_numbering_over_many_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaab"), rng.randrange(20), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(5)
    made = numbered(df, [F.desc("v"), F.col("id")], "no", ["g"])
    for g in "ab":
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        got = [r["id"] for r in made.filter(F.col("g") == g).orderBy("no").collect()]
        assert got == [r[2] for r in order]
    total = running_total(df, [F.col("id")], F.col("v"), "upto").orderBy("id").collect()
    assert [r["upto"] for r in total] == list(np.cumsum([r[1] for r in rows]))


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_exact_quantiles(spark, limit):
    rng = random.Random(3)
    spiky = [7.0] * 400 + [rng.random() * 20 for _ in range(601)]
    rows = [(rng.gauss(0, 1), spiky[i], None if i % 3 else float(i)) for i in range(1001)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = exact_quantiles(df, ["a", "b", "c"], qs, limit)
    for i, c in enumerate("abc"):
        want = np.quantile([r[i] for r in rows if r[i] is not None], qs)
        assert np.allclose(got[c], want)
    empty = exact_quantiles(df.filter("a > 100"), ["a"], [0.5], limit)
    assert empty["a"] is None


def test_joins_of_hot_groups(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(600)]
    large = spark.createDataFrame(rows, "id int, k string")
    groups = large.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    want = sorted(map(tuple, large.join(groups, "k").collect()))
    got = attach(large, groups, ["k"], "n", hot_rows=20).select("k", "id", "n", "first")
    assert sorted(map(tuple, got.collect())) == want
    for small in (True, False):
        got = term_join(large, groups, "k", "id", small).select("k", "id", "n", "first")
        assert sorted(map(tuple, got.collect())) == want


def test_nan_is_missing_and_integers_stay(spark):
    big = 2**53 + 1
    df = spark.createDataFrame(
        [(big, 1.0, None), (2, float("nan"), 4), (3, None, 5)], "id bigint, x double, n int"
    )
    missing = {r["column"]: r["missing"] for r in profiling.missing_counts(df).collect()}
    assert missing == {"id": 0, "x": 2, "n": 1}
    filled = preparation.fill_means(df)
    assert [t for _, t in filled.dtypes] == ["bigint", "double", "double"]
    assert sorted(tuple(r) for r in filled.collect()) == [(2, 1.0, 4.0), (3, 1.0, 5.0), (big, 1.0, 4.5)]


@pytest.mark.parametrize("limit", [1, 10, 10_000_000])
def test_quantiles_do_not_depend_on_the_limit(spark, limit):
    values = [float(v) for v in range(50)] + [float("nan")] * 20 + [None] * 3 + [7.0] * 40
    df = spark.createDataFrame([(v, 1.5) for v in values], "a double, b double")
    numbers = sorted(v for v in values if v is not None and v == v)
    want = [float(np.quantile(numbers, q)) for q in (0, 0.1, 0.25, 0.5, 0.99, 1)]
    got = exact_quantiles(df, ["a", "b"], [0, 0.1, 0.25, 0.5, 0.99, 1], limit)
    assert got == {"a": pytest.approx(want, abs=1e-12), "b": [1.5] * 6}


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    rows = [(1.0, 2.0, "a"), (2.0, nan, "a"), (3.0, 5.0, "b"), (10.0, 1.0, "b"), (nan, 4.0, "a"), (None, 3.0, "b")]
    df = spark.createDataFrame(rows, "x double, y double, k string").repartition(3)
    clean = df.filter("not isnan(x) and x is not null")
    for bins in (4, "auto"):
        got = sorted(tuple(r) for r in profiling.histogram(df, "x", "k", bins).collect())
        assert got == sorted(tuple(r) for r in profiling.histogram(clean, "x", "k", bins).collect())
    assert {r["bin"]: r["n"] for r in profiling.histogram(df, "x", "k", 4).filter("k = 'a'").collect()} == {0: 2}
    got = sorted(tuple(r) for r in profiling.density(df, "x", "k", 20).collect())
    want = sorted(tuple(r) for r in profiling.density(clean, "x", "k", 20).collect())
    assert np.allclose([r[2:] for r in got], [r[2:] for r in want]) and len(got) == len(want)
    for fit in scalers.SCALERS.values():
        assert fit(df, ["x"]) == fit(clean, ["x"])


def test_correlations_of_pairs_that_hold_both_values(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) * [1, 1e-3, 50] + [1e6, 0, -3]
    x[:, 1] += x[:, 0] * 1e-3
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [(*[None if np.isnan(v) and i % 2 else float(v) for v in r], 7.0) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, `c.d` double, e double").repartition(5)
    got = {(r["a"], r["b"]): r["corr"] for r in profiling.correlations(df).collect()}
    assert len(got) == 16 and got["e", "a"] is None
    for i, a in enumerate(["a", "b", "c.d"]):
        for j, b in enumerate(["a", "b", "c.d"]):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], rel=1e-9)
    assert profiling.correlations(df.limit(0)).filter("corr is not null").count() == 0


def test_density_sends_a_grid_per_task_and_class(spark):
    rows = spark.range(0, 80_000, 1, 4).selectExpr("id % 3 as k", "sqrt(id) as v", "0.5D as h")
    rows = rows.withColumnsRenamed({"v": "_v", "h": "_h"})
    grid = np.linspace(0.0, 282.0, 25)
    once = profiling._grid_sums(rows, "k", grid)
    assert once.count() == 4 * 3 * 25
    often = profiling._grid_sums(rows, "k", grid, held=1)
    assert often.count() > once.count()
    sums = [
        {(r[0], r[1]): r[2] for r in part.groupBy("k", "point").agg(F.sum("weight")).collect()}
        for part in (once, often)
    ]
    assert sums[0] == pytest.approx(sums[1])
    value = np.sqrt(np.arange(0, 80_000, 3))
    assert sums[0][0, 12] == pytest.approx(np.exp(-(((grid[12] - value) / 0.5) ** 2) / 2).sum())
