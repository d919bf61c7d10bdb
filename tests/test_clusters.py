import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwork.operators import blocks, centroids, cluster_metrics, neighbours, pivot_tree
from gleanwork.operators import silhouette
from gleanwork.operators.components import connected
from gleanwork.operators import dbscan as dbscan_module
from gleanwork.operators.dbscan import dbscan
from gleanwork.operators.grid import offsets, with_cell
from gleanwork.operators import mean_shift as mean_shift_module
from gleanwork.operators.mean_shift import mean_shift
from tests import brute

COLUMNS = ["x", "y", "z"]


def frame(spark, x, **more):
    names = ["id", *COLUMNS, *more]
    rows = [
        (i, *map(float, p), *(more[m][i] for m in more)) for i, p in enumerate(x)
    ]
    return spark.createDataFrame(rows, names)


def column(df, name):
    return [r[name] for r in df.orderBy("id").select(name).collect()]


def numbers(seeds):
    """Cluster numbers in the order of the seeds, -1 stays."""
    order = sorted(set(seeds) - {-1})
    return [-1 if s == -1 else order.index(s) for s in seeds]


@pytest.mark.parametrize("eps,min_samples", [(0.6, 4), (0.9, 6), (0.3, 2), (3.0, 5)])
def test_dbscan(spark, eps, min_samples):
    x = brute.blobs(1)
    made = dbscan(frame(spark, x), "id", COLUMNS, eps, min_samples)
    want = brute.dbscan(x, list(range(len(x))), eps, min_samples)
    assert column(made, "cluster") == numbers(want)


@pytest.mark.parametrize("name", [lambda i: i - 20, lambda i: f"{i:04d}"], ids=["negative", "text"])
def test_dbscan_takes_any_id(spark, name):
    x = brute.blobs(1)
    rows = [(name(i), *map(float, p), -1) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", *COLUMNS, "cluster"])
    made = dbscan(df, "id", COLUMNS, 0.9, 6, "seed")
    want = brute.dbscan(x, list(range(len(x))), 0.9, 6)
    assert column(made, "cluster") == numbers(want)
    assert column(made, "seed") == [None if s == -1 else name(s) for s in want]


def test_dbscan_of_noise_and_of_nothing(spark):
    df = frame(spark, brute.blobs(1))
    assert set(column(dbscan(df, "id", COLUMNS, 1e-6, 50), "cluster")) == {-1}
    assert column(dbscan(df.limit(0), "id", COLUMNS, 0.9, 6), "cluster") == []


def test_dbscan_in_tiny_blocks(spark, monkeypatch):
    # Cells cut into several blocks: links beyond the first blocks matter.
    monkeypatch.setattr(blocks.packed, "__defaults__", (2,))
    x = brute.blobs(2)
    made = dbscan(frame(spark, x), "id", COLUMNS, 1.2, 4)
    assert column(made, "cluster") == numbers(brute.dbscan(x, list(range(len(x))), 1.2, 4))


@pytest.mark.parametrize("cluster_all", [True, False])
@pytest.mark.parametrize("held", [4096, 10])
def test_mean_shift(spark, cluster_all, held):
    x = brute.blobs(3, sizes=(25, 20, 15))
    made = mean_shift(frame(spark, x), "id", COLUMNS, 2.0, cluster_all, max_held=held)
    assert column(made, "cluster") == brute.mean_shift(x, 2.0, cluster_all)


@pytest.mark.parametrize("held", [4096, 2])
def test_mean_shift_of_tiny_coordinates(spark, held):
    x = brute.blobs(3, sizes=(15, 12, 9))
    made = mean_shift(frame(spark, x * 2.0**-40), "id", COLUMNS, 2.0 * 2.0**-40, max_held=held)
    assert column(made, "cluster") == brute.mean_shift(x, 2.0, True)


def test_mean_shift_without_rounds_where_points_fit(spark, monkeypatch):
    """Points of a bounded size need no job per round, whatever the number of seeds."""
    x = brute.blobs(3, sizes=(25, 20, 15))
    x = np.concatenate([x, x[:7]])
    jobs = []
    for step in ("_means_of_many", "_means_of_few"):
        monkeypatch.setattr(mean_shift_module, step, lambda *_: jobs.append(1))
    monkeypatch.setattr(mean_shift_module, "_TILE", 100, raising=False)
    made = mean_shift(frame(spark, x), "id", COLUMNS, 2.0, max_held=10)
    assert column(made, "cluster") == brute.mean_shift(x, 2.0, True)
    assert not jobs


@pytest.mark.parametrize("numbers", [4_000_000, 0])
def test_mean_shift_leaves_points_with_nulls_out(spark, monkeypatch, numbers):
    """They are near nothing, so they move no seed."""
    monkeypatch.setattr(mean_shift_module, "HELD_NUMBERS", numbers)
    x = brute.blobs(3, sizes=(25, 20, 15))
    nulls = [(1000, None, 0.5, 0.5), (1001, None, None, None), (1002, float("nan"), 90.0, 90.0)]
    df = frame(spark, x)
    df = df.unionAll(spark.createDataFrame(nulls, df.schema))
    made = mean_shift(df, "id", COLUMNS, 2.0).filter("id < 1000")
    assert column(made, "cluster") == brute.mean_shift(x, 2.0, True)


@pytest.mark.parametrize("held", [4096, 10])
def test_mean_shift_in_rounds(spark, monkeypatch, held):
    monkeypatch.setattr(mean_shift_module, "HELD_NUMBERS", 0)
    x = brute.blobs(3, sizes=(25, 20, 15))
    made = mean_shift(frame(spark, x), "id", COLUMNS, 2.0, False, max_held=held)
    assert column(made, "cluster") == brute.mean_shift(x, 2.0, False)


@pytest.mark.parametrize("size", [512, 7])
def test_silhouette(spark, monkeypatch, size):
    monkeypatch.setattr(blocks.packed, "__defaults__", (size,))
    x = brute.blobs(4)
    labels = [int(p[0] > 2) + 2 * int(p[1] > 2.5) for p in x]
    labels[-9] = 77  # a cluster of one
    df = frame(spark, x, cluster=labels)
    want = brute.silhouettes(x, labels)
    got = column(silhouette.silhouette_rows(df, "id", COLUMNS, "cluster"), "silhouette")
    assert np.allclose(got, want)
    mean = silhouette.mean_silhouette(df, "id", COLUMNS, "cluster").first()["silhouette"]
    assert mean == pytest.approx(np.mean(want))


@pytest.mark.parametrize("cell", [1, 2, 16])
def test_blocks_of_a_silhouette_meet_once(spark, monkeypatch, cell):
    """Rows and columns of a matrix of distances are summed, also across clusters."""
    monkeypatch.setattr(blocks.packed, "__defaults__", (4,))
    monkeypatch.setattr(silhouette, "CELL_BLOCKS", cell)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(40, 3)), rng.normal(size=(31, 3)) + 0.5, [[9, 9, 9]]])
    labels = ["a"] * 40 + ["b"] * 31 + ["c"]
    x[3] = x[4]
    df = frame(spark, x, cluster=labels)
    want = brute.silhouettes(x, [ord(c) for c in labels])
    got = column(silhouette.silhouette_rows(df, "id", COLUMNS, "cluster"), "silhouette")
    assert np.allclose(got, want, rtol=0, atol=1e-12)
    packed = blocks.packed(blocks.weighted_points(df, "id", COLUMNS, "cluster"), "cluster", ["pid", "w"])
    wanted = packed.select("block").crossJoin(packed.select(F.col("cluster").alias("other")).distinct())
    twice = {(r["lo"], r["hi"]) for r in silhouette._mirrored(packed, wanted, "cluster").collect()}
    assert {("a", "a"), ("a", "b"), ("b", "b")} <= twice | ({("b", "b")} if cell > 8 else set())


def test_silhouettes_beside_points_with_nulls(spark):
    """A sum over such a point is missing, it does not turn others into NaN."""
    x = brute.blobs(4)
    df = frame(spark, x, cluster=[int(p[0] > 2) for p in x])
    df = df.unionAll(spark.createDataFrame([(1000, None, 0.5, 0.5, 1)], df.schema))
    made = column(silhouette.silhouette_rows(df, "id", COLUMNS, "cluster"), "silhouette")
    assert len(made) == len(x) + 1 and not any(s is not None and np.isnan(s) for s in made)


@pytest.mark.parametrize("cell, numbers", [(16, 2_000_000), (1, 2_000_000), (2, 12)])
def test_silhouettes_of_many_clusters_look_at_few(spark, monkeypatch, cell, numbers):
    """Far clusters are dropped; cells and slices of any size give the same."""
    monkeypatch.setattr(blocks.packed, "__defaults__", (8,))
    monkeypatch.setattr(silhouette, "CELL_BLOCKS", cell)
    monkeypatch.setattr(silhouette, "SLICE_NUMBERS", numbers)
    rng = np.random.default_rng(11)
    own = np.repeat(np.arange(12), 15)
    x = rng.normal(size=(12, 3))[own] * 20 + rng.normal(size=(len(own), 3))
    x, own = np.concatenate([x, x[:20], [[90.0, 0, 0]]]), np.append(np.append(own, own[:20]), 99)
    df = frame(spark, x, cluster=[int(c) for c in own])
    got = column(silhouette.silhouette_rows(df, "id", COLUMNS, "cluster"), "silhouette")
    assert got == pytest.approx(brute.silhouettes(x, own))
    points = blocks.weighted_points(df, "id", COLUMNS, "cluster")
    held = blocks.packed(points, "cluster", ["pid", "w"])
    wanted = silhouette._wanted(held, silhouette._centres(points, 3, "cluster"), 3, "cluster")
    assert wanted.count() < held.count() * 13 / 3


def test_one_cluster_has_no_silhouette(spark):
    df = frame(spark, brute.blobs(4), cluster=[0] * 109)
    made = silhouette.mean_silhouette(df, "id", COLUMNS, "cluster")
    assert made.first()["silhouette"] is None


@pytest.mark.parametrize("leaf, fan", [(1000, 256), (30, 256), (6, 3)])
def test_nearest(spark, monkeypatch, leaf, fan):
    monkeypatch.setattr(blocks.packed, "__defaults__", (8,))
    monkeypatch.setattr(pivot_tree, "LEAF_ROWS", leaf)
    monkeypatch.setattr(pivot_tree, "FAN", fan)
    x, y = np.unique(brute.blobs(5), axis=0), np.unique(brute.blobs(6), axis=0)
    point = blocks.as_point(COLUMNS)
    test = frame(spark, x).withColumnRenamed("id", "t").withColumn("_x", point)
    train = frame(spark, y).withColumn("_x", point)
    found = neighbours.nearest(test, train, 5, "t", "id")
    got = {(r["t"], r["place"]): (r["id"], r["distance"]) for r in found.collect()}
    d = brute.distances(x, y)
    for t in range(len(x)):
        order = sorted(range(len(y)), key=lambda j: (d[t, j], j))[:5]
        for place, j in enumerate(order, 1):
            assert got[(t, place)][0] == j
            assert got[(t, place)][1] == pytest.approx(d[t, j])


def test_leaves_are_bounded_and_few_are_visited(spark, monkeypatch):
    """Whatever the number of points, a leaf fits and a search reads few."""
    monkeypatch.setattr(pivot_tree, "LEAF_ROWS", 8)
    monkeypatch.setattr(pivot_tree, "FAN", 4)
    rng = np.random.default_rng(6)
    # Distances that shrink by halves split badly; equal points do not split.
    lines = np.concatenate([rng.random(300), 2.0 ** -np.arange(40), np.full(12, 0.5)])
    x = np.column_stack([lines, np.zeros(len(lines)), np.zeros(len(lines))])
    train = frame(spark, x).withColumn("_x", blocks.as_point(COLUMNS))
    tree = pivot_tree.build(train, "id", [], 3)
    assert len(tree.levels) > 3
    held = [r["count"] for r in tree.points.groupBy("node").count().collect()]
    assert sum(held) == len(x) and sorted(held)[-2] <= 8 and max(held) == 13
    test = train.filter("id < 50").withColumnRenamed("id", "t")
    visited = pivot_tree.visits(test, tree, "t", 3).groupBy("t").count().collect()
    assert len(visited) == 50 and np.mean([r["count"] for r in visited]) < len(held) / 4


@pytest.mark.parametrize("d", [3, 40])
def test_many_dimensions_meet_in_cells(spark, monkeypatch, d):
    monkeypatch.setattr(pivot_tree, "LEAF_ROWS", 64)
    monkeypatch.setattr(neighbours, "CELL_NUMBERS", 512 * d)
    monkeypatch.setattr(neighbours, "_FIRST", 16)
    monkeypatch.setattr(neighbours, "_TILE", 9_000)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, d)).round(6)
    x[700:740] = x[:40]  # ties
    train = spark.createDataFrame([(i, p.tolist(), i % 3) for i, p in enumerate(x)], "id long, _x array<double>, c int")
    test = spark.createDataFrame([(f"t{i}", p.tolist()) for i, p in enumerate(x[:90])], "t string, _x array<double>")
    used = []
    by_cells = neighbours._by_cells
    monkeypatch.setattr(neighbours, "_by_cells", lambda *a: used.append(1) or by_cells(*a))
    found = neighbours.nearest(test, train, 4, "t", "id", ["c"]).collect()
    assert bool(used) == (d == 40)
    away = np.sqrt(pivot_tree.squared_distances(x[:90], x))
    want = {
        (f"t{i}", place + 1): (int(j), int(j) % 3, away[i, j])
        for i in range(90)
        for place, j in enumerate(np.lexsort((np.arange(1500), away[i]))[:4])
    }
    assert {(r["t"], r["place"]): (r["id"], r["c"], r["distance"]) for r in found} == want


@pytest.mark.parametrize("d,far", [(3, 0.0), (3, 1e6), (20, 3.0)])
def test_distances_by_product_keep_their_precision(d, far):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(70, d)) + far, rng.normal(size=(50, d)) + far
    b[:10], b[10:20] = a[:10], a[:10] + 1e-7
    want = np.sqrt(pivot_tree.squared_distances(a, b))
    assert np.allclose(blocks.distances(a, b), want, rtol=1e-11, atol=0)
    b[0, 0] = np.nan
    assert np.isnan(blocks.distances(a, b)[:, 0]).all() and not np.isnan(blocks.distances(a, b)[:, 1:]).any()


def test_leaf_that_many_blocks_ask_for(spark, monkeypatch):
    monkeypatch.setattr(pivot_tree, "LEAF_ROWS", 64)
    monkeypatch.setattr(neighbours, "ASKING_BLOCKS", 1)
    monkeypatch.setattr(neighbours.packed, "__defaults__", (16,))
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 2))
    y = rng.normal(size=(300, 2)) * 0.01
    train = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, _x array<double>")
    test = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(y)], "t long, _x array<double>")
    found = neighbours.nearest(test, train, 3, "t", "id").collect()
    away = pivot_tree.squared_distances(y, x)
    want = {(i, p + 1, int(j)) for i in range(300) for p, j in enumerate(np.argsort(away[i])[:3])}
    assert {(r["t"], r["place"], r["id"]) for r in found} == want


def test_near_pairs_of_few_and_of_broken_points():
    a, b = np.array([[0.0, 1.0], [np.nan, 0.0]]), np.array([[0.0, 1.0], [np.inf, 1.0], [3.0, 5.0]])
    i, j, away = neighbours._near_pairs(a[:1], b, 2)
    assert list(zip(i, j, away)) == [(0, 0, 0.0), (0, 2, 25.0)]
    assert len(neighbours._near_pairs(a, b, 3)[0]) == 6
    assert neighbours._near_pairs(a, b, 1)[0].tolist() == [0]
    assert len(neighbours._near_pairs(a, b[:0], 1)[0]) == 0


def test_points_too_close_to_tell_apart(spark, monkeypatch):
    monkeypatch.setattr(pivot_tree, "LEAF_ROWS", 2)
    df = frame(spark, [[i * 1e-200, 0.0, 0.0] for i in range(5)])
    train = df.withColumn("_x", blocks.as_point(COLUMNS))
    found = neighbours.nearest(train.withColumnRenamed("id", "t"), train, 1, "t", "id").collect()
    assert len(found) == 5 and all(r["distance"] == 0 for r in found)


@pytest.mark.parametrize("leave_out_self", [True, False])
def test_votes(spark, leave_out_self):
    x = brute.blobs(7)
    labels = [int(i % 3) for i in range(len(x))]
    df = frame(spark, x, label=labels)
    lists = neighbours.neighbour_lists(df, df, COLUMNS, "label", 5, "id", leave_out_self)
    d = brute.distances(x, x)
    for k in (2, 5):
        made = lists.withColumn("p", neighbours.vote(F.col("neighbours"), k))
        want = []
        for i in range(len(x)):
            others = [j for j in range(len(x)) if not (leave_out_self and j == i)]
            near = sorted(others, key=lambda j: (d[i, j], j))[:k]
            votes = [labels[j] for j in near]
            want.append(min(set(votes), key=lambda v: (-votes.count(v), v)))
        assert column(made, "p") == want


def test_distance_curve_and_knee(spark):
    x = brute.blobs(8)
    curve = neighbours.distance_curve(frame(spark, x), COLUMNS, 10)
    d = np.sort(np.sort(brute.distances(x, x), axis=1)[:, 10])
    got = np.concatenate(
        [[r["distance"]] * r["rows"] for r in curve.orderBy("distance").collect()]
    )
    assert np.allclose(got, d)
    gaps = np.arange(len(d)) / (len(d) - 1) - (d - d[0]) / (d[-1] - d[0])
    at = neighbours.knee(curve).first()
    assert at["position"] == gaps.argmax()
    assert at["distance"] == pytest.approx(d[gaps.argmax()])


def test_components_of_a_long_chain(spark):
    n = 60
    nodes = spark.createDataFrame([(str(i), (i * 37) % n) for i in range(n)], "node string, seed int")
    edges = spark.createDataFrame(
        [(str(i), str(i + 1)) for i in range(n - 1) if i != 40], "a string, b string"
    )
    got = {r["node"]: r["label"] for r in connected(nodes, edges).collect()}
    first, second = range(41), range(41, n)
    assert {got[str(i)] for i in first} == {min((i * 37) % n for i in first)}
    assert {got[str(i)] for i in second} == {min((i * 37) % n for i in second)}


def test_components_with_a_hub(spark):
    """A hub of 100 000 links, a second one and a tail, any node order."""
    n = 100_000
    spokes = spark.range(1, n).selectExpr("id as a", "0L as b")
    more = spark.createDataFrame(
        [(n, n + 1), (n + 1, n + 2), (n, n), (n + 2, n), (5, n + 3), (n + 3, n + 4)], "a long, b long"
    )
    nodes = spark.range(n + 7).selectExpr("id as node", "(id * 7919) % 1000003 as seed")
    got = connected(nodes, spokes.unionByName(more)).join(nodes, "node")
    sizes = {r["label"]: (r["n"], r["least"]) for r in got.groupBy("label").agg(
        F.count("*").alias("n"), F.min("seed").alias("least")).collect()}
    assert all(label == least for label, (_, least) in sizes.items())
    assert sorted(s for s, _ in sizes.values()) == [1, 1, 3, n + 2]


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = np.random.default_rng(seed)
    links = rng.integers(0, 150, (110, 2))
    want = list(range(150))
    for _ in want:
        for a, b in links.tolist():
            want[a] = want[b] = min(want[a], want[b])
    nodes = spark.range(150).selectExpr("cast(id as string) as node", "id as seed")
    edges = spark.createDataFrame([(str(a), str(b)) for a, b in links.tolist()], "a string, b string")
    assert {int(r["node"]): r["label"] for r in connected(nodes, edges).collect()} == dict(enumerate(want))


def test_dbscan_of_two_dense_cells_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks.packed, "__defaults__", (8,))
    monkeypatch.setattr("gleanwork.operators.dbscan.HOT_BLOCKS", 3)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.random((150, 3)) * 0.4, rng.random((150, 3)) * 0.4 + [0.6, 0, 0], [[5, 5, 5]]])
    made = dbscan(frame(spark, x), "id", COLUMNS, 0.7, 5)
    assert column(made, "cluster") == numbers(brute.dbscan(x, list(range(len(x))), 0.7, 5))


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_neighbouring_cells_never_meet_by_broadcast(spark):
    """A few blocks ask for many cells: their written size tells little of that."""
    x = np.random.default_rng(3).normal(size=(300, 3))
    points = blocks.weighted_points(frame(spark, x), "id", COLUMNS)
    packed = blocks.packed(with_cell(points, 0.5), "cell", ["pid"])
    steps = offsets(3, 0.5, 0.8, own=False)
    found = dbscan_module._adjacent(packed, packed, steps, 0.8)
    assert found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin[^\n]*\[r_cell#\d+L?, salt#\d+\]", plan)
    assert not re.search(r"BroadcastHashJoin[^\n]*\[r_cell#\d+L?, salt#\d+\]", plan)


def test_kmeans_finds_blobs(spark):
    x = brute.blobs(9, outliers=0, copies=3)
    truth = [0] * 40 + [1] * 30 + [2] * 25 + [0] * 3
    made = column(centroids.kmeans(frame(spark, x), "id", COLUMNS, 3, 3), "cluster")
    assert same_partition(made, truth)


@pytest.mark.parametrize("covariance", centroids.COVARIANCES)
def test_mixture_matches_plain_em(spark, covariance):
    x = brute.blobs(10, spread=1.3)
    df = frame(spark, x)
    start = column(centroids.kmeans(df, "id", COLUMNS, 3, 1), "cluster")
    made = centroids.gaussian_mixture(df, "id", COLUMNS, 3, covariance)
    assert column(made, "cluster") == brute.mixture(x, start, 3, covariance)


def test_unfinished_fits_are_reported(spark):
    df = frame(spark, brute.blobs(10))
    with pytest.warns(UserWarning, match="did not settle"):
        centroids.gaussian_mixture(df, "id", COLUMNS, 3, max_rounds=1)
    with pytest.warns(UserWarning, match="did not settle"):
        mean_shift(df, "id", COLUMNS, 2.0, max_rounds=0)


def test_random_start_is_repeatable(spark):
    df = frame(spark, brute.blobs(10))
    runs = [
        column(centroids.gaussian_mixture(df, "id", COLUMNS, 3, "diag", "random"), "cluster")
        for _ in range(2)
    ]
    assert runs[0] == runs[1]


def test_purity_and_counts(spark):
    df = spark.createDataFrame(
        [("a", 0), ("a", 0), ("b", 0), ("b", 1), ("b", 1), ("a", -1)], "label string, cluster int"
    )
    assert cluster_metrics.purity(df, "label", "cluster").first()["purity"] == pytest.approx(5 / 6)
    assert cluster_metrics.cluster_count(df, "cluster").first()["clusters"] == 2
