import glob
import os
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwork.operators import classification, cluster_metrics
from gleanwork.plans import sweep
from gleanwork.session import Shelf, scratch_dir, settle, side_by_side, tidy
from tests import brute

COLUMNS = ["x", "y", "z"]


@pytest.fixture(scope="module")
def table(spark):
    x = brute.blobs(20, outliers=0, copies=2)
    labels = [0] * 40 + [1] * 30 + [2] * 25 + [0] * 2
    rows = [(i, *map(float, p), l) for i, (p, l) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "id int, x double, y double, z double, label int")


def test_expansion():
    assert sweep.expanded([3, 100, 10]) == [3, 13, 23, 33, 43, 53, 63, 73, 83, 93]
    assert sweep.expanded([0.1, 0.9, 0.1]) == [0.1, 0.9]
    assert sweep.expanded([True, False]) == [True, False]
    assert sweep.candidates({"b": [1, 3, 1], "a": ["u", "v"]}) == [
        {"a": "u", "b": 1},
        {"a": "u", "b": 2},
        {"a": "v", "b": 1},
        {"a": "v", "b": 2},
    ]
    sizes = {m: len(sweep.candidates(g)) for m, g in sweep.CLASSIFIER_GRIDS.items()}
    assert sizes == {"random_forest": 56, "knn": 8, "logistic": 4}
    sizes = {m: len(sweep.candidates(g)) for m, g in sweep.CLUSTER_GRIDS.items()}
    assert sizes == {"kmeans": 60, "gmm": 16, "dbscan": 18, "meanshift": 4}


def test_registry():
    assert list(sweep.selected(["robust", "standard"], sweep.scalers.SCALERS)) == ["robust", "standard"]
    for wrong in ([], ["nope"]):
        with pytest.raises(ValueError):
            sweep.selected(wrong, sweep.scalers.SCALERS)


def test_folds_are_stratified(table):
    rows = classification.stratified_folds(table, "id", "label", 5).collect()
    for label, n in ((0, 42), (1, 30), (2, 25)):
        per_fold = [sum(r["label"] == label and r["fold"] == f for r in rows) for f in range(5)]
        assert sum(per_fold) == n and max(per_fold) - min(per_fold) <= 1
        ordered = [r["fold"] for r in sorted(rows, key=lambda r: r["id"]) if r["label"] == label]
        assert ordered == sorted(ordered)
    totals = [sum(r["fold"] == f for r in rows) for f in range(5)]
    assert max(totals) - min(totals) <= 1


@pytest.mark.parametrize(
    "model,params",
    [
        ("random_forest", {"n_estimators": 5, "max_depth": 4}),
        ("knn", {"n_neighbors": 3}),
        ("logistic", {"C": 1}),
    ],
)
def test_models_separate_blobs(table, model, params):
    folded = classification.stratified_folds(table, "id", "label").cache()
    train, test = folded.filter("fold > 0"), folded.filter("fold = 0")
    made = classification.predict(model, params, train, test, COLUMNS, "label", "id")
    assert made.count() == test.count()
    assert cluster_metrics.accuracy(made, "label", "prediction").first()["accuracy"] > 0.9


def test_grid_search_and_sweep(table):
    found = classification.grid_search(
        "knn", [{"n_neighbors": k} for k in (2, 3)], table, COLUMNS, "label", "id", folds=3
    )
    assert [c["n_neighbors"] for c, _ in found] == [2, 3]
    assert classification.best_candidate([({"a": 1}, None), ({"a": 2}, 0.5), ({"a": 3}, 0.5)])[0] == {"a": 2}
    folded = classification.stratified_folds(table, "id", "label").drop("fold").cache()
    grids = {"logistic": {"C": [1, 2, 1]}}
    for chain in (False, True):
        trials = sweep.classification_sweep(
            table, folded, COLUMNS, "label", "id", ["standard", "min_max"], grids, 3, 0, chain, chain
        )
        rows = trials.collect()
        assert [r["scaler"] for r in rows] == ["standard", "min_max"]
        assert all(r["score"] > 0.8 for r in rows)
        assert sweep.best_trial(trials).count() == 1
        assert sweep.best_per_model(trials, 1).count() == 1


def test_clustering_sweep_and_refit(table):
    grids = {
        "kmeans": {"n_clusters": [3, 5, 1], "n_init": [1, 2, 1], "algorithm": ["auto", "elkan"]},
        "dbscan": {"eps": [0.001, 1.5], "min_samples": [5, 6, 1]},
    }
    trials = sweep.clustering_sweep(table, "id", [COLUMNS, ["x", "y"]], ["max_abs"], grids)
    best = trials.filter((F.size("features") == 3) & (F.col("model") == "kmeans")).first()
    assert best["params"]["n_clusters"] == "3" and best["score"] > 0.6
    made = sweep.refit(
        table, "id", "label", [COLUMNS, ["x", "y"]], "standard", "kmeans", {"n_clusters": 3, "n_init": 2}
    )
    report = sweep.refit_report(made, "label").orderBy("feature_set").collect()
    assert [r["clusters"] for r in report] == [3, 3] and report[0]["purity"] == 1.0
    sizes = sweep.refit_sizes(made, "label").filter("feature_set = 0 and kind = 'class'").collect()
    assert sorted(r["n"] for r in sizes) == [25, 30, 42]


def test_no_clusters_score_nothing(table):
    found = sweep.cluster_search(
        "dbscan", [{"eps": 1e-6, "min_samples": 50}], table, "id", COLUMNS
    )
    assert found[0][1] is None
    counted = sweep.cluster_search(
        "kmeans", [{"n_clusters": 2, "n_init": 1}], table, "id", COLUMNS, lambda df: float(df.count())
    )
    assert counted[0][1] == 97.0


def test_searches_leave_no_scratch_tables(spark):
    root = Path(scratch_dir(spark).removeprefix("file:"))
    written = lambda: {p for p in root.rglob("*") if p.is_dir() and p.name == "table"}
    rows = [(i, i % 7 * 0.5, i % 5 * 0.25, i % 2) for i in range(60)]
    df = settle(spark.createDataFrame(rows, "id int, a double, b double, label int"))
    before = written()
    tried = sweep.candidates({"eps": [0.3, 0.6], "min_samples": [2]})
    assert len(sweep.cluster_search("dbscan", tried, df, "id", ["a", "b"])) == 2
    ks = sweep.candidates({"n_neighbors": [2, 4, 1]})
    assert len(classification.grid_search("knn", ks, df, ["a", "b"], "label", "id")) == 2
    assert written() == before


def test_a_failed_search_leaves_no_scratch_tables(spark):
    root = Path(scratch_dir(spark).removeprefix("file:"))
    before = set(root.rglob("*"))
    with pytest.raises(ZeroDivisionError), tidy(spark):
        settle(spark.range(3))
        1 / 0
    assert set(root.rglob("*")) == before


def _scratch_tables(spark):
    from gleanwork.session import scratch_dir

    root = scratch_dir(spark).removeprefix("file:")
    return {os.path.dirname(f) for f in glob.glob(f"{root}/**/_SUCCESS", recursive=True)}


def test_study_keeps_the_winner_and_nothing_else(spark):
    x = brute.blobs(4, spread=0.4)
    y = np.random.default_rng(1).random(x.shape)
    rows = [(i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, e double, f double")
    grids = {"dbscan": {"eps": [0.2, 0.5], "min_samples": [4]}}
    sets = [["d", "e", "f"], ["a", "b", "c"]]
    before = _scratch_tables(spark)
    found = sweep.clustering_study(df, "id", sets, ["standard", "max_abs"], grids)
    won = found.winner
    trials = found.trials.collect()
    first = max(trials, key=lambda t: (t["score"] or -1, -t["trial_no"]))
    assert (won.score, won.scaler, won.features) == (first["score"], first["scaler"], first["features"])
    assert len(_scratch_tables(spark) - before) == 2
    scaled = sweep.scalers.scale(df.select("id", *won.features), won.features, won.scaler)
    assert sorted(won.matrix.collect()) == sorted(scaled.select(won.matrix.columns).collect())
    again = sweep.cluster(won.model, won.params, scaled, "id", won.features)
    assert sorted(won.labels.collect()) == sorted(again.select("id", "cluster").collect())
    knees = {(tuple(k["features"]), k["scaler"]) for k in found.knees.collect()}
    assert knees == {(tuple(s), n) for s in sets for n in ("standard", "max_abs")}
    labelled = df.withColumn("label", F.col("id") % 3)
    tables = sweep.refit_winner(labelled, "id", "label", sets, won)
    assert [t.columns for t in tables] == [["id", "label", *s, "cluster"] for s in sets]
    own = {r["id"]: r["cluster"] for r in tables[sets.index(won.features)].collect()}
    assert own == {r["id"]: r["cluster"] for r in won.labels.collect()}


def test_study_fits_nothing_twice(spark, monkeypatch):
    """The labels of the winner are those of its search; a tie goes to the first set."""
    fits = []
    fitted = sweep.cluster
    monkeypatch.setattr(
        sweep, "cluster", lambda model, params, *a: fits.append(params["eps"]) or fitted(model, params, *a)
    )
    x = brute.blobs(4, spread=0.4)
    rows = [(i, *map(float, a), *map(float, a)) for i, a in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, e double, f double")
    sets = [["d", "e", "f"], ["a", "b", "c"]]
    grids = {"dbscan": {"eps": [0.2, 0.5], "min_samples": [4]}}
    found = sweep.clustering_study(df, "id", sets, ["standard"], grids)
    assert sorted(fits) == [0.2, 0.2, 0.5, 0.5]
    scores = [t["score"] for t in found.trials.orderBy("trial_no").collect()]
    assert scores[0] == pytest.approx(scores[1], abs=1e-12) and found.winner.score == max(scores)
    assert found.winner.features == sets[scores.index(max(scores))]
    again = fitted("dbscan", found.winner.params, found.winner.matrix, "id", found.winner.features)
    assert sorted(found.winner.labels.collect()) == sorted(again.select("id", "cluster").collect())


def test_best_fit_is_that_of_the_first_place(spark):
    """Fits end in any order."""
    best = sweep._Best(Shelf(spark))
    offers = [(0.2, (1, 0)), (None, (0, 0)), (0.4, (2, 1)), (0.4, (2, 0)), (0.4, (3, 0)), (0.0, (0, 1))]
    for n, (score, place) in enumerate(offers):
        best.offer(score, place, spark.range(n, n + 1))
    assert best.rank == (0.4, (2, 0)) and best.held[0].collect() == [(3,)]


def test_settings_outlive_tables_written_side_by_side(spark):
    names = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled"]
    before = [spark.conf.get(n, None) for n in names]
    with tidy(spark):
        side_by_side(lambda i: settle(spark.range(i)), range(12))
    assert [spark.conf.get(n, None) for n in names] == before


def test_study_without_a_score_has_no_winner(spark):
    rows = [(i, float(i), 0.5, 1.0) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    found = sweep.clustering_study(
        df, "id", [["a", "b"]], ["standard"], {"dbscan": {"eps": [0.001], "min_samples": [3]}}
    )
    assert found.winner is None and found.trials.first()["score"] is None
    assert found.knees.count() == 1


def test_study_queries_without_a_winner_have_no_rows(spark, tmp_path, monkeypatch):
    """The SQL gives no rows either where no trial scores above 0."""
    import duckdb

    from catalog import cluster_queries

    # Far corners: every point is noise, so no trial has a second cluster.
    rows = [(i, [float(i >> j & 1) for j in range(9)] + [0.0] * 55, i % 3) for i in range(0, 512, 37)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    # test_study_without_a_score_has_no_winner runs such a study.
    none = sweep.Study(None, None, None)
    monkeypatch.setattr(sweep, "clustering_study", lambda *a, **b: none)
    for name in ("k12_best_matrix", "k13_winner_purity"):
        made = cluster_queries.QUERIES[name](spark, str(tmp_path))
        wanted = con.execute(cluster_queries.ORACLES[name])
        assert made.columns == [c[0] for c in wanted.description]
        assert made.count() == 0 and not wanted.fetchall()
