import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from gleanwork.operators import batched, classification


def _table(spark, classes, n=240, seed=3, d=3):
    made = np.random.default_rng(seed)
    x = made.normal(size=(n, d)) * ([1.0, 50.0, 0.02] + [1.0] * d)[:d] + ([3.0, -400.0, 0.0] + [0.0] * d)[:d]
    pull = (x - x.mean(axis=0)) / x.std(axis=0)
    y = np.clip(np.digitize(pull.sum(axis=1) + made.normal(size=n), [-0.7, 0.9]), 0, classes - 1)
    columns = [f"c{j}" for j in range(d)]
    rows = [(i, *map(float, p), int(l)) for i, (p, l) in enumerate(zip(x, y))]
    schema = "id int, " + ", ".join(f"{c} double" for c in columns) + ", label int"
    df = spark.createDataFrame(rows, schema)
    return classification.stratified_folds(df, "id", "label", 3).cache(), columns


def test_descent_finds_the_bottom_of_a_narrow_valley():
    scale = np.array([1.0, 1e3, 1e-2, 30.0])
    goal = np.array([5.0, -2.0, 100.0, 0.0])
    asked = []

    def answer(points):
        asked.append(len(points))
        return {
            m: (((p - goal * (m + 1)) ** 2 * scale).sum() / 2, (p - goal * (m + 1)) * scale)
            for m, p in points.items()
        }

    found = batched.lock_step([batched.descent(np.zeros(4), 1e-9) for _ in range(3)], answer)
    for m, end in enumerate(found):
        assert np.allclose(end, goal * (m + 1), atol=1e-6)
    assert asked[0] == 3 and len(asked) < 300


@pytest.mark.parametrize("classes", [2, 3])
def test_logistic_models_equal_single_fits(spark, classes):
    folded, columns = _table(spark, classes)
    points = batched._points(folded, columns, "label")
    shape = batched._Shape(points, len(columns), 3)
    settings = [(fold, c) for fold in range(3) for c in (0.05, 4.0)]
    models = batched.fitted_logistic(points, shape, settings)
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(folded)
    for (fold, c), model in zip(settings, models):
        train = vectors.filter(F.col("fold") != fold)
        fit = LogisticRegression(
            featuresCol="v", labelCol="label", regParam=1.0 / (c * train.count()),
            standardization=False, maxIter=2000, tol=1e-12,
        ).fit(train)
        coef = model[:, :-1] / shape.spread
        bias = model[:, -1] - coef @ shape.mean
        wanted = fit.interceptVector.toArray()
        assert np.allclose(coef, fit.coefficientMatrix.toArray(), rtol=2e-3, atol=2e-4)
        assert np.allclose(bias - bias.mean(), wanted - wanted.mean(), rtol=2e-3, atol=5e-3) or classes == 2
        if classes == 2:
            assert np.allclose(bias, wanted, rtol=2e-3, atol=5e-3)


def test_logistic_scores_equal_single_predictions(spark):
    folded, columns = _table(spark, 3)
    cs = [0.05, 1.0, 4.0]
    found = batched.logistic_scores(folded, columns, "label", cs, 3)
    for fold in range(3):
        train, test = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        for c, score in zip(cs, found[fold]):
            made = classification.predict("logistic", {"C": c}, train, test, columns, "label", "id")
            own = made.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]
            assert abs(own - score) <= 1.5 / test.count()  # a row on the border may differ


def test_a_forest_cut_at_a_depth_is_a_forest_of_that_depth(spark):
    # One feature: no draw of features, so trees depend on the rows alone.
    folded, columns = _table(spark, 3, d=1)
    tried = [{"n_estimators": 4, "max_depth": d} for d in (1, 2, 3, 5)]
    found = batched.forest_scores(folded, columns, "label", tried, 3, seed=7)
    points = batched._points(folded, columns, "label")
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(
        points.withColumn(columns[0], F.get("x", F.lit(0)))
    )
    for fold in range(3):
        train, test = vectors.filter(F.col("fold") != fold), vectors.filter(F.col("fold") == fold)
        for t, score in zip(tried, found[fold]):
            fit = RandomForestClassifier(
                featuresCol="v", labelCol="y", numTrees=4, maxDepth=t["max_depth"],
                featureSubsetStrategy="sqrt", seed=7,
            ).fit(train)
            made = fit.transform(test).agg(F.avg((F.col("y") == F.col("prediction")).cast("int")))
            assert made.first()[0] == pytest.approx(score)


def test_first_trees_vote_alone(spark):
    folded, columns = _table(spark, 3)
    tried = [{"n_estimators": n, "max_depth": 4} for n in (3, 1, 2)]
    found = batched.forest_scores(folded, columns, "label", tried, 3, seed=1)
    points = batched._points(folded, columns, "label")
    for fold in range(3):
        trees = batched._grown(points.filter(F.col("fold") != fold), 3, 4, 1)
        rows = points.filter(F.col("fold") == fold).collect()
        for t, score in zip(tried, found[fold]):
            hits = 0
            for row in rows:
                votes = np.zeros(3)
                for tree in trees[: t["n_estimators"]]:
                    node = 0
                    while tree.left[node] >= 0:
                        low = row["x"][tree.feature[node]] <= tree.cut[node]
                        node = tree.left[node] if low else tree.right[node]
                    votes += tree.votes[node]
                hits += int(votes.argmax()) == row["y"]
            assert score == pytest.approx(hits / len(rows))


@pytest.mark.parametrize("model,grid", [
    ("logistic", [{"C": 1}, {"C": 2}]),
    ("random_forest", [{"n_estimators": 2, "max_depth": 2}]),
    ("knn", [{"n_neighbors": 2}]),
])
def test_empty_tables_and_folds_without_rows(spark, model, grid):
    empty = spark.createDataFrame([], "id int, a double, label int")
    assert [s for _, s in classification.grid_search(model, grid, empty, ["a"], "label", "id", 3)] == [None] * len(grid)
    few = spark.createDataFrame([(i, float(i % 2), i % 2) for i in range(4)], "id int, a double, label int")
    found = classification.grid_search(model, grid, few, ["a"], "label", "id", 5)
    assert all(0.0 <= s <= 1.0 for _, s in found)


@pytest.mark.parametrize("value,label", [(None, 1), (float("nan"), 1), (1.0, None)])
def test_missing_values_raise(spark, value, label):
    rows = [(0, 1.0, 0, 0), (1, value, label, 1)]
    folded = spark.createDataFrame(rows, "id int, a double, label int, fold int")
    with pytest.raises(ValueError, match="1 rows lack"):
        batched.logistic_scores(folded, ["a"], "label", [1.0], 2)
