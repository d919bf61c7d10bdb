"""Model selection over feature sets, scalers, models and parameters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import product
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanwork.operators import classification, cluster_metrics, scalers
from gleanwork.operators.centroids import gaussian_mixture, kmeans
from gleanwork.operators.dbscan import dbscan
from gleanwork.operators.mean_shift import mean_shift
from gleanwork.operators.neighbours import distance_curve, knee
from gleanwork.operators.preparation import numeric_columns
from gleanwork.operators.silhouette import mean_silhouette
from gleanwork.session import Shelf, settle, side_by_side, tidy

# --- fixed values -----------------------------------------------------------
# [start, end, step] with an exclusive end where the first value is an int,
# the values themselves otherwise.
CLASSIFIER_GRIDS: dict[str, dict[str, list]] = {
    "random_forest": {"n_estimators": [3, 10, 1], "max_depth": [2, 10, 1]},
    "knn": {"n_neighbors": [2, 10, 1]},
    "logistic": {"C": [1, 5, 1]},
}
CLUSTER_GRIDS: dict[str, dict[str, list]] = {
    "kmeans": {
        "n_clusters": [3, 100, 10],
        "n_init": [10, 30, 10],
        "algorithm": ["auto", "full", "elkan"],
    },
    "gmm": {
        "n_components": [3, 5, 1],
        "covariance_type": ["full", "tied", "diag", "spherical"],
        "init_params": ["kmeans", "random"],
    },
    "dbscan": {"eps": [0.1, 0.9, 0.1], "min_samples": [100, 1000, 100]},
    "meanshift": {"bandwidth": [3, 5, 1], "cluster_all": [True, False]},
}
# ----------------------------------------------------------------------------

SCALER_NAMES = tuple(scalers.SCALERS)

Scorer = Callable[[DataFrame], float | None]


def expanded(values: Sequence) -> list:
    """The range ``start, end, step`` where three values start with an int,
    else the values themselves (C-1, K-10). Repeated values are tried once."""
    if len(values) == 3 and type(values[0]) is int:
        return list(range(*map(int, values)))
    return list(dict.fromkeys(values))


def candidates(grid: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    """All combinations of the expanded parameters, names in sorted order and
    the last one varying fastest."""
    names = sorted(grid)
    return [dict(zip(names, c)) for c in product(*[expanded(grid[n]) for n in names])]


def selected(names: Sequence[str], known: Mapping[str, Any]) -> dict[str, Any]:
    """Registry entries by name, in the given order (C-8)."""
    unknown = [n for n in names if n not in known]
    if unknown or not names:
        raise ValueError(f"choose from {sorted(known)}, not {unknown or 'nothing'}")
    return {n: known[n] for n in names}


# --- leaderboards -----------------------------------------------------------


def best_per_model(trials: DataFrame, n: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """The best ``n`` trials of each model, earlier trials first on ties (W-11)."""
    order = Window.partitionBy("model").orderBy(F.desc_nulls_last("score"), "trial_no", *ties)
    return trials.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def best_trial(trials: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """The best trial of all, the first one on ties (W-12)."""
    return trials.orderBy(F.desc_nulls_last("score"), "trial_no", *ties).limit(1)


_TRIALS = (
    "trial_no int, model string, scaler string, features array<string>, "
    "params map<string,string>, score double"
)


def _trial_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(i + 1, *row) for i, row in enumerate(rows)], _TRIALS)


def _as_text(params: Mapping) -> dict[str, str]:
    return {k: str(v) for k, v in params.items()}


def search_table(
    spark: SparkSession, found: Sequence[tuple[str, Mapping, float | None]]
) -> DataFrame:
    """``<candidate, model, params, score>`` of searched candidates."""
    return spark.createDataFrame(
        [(i + 1, model, _as_text(params), score) for i, (model, params, score) in enumerate(found)],
        "candidate int, model string, params map<string,string>, score double",
    )


# --- classification ---------------------------------------------------------


def scaled_pairs(
    train: DataFrame,
    test: DataFrame,
    columns: Sequence[str],
    names: Sequence[str],
    chain: bool = False,
    fit_each: bool = False,
):
    """Yield ``(scaler, train, test)`` (P-6).

    By default each scaler starts from the raw tables and is fitted on the
    train table alone. ``chain`` lets it start from the output of the one
    before, ``fit_each`` fits the test table on itself.
    """
    raw_train, raw_test = train, test
    for name in names:
        fit = scalers.SCALERS[name]
        source, target = (train, test) if chain else (raw_train, raw_test)
        fitted = fit(source, columns)
        for_test = fit(target, columns) if fit_each else fitted
        train, test = settle(fitted.transform(source)), settle(for_test.transform(target))
        yield name, train, test


def classification_sweep(
    train: DataFrame,
    test: DataFrame,
    columns: Sequence[str],
    label: str,
    id_col: str,
    scaler_names: Sequence[str] = SCALER_NAMES,
    grids: Mapping[str, Mapping] = CLASSIFIER_GRIDS,
    folds: int = 5,
    seed: int = 0,
    chain: bool = False,
    fit_each: bool = False,
) -> DataFrame:
    """One trial per scaler and model (C-7): the best parameters by cross
    validation on the train table, scored by accuracy on the test table."""
    rows = []
    with tidy(train.sparkSession):
        for scaler, tr, te in scaled_pairs(train, test, columns, scaler_names, chain, fit_each):

            def trial(model: str) -> tuple:
                searched = classification.grid_search(
                    model, candidates(grids[model]), tr, columns, label, id_col, folds, seed
                )
                params, _ = classification.best_candidate(searched)
                made = classification.predict(model, params, tr, te, columns, label, id_col, seed)
                score = cluster_metrics.accuracy(made, label, "prediction").first()["accuracy"]
                return model, scaler, list(columns), _as_text(params), score

            # Each search is a row of short jobs; those of the models overlap.
            rows += side_by_side(trial, grids)
    return _trial_table(train.sparkSession, rows)


# --- clustering -------------------------------------------------------------


# How each model takes its parameters.
CLUSTERINGS: dict[str, Callable[..., DataFrame]] = {
    "kmeans": lambda df, on, seed, p: kmeans(
        df, *on, int(p["n_clusters"]), int(p["n_init"]), seed
    ),
    "gmm": lambda df, on, seed, p: gaussian_mixture(
        df, *on, int(p["n_components"]), p["covariance_type"], p["init_params"], seed
    ),
    "dbscan": lambda df, on, seed, p: dbscan(df, *on, float(p["eps"]), int(p["min_samples"])),
    "meanshift": lambda df, on, seed, p: mean_shift(
        df, *on, float(p["bandwidth"]), bool(p["cluster_all"])
    ),
}


def cluster(
    model: str, params: Mapping, df: DataFrame, id_col: str, columns: Sequence[str], seed: int = 0
) -> DataFrame:
    """Add ``cluster`` by the named model (K-1 to K-4)."""
    if model not in CLUSTERINGS:
        raise ValueError(f"unknown model: {model}")
    return CLUSTERINGS[model](df, (id_col, columns), seed, params)


def silhouette_scorer(id_col: str, columns: Sequence[str]) -> Scorer:
    """Mean silhouette of a table with a ``cluster`` column."""
    return lambda df: mean_silhouette(df, id_col, columns, "cluster").first()["silhouette"]


def cluster_search(
    model: str,
    tried: Sequence[Mapping],
    df: DataFrame,
    id_col: str,
    columns: Sequence[str],
    scorer: Scorer | None = None,
    seed: int = 0,
    seen: Callable[[int, float | None, DataFrame], None] | None = None,
) -> list[tuple[Mapping, float | None]]:
    """Candidates with their score on the whole table (K-11).

    ``scorer`` is any function of the labelled table (U-1). Candidates with
    fewer than two clusters have no silhouette. Candidates that differ only in
    ``algorithm`` share one fit. ``seen`` is called with the place, the score
    and the labelled table of every fit before the table is deleted.
    """
    score = scorer or silhouette_scorer(id_col, columns)
    key = lambda params: tuple((k, v) for k, v in params.items() if k != "algorithm")
    distinct = {key(params): params for params in tried}

    def fit_and_score(place: int, params: Mapping) -> float | None:
        with tidy(df.sparkSession):
            labelled = settle(cluster(model, params, df, id_col, columns, seed))
            found = score(labelled)
            if seen:
                seen(place, found, labelled)
            return found

    scores = side_by_side(lambda x: fit_and_score(*x), enumerate(distinct.values()))
    known = dict(zip(distinct, scores))
    return [(params, known[key(params)]) for params in tried]


@dataclass(frozen=True)
class Winner:
    """The best trial of a study with what it was fitted on.

    ``matrix`` is ``<id, scaled columns>``, ``labels`` is ``<id, cluster>``.
    Both are written tables that outlive the study.
    """

    model: str
    scaler: str
    features: list[str]
    params: dict[str, Any]
    score: float
    matrix: DataFrame
    labels: DataFrame


@dataclass(frozen=True)
class Study:
    """A clustering sweep: a trial per feature set, scaler and model, the knee
    of each scaled set, and the winner (None if no score is above 0)."""

    trials: DataFrame
    knees: DataFrame
    winner: Winner | None


_KNEES = "features array<string>, scaler string, position long, distance double"


def clustering_study(
    df: DataFrame,
    id_col: str,
    feature_sets: Sequence[Sequence[str]],
    scaler_names: Sequence[str] = SCALER_NAMES,
    grids: Mapping[str, Mapping] = CLUSTER_GRIDS,
    scorer: Callable[[str, Sequence[str]], Scorer] = silhouette_scorer,
    seed: int = 0,
    neighbour: int = 10,
) -> Study:
    """Search every model on every scaled feature set (K-12).

    Every scaler starts from the unscaled columns. A trial is the best
    candidate of a model; the winner is the first trial with the highest score
    above 0. Scaled sets are studied side by side, each with its knee and its
    models side by side, as small tables leave most cores idle. Scratch tables
    are deleted set by set, but for the matrix and the labels of the best fit
    so far: they move to a shelf outside, and a better fit replaces them. The
    knee of the curve of distances to the ``neighbour``-th neighbour is taken
    once per scaled set; a table of one row has no knee.
    """
    spark = df.sparkSession
    best = _Best(Shelf(spark))

    def studied(place: int, features: Sequence[str], scaler: str) -> tuple[list, tuple]:
        columns = numeric_columns(df.select(*features))
        score_by = scorer(id_col, columns)
        with tidy(spark):
            scaled = settle(scalers.scale(df.select(id_col, *columns), columns, scaler))

            def bend() -> tuple:
                found = knee(settle(distance_curve(scaled, columns, neighbour))).first()
                return (list(features), scaler, *(found or (None, None)))

            def trial(i: int, model: str) -> tuple:
                seen = lambda j, score, labelled: best.offer(
                    score, (place, i, j), scaled, labelled.select(id_col, "cluster")
                )
                searched = cluster_search(
                    model, candidates(grids[model]), scaled, id_col, columns, score_by, seed, seen
                )
                params, score = classification.best_candidate(searched)
                return model, scaler, list(features), params, score

            jobs = [bend, *(partial(trial, i, model) for i, model in enumerate(grids))]
            bent, *rows = side_by_side(lambda job: job(), jobs)
        return rows, bent

    jobs = [(i, *job) for i, job in enumerate(product(feature_sets, scaler_names))]
    found = side_by_side(lambda job: studied(*job), jobs)
    rows = [row for part, _ in found for row in part]
    winner = None
    for model, scaler, features, params, score in rows:
        if score is not None and score > (winner.score if winner else 0.0):
            winner = Winner(model, scaler, features, dict(params), score, *best.held)
    table = [(m, s, f, _as_text(p), score) for m, s, f, p, score in rows]
    knees = spark.createDataFrame([bent for _, bent in found], _KNEES)
    return Study(_trial_table(spark, table), knees, winner)


class _Best:
    """The tables of the best fit offered so far; the earlier place wins a tie,
    in whatever order fits end."""

    def __init__(self, shelf: Shelf):
        self.shelf, self.rank, self.held, self.lock = shelf, (0.0, ()), [], Lock()

    def offer(self, score: float | None, place: tuple, *tables: DataFrame) -> None:
        with self.lock:
            highest, first = self.rank
            if score is not None and (score > highest or (score == highest and place < first)):
                self.held, self.rank = self.shelf.put(*tables), (score, place)


def clustering_sweep(
    df: DataFrame,
    id_col: str,
    feature_sets: Sequence[Sequence[str]],
    scaler_names: Sequence[str] = SCALER_NAMES,
    grids: Mapping[str, Mapping] = CLUSTER_GRIDS,
    scorer: Callable[[str, Sequence[str]], Scorer] = silhouette_scorer,
    seed: int = 0,
) -> DataFrame:
    """The trials of ``clustering_study`` (K-12)."""
    return clustering_study(df, id_col, feature_sets, scaler_names, grids, scorer, seed).trials


def refit_winner(
    df: DataFrame,
    id_col: str,
    label: str,
    feature_sets: Sequence[Sequence[str]],
    winner: Winner,
    seed: int = 0,
) -> list[DataFrame]:
    """The winner's scaler, model and parameters on every feature set:
    ``<id, label, features, cluster>`` tables (K-13). Its own feature set is
    not fitted again: matrix and labels of the study are joined to the rows."""

    def fit(features: Sequence[str]) -> DataFrame:
        if list(features) == winner.features:
            found = winner.matrix.join(winner.labels, id_col)
            return settle(
                df.select(id_col, label).join(found, id_col).select(
                    id_col, label, *features, "cluster"
                )
            )
        return refit(
            df, id_col, label, [features], winner.scaler, winner.model, winner.params, seed
        )[0]

    return side_by_side(fit, feature_sets)


def refit(
    df: DataFrame,
    id_col: str,
    label: str,
    feature_sets: Sequence[Sequence[str]],
    scaler: str,
    model: str,
    params: Mapping,
    seed: int = 0,
) -> list[DataFrame]:
    """The chosen model on every feature set: ``<id, label, features, cluster>``
    tables (K-13)."""

    def fit(features: Sequence[str]) -> DataFrame:
        columns = list(features)
        scaled = scalers.scale(df.select(id_col, label, *columns), columns, scaler)
        return settle(cluster(model, params, settle(scaled), id_col, columns, seed))

    return side_by_side(fit, feature_sets)


def refit_report(refitted: Sequence[DataFrame], label: str) -> DataFrame:
    """``<feature_set, clusters, purity>``, one row per feature set (K-13)."""
    report = None
    for i, table in enumerate(refitted):
        row = table.transform(
            lambda t: cluster_metrics.purity(t, label, "cluster")
        ).select(
            F.lit(i).alias("feature_set"),
            cluster_metrics.cluster_count(table, "cluster").scalar().alias("clusters"),
            "purity",
        )
        report = row if report is None else report.unionAll(row)
    return report


def refit_sizes(refitted: Sequence[DataFrame], label: str) -> DataFrame:
    """``<feature_set, kind, value, n>``: rows per cluster and per class (K-13)."""
    sizes = None
    for i, table in enumerate(refitted):
        for kind, column in (("cluster", "cluster"), ("class", label)):
            part = cluster_metrics.group_sizes(table, column).select(
                F.lit(i).alias("feature_set"),
                F.lit(kind).alias("kind"),
                F.col(column).cast("string").alias("value"),
                "n",
            )
            sizes = part if sizes is None else sizes.unionAll(part)
    return sizes
