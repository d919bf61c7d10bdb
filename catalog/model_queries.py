"""Classification on vectors and on labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.common import table
from gleanwork.functions import text as tx
from gleanwork.operators import classification, cluster_metrics, neighbours
from gleanwork.plans import sweep
from gleanwork.session import settle, spread

QUERIES = {}
ORACLES = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of every labelled document with its quality."""
    docs = spread(table(spark, sf_dir, "documents")).join(
        table(spark, sf_dir, "labels"), "doc_id"
    )
    tokens = docs.select("doc_id", "quality", "text", tx.word_tokens(F.col("text")).alias("t"))
    return tokens.select(
        "doc_id",
        "quality",
        F.log1p(F.length("text")).alias("chars"),
        F.log1p(F.size("t")).alias("tokens"),
        tx.ratio_or_zero(F.size(F.array_distinct("t")), F.size("t")).alias("variety"),
        tx.ratio_or_zero(F.size(F.filter("t", lambda t: tx.not_stopped(t))), F.size("t")).alias("content"),
    )


TEXT_FEATURES = ["chars", "tokens", "variety", "content"]


def split(df: DataFrame, id_col: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Train and test table: one stratified fold is the test table."""
    folded = settle(classification.stratified_folds(df, id_col, label))
    return (
        folded.filter("fold <> 0").drop("fold"),
        folded.filter("fold = 0").drop("fold"),
    )


@register(
    "c2_stratified_folds",
    """
    with classes as (select quality, count(*) as n, min(doc_id) as first from labels group by all),
    started as (select quality, n,
                       coalesce(sum(n) over (order by first rows between unbounded preceding
                                and 1 preceding), 0)::bigint as start from classes),
    dealt as (select quality, unnest(generate_series(start, start + n - 1)) % 5 as fold
              from started),
    runs as (select quality, fold, sum(count(*)) over (partition by quality order by fold) as upto
             from dealt group by quality, fold),
    placed as (select doc_id, quality,
                      row_number() over (partition by quality order by doc_id) as place
               from labels)
    select doc_id, quality,
           (select count(*) from runs r
            where r.quality = p.quality and r.upto < p.place)::int as fold
    from placed p""",
)
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return classification.stratified_folds(labels, "doc_id", "quality")


WIDTH = 64
COMPONENTS = [f"e{i}" for i in range(WIDTH)]


def wide_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component of a vector as a column."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(COMPONENTS)],
    )


# The vectors with their stratified fold.
FOLDED = """
classes as (select label, count(*) as n, min(vec_id) as first from embeddings group by all),
started as (select label, n,
                   coalesce(sum(n) over (order by first rows between unbounded preceding
                            and 1 preceding), 0)::bigint as start from classes),
dealt as (select label, unnest(generate_series(start, start + n - 1)) % 5 as fold from started),
runs as (select label, fold, sum(count(*)) over (partition by label order by fold) as upto
         from dealt group by label, fold),
placed as (select vec_id, label, embedding::double[] as x,
                  row_number() over (partition by label order by vec_id) as place
           from embeddings),
folded as (select vec_id, label, x,
                  (select count(*) from runs r
                   where r.label = p.label and r.upto < p.place)::int as fold
           from placed p)
"""


@register(
    "c2_neighbour_search",
    f"""
    with {FOLDED},
    near as (select a.vec_id, a.fold, a.label, b.label as vote,
                    row_number() over (partition by a.vec_id order by
                      list_distance(a.x, b.x), b.vec_id) as place
             from folded a join folded b on a.fold <> b.fold),
    votes as (select fold, vec_id, k, label, vote, count(*) as n
              from near join (select unnest(generate_series(2, 9))::int as k) on place <= k
              group by all),
    made as (select fold, k, label, vote from votes
             qualify row_number() over (partition by vec_id, k order by n desc, vote) = 1),
    scores as (select fold, k, avg((label = vote)::int) as score from made group by all)
    select (k - 1)::int as candidate, 'knn' as model, k::varchar as n_neighbors,
           round(avg(score), 10) as score
    from scores group by k""",
)
def neighbour_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search for the number of neighbours, over five folds."""
    found = classification.grid_search(
        "knn",
        sweep.candidates({"n_neighbors": [2, 10, 1]}),
        wide_vectors(spark, sf_dir),
        COMPONENTS,
        "label",
        "vec_id",
    )
    return sweep.search_table(spark, [("knn", p, s) for p, s in found]).select(
        "candidate",
        "model",
        F.col("params")["n_neighbors"].alias("n_neighbors"),
        F.round("score", 10).alias("score"),
    )


@register("c2_grid_search")
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = settle(labelled_documents(spark, sf_dir))
    found = classification.grid_search(
        "logistic",
        sweep.candidates(sweep.CLASSIFIER_GRIDS["logistic"]),
        docs,
        TEXT_FEATURES,
        "quality",
        "doc_id",
    )
    return sweep.search_table(spark, [("logistic", p, s) for p, s in found])


def predicted(spark: SparkSession, sf_dir: str, model: str, params: dict) -> DataFrame:
    train, test = split(wide_vectors(spark, sf_dir), "vec_id", "label")
    made = classification.predict(model, params, train, test, COMPONENTS, "label", "vec_id")
    return made.select("vec_id", "label", "prediction")


@register("c3_random_forest")
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(spark, sf_dir, "random_forest", {"n_estimators": 5, "max_depth": 5})


NEIGHBOUR_VOTES = """
with near as (select a.vec_id, b.vec_id as other, b.label,
                     row_number() over (partition by a.vec_id order by
                       list_distance(a.embedding::double[], b.embedding::double[]),
                       b.vec_id) as place
              from embeddings a join embeddings b on a.vec_id <> b.vec_id),
votes as (select vec_id, k, label, count(*) as n
          from near join (select unnest(generate_series(2, 9))::int as k) on place <= k
          group by all)
select vec_id, k, label as prediction from votes
qualify row_number() over (partition by vec_id, k order by n desc, label) = 1
"""


@register("c4_neighbour_votes", NEIGHBOUR_VOTES)
def neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector is classified by its nearest other vectors, for all k."""
    points = wide_vectors(spark, sf_dir)
    lists = settle(
        neighbours.neighbour_lists(
            points, points, COMPONENTS, "label", 9, "vec_id", leave_out_self=True
        ).select("vec_id", "neighbours")
    )
    per_k = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"), neighbours.vote(F.col("neighbours"), k).alias("prediction")
            )
            for k in range(2, 10)
        ]
    )
    return lists.select("vec_id", F.inline(per_k))


@register("c5_logistic_regression")
def logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(spark, sf_dir, "logistic", {"C": 1})


@register(
    "c6_test_accuracy",
    f"""
    with {FOLDED},
    near as (select a.vec_id, a.label, b.label as vote,
                    row_number() over (partition by a.vec_id order by
                      list_distance(a.x, b.x), b.vec_id) as place
             from folded a join folded b on a.fold = 0 and b.fold <> 0),
    votes as (select vec_id, label, vote, count(*) as n from near where place <= 5 group by all),
    made as (select label, vote from votes
             qualify row_number() over (partition by vec_id order by n desc, vote) = 1)
    select round(avg((label = vote)::int), 10) as accuracy from made""",
)
def test_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = predicted(spark, sf_dir, "knn", {"n_neighbors": 5})
    made = cluster_metrics.accuracy(made, "label", "prediction")
    return made.select(F.round("accuracy", 10).alias("accuracy"))


@register("c7_classification_sweep")
def classification_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scalers, all 68 candidates, five folds."""
    train, test = split(settle(labelled_documents(spark, sf_dir)), "doc_id", "quality")
    trials = sweep.classification_sweep(
        train, test, TEXT_FEATURES, "quality", "doc_id"
    )
    return sweep.best_per_model(trials)


@register("c8_selected_models")
def selected_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalers and models picked by name, chained as the sweep allows."""
    train, test = split(settle(labelled_documents(spark, sf_dir)), "doc_id", "quality")
    names = list(sweep.selected(["min_max", "max_abs"], sweep.scalers.SCALERS))
    trials = sweep.classification_sweep(
        train,
        test,
        TEXT_FEATURES,
        "quality",
        "doc_id",
        names,
        sweep.selected(["knn", "logistic"], sweep.CLASSIFIER_GRIDS),
        chain=True,
        fit_each=True,
    )
    return sweep.best_trial(trials)
