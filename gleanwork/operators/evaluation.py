"""Precision and recall of ranked runs against relevance judgments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanwork.functions.joins import bounded_broadcast
from gleanwork.operators.ranking import top_k
from gleanwork.session import settle

# --- fixed values -----------------------------------------------------------
# Recall steps as doubles that were reached by adding 0.1 again and again. The
# comparison with them is strict, so their last bits matter.
MILESTONES = [
    0.1,
    0.2,
    0.30000000000000004,
    0.4,
    0.5,
    0.6,
    0.7,
    0.7999999999999999,
    0.8999999999999999,
    0.9999999999999999,
]
# ----------------------------------------------------------------------------

PAIR = ["query_id", "doc_id"]


def within_corpus(judgments: DataFrame, documents: DataFrame | int) -> DataFrame:
    """Judgments of known documents (T-14): number up to a total, or present
    in a table of documents."""
    if isinstance(documents, int):
        return judgments.filter(F.col("doc_id") <= documents)
    return judgments.join(documents.select("doc_id"), "doc_id", "left_semi")


def distinct_judgments(judgments: DataFrame) -> DataFrame:
    """One row per judged pair; the code plays no part in the scoring (J-6)."""
    return judgments.select(*PAIR).distinct()


def distinct_run(run: DataFrame) -> DataFrame:
    """One row per pair, the best score of repeated ones (J-6)."""
    return run.groupBy(*PAIR).agg(F.max("score").alias("score"))


def relevant_counts(judgments: DataFrame) -> DataFrame:
    """``<query_id, n_relevant>``."""
    return distinct_judgments(judgments).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_relevant")
    )


def marked_hits(run: DataFrame, judgments: DataFrame) -> DataFrame:
    """Run rows of judged queries with ``hit`` 0/1 and ``n_relevant`` (J-7);
    rows of unjudged queries are dropped (J-8)."""
    return _marked(run, settle(distinct_judgments(judgments)))


def _marked(run: DataFrame, judged: DataFrame) -> DataFrame:
    """``judged`` holds distinct judgments, written once."""
    counts = judged.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    return (
        run.join(bounded_broadcast(counts), "query_id")
        .join(judged.withColumn("_hit", F.lit(1)), PAIR, "left")
        .withColumn("hit", F.coalesce("_hit", F.lit(0)))
        .drop("_hit")
    )


def unanswered(judgments: DataFrame, run: DataFrame) -> DataFrame:
    """Judged queries without a response; their recall is 0 (J-8)."""
    return judgments.select("query_id").distinct().join(
        run.select("query_id").distinct(), "query_id", "left_anti"
    )


def _crossed(hits: Column, n_relevant: Column) -> Column:
    """Milestones m with recall before the hit <= m < recall at the hit (W-4)."""
    before = (hits - 1) / n_relevant
    at = hits / n_relevant
    steps = F.array(*[F.lit(m) for m in MILESTONES])
    return F.size(F.filter(steps, lambda m: (m >= before) & (m < at)))


def running_scores(run: DataFrame, judgments: DataFrame) -> DataFrame:
    """Hits, precision, recall and crossed milestones at every rank (W-3, W-4).

    ``run`` carries ``rank`` and is cut to some depth, so a query's window is
    bounded. A cut at a smaller depth or a higher threshold keeps a prefix of
    each query, hence these values hold for all such cuts.
    """
    return _running(run, settle(distinct_judgments(judgments)))


def _running(run: DataFrame, judged: DataFrame) -> DataFrame:
    upto = Window.partitionBy("query_id").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = _marked(run, judged).withColumn("hits", F.sum("hit").over(upto))
    return counted.select(
        "query_id",
        "doc_id",
        "score",
        "rank",
        "hit",
        "hits",
        "n_relevant",
        (F.col("hits") / F.col("rank")).alias("precision"),
        (F.col("hits") / F.col("n_relevant")).alias("recall"),
        F.when(F.col("hit") == 1, _crossed(F.col("hits"), F.col("n_relevant")))
        .otherwise(0)
        .alias("crossed"),
    )


def query_scores(running: DataFrame, by: Sequence[str] = ("query_id",)) -> DataFrame:
    """Average precision over milestones and recorded recall (W-5, W-6).

    The precision is NULL where no milestone is crossed.
    """
    crossed = F.sum("crossed")
    return running.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("precision") * F.col("crossed")), crossed).alias(
            "average_precision"
        ),
        (
            F.coalesce(F.sum(F.when(F.col("rank") <= F.col("n_relevant"), F.col("hit"))), F.lit(0))
            / F.max("n_relevant")
        ).alias("recorded_recall"),
    )


def without_precision(scores: DataFrame) -> DataFrame:
    """Answered queries with no recorded precision (J-9)."""
    return scores.filter(F.col("average_precision").isNull()).select("query_id")


def _means(scores: DataFrame, judged: Column, by: Sequence[str]) -> DataFrame:
    """Means over queries (W-7). The precision is averaged over queries that
    have one; the recall over those plus the unanswered queries, which add 0."""
    scored = F.col("average_precision").isNotNull()
    totals = scores.groupBy(*by).agg(
        F.avg("average_precision").alias("mean_average_precision"),
        F.sum(F.when(scored, F.col("recorded_recall"))).alias("_recall"),
        F.count_if(scored).alias("_scored"),
        F.count(F.lit(1)).alias("_answered"),
    )
    return totals.select(
        *by,
        "mean_average_precision",
        F.try_divide(
            F.coalesce("_recall", F.lit(0.0)), F.col("_scored") + judged - F.col("_answered")
        ).alias("mean_recall"),
    )


def _upto(df: DataFrame, last_query: int | None) -> DataFrame:
    return df if last_query is None else df.filter(F.col("query_id") <= last_query)


def sweep(
    scores: DataFrame,
    judgments: DataFrame,
    thresholds: Sequence[float],
    depths: Sequence[int],
    last_query: int | None = None,
    repeated: bool = False,
) -> DataFrame:
    """Means for every (threshold, depth) in one job (W-8, W-9).

    The run is cut once to the lowest threshold and the largest depth; running
    values are computed once and each setting sums a prefix of them.
    ``last_query`` leaves out the queries numbered above it; ``repeated`` tells
    that the run can list a pair more than once.
    """
    if repeated:
        scores = distinct_run(scores)
    judged_pairs = settle(distinct_judgments(_upto(judgments, last_query)))
    run = top_k(_upto(scores, last_query), max(depths), min(thresholds))
    settings = F.array(
        *[
            F.struct(F.lit(float(e)).alias("threshold"), F.lit(int(k)).alias("depth"))
            for e in thresholds
            for k in depths
        ]
    )
    running = _running(run, judged_pairs)
    per_setting = (
        running.withColumn("_s", F.explode(settings))
        .select("*", "_s.threshold", "_s.depth")
        .filter((F.col("score") > F.col("threshold")) & (F.col("rank") <= F.col("depth")))
    )
    by = ["threshold", "depth"]
    per_query = query_scores(per_setting, [*by, "query_id"])
    judged = judged_pairs.agg(F.count_distinct("query_id").alias("n")).scalar()
    means = _means(per_query, judged, by)
    # Settings that no run row reaches are still reported.
    rows = [(float(e), int(k)) for e in thresholds for k in depths]
    grid = scores.sparkSession.createDataFrame(rows, "threshold double, depth int")
    reached = means.withColumn("_reached", F.lit(True))
    unreached = F.col("_reached").isNull() & (judged > 0)
    return (
        grid.join(F.broadcast(reached), by, "left")
        .withColumn("mean_recall", F.when(unreached, 0.0).otherwise(F.col("mean_recall")))
        .drop("_reached")
    )


def evaluate(
    scores: DataFrame,
    judgments: DataFrame,
    depth: int,
    threshold: float,
    last_query: int | None = None,
) -> DataFrame:
    """Both means for one depth and threshold (W-8)."""
    return sweep(scores, judgments, [threshold], [depth], last_query)


def best_setting(means: DataFrame) -> DataFrame:
    """The setting with the highest mean average precision, first on ties (W-9)."""
    return means.orderBy(F.desc_nulls_last("mean_average_precision"), "threshold", "depth").limit(1)
