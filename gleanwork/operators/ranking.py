"""TF-IDF cosine of many queries against a collection, and ranked runs.

The document vector is restricted to the tokens of the query, each token
counted as often as the query repeats it, and queries carry the idf of their
own collection:

    dot  = sum qtf * (qtf * qidf) * (tf * didf)
    n1   = sqrt(sum qtf * (qtf * qidf)^2)
    n2   = sqrt(sum qtf * (tf * didf)^2)
    score = dot / (n1 * n2), 0 when the denominator is 0
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanwork.functions.joins import attach, term_join
from gleanwork.functions.numbering import numbered
from gleanwork.functions.text import ratio_or_zero

# Sums arrive in any order, so scores are rounded before they are compared.
SCORE_PLACES = 12

#: Matches of a query term in a document that one task adds up. A task holds a
#: sum per (query, document) of them, about 200 bytes each.
TASK_MATCHES = 2_000_000


def query_weights(query_counts: DataFrame, query_idf: DataFrame) -> DataFrame:
    """``<query_id, term, qtf, qw, n1>``: weight per term, norm per query."""
    # Many queries can share a term; ``df`` says how many.
    weighted = attach(query_counts, query_idf, ["term"], "df").withColumn(
        "qw", F.col("qtf") * F.col("idf")
    )
    square = F.col("qtf") * F.pow("qw", F.lit(2.0))
    per_query = Window.partitionBy("query_id")
    return weighted.select(
        "query_id", "term", "qtf", "qw", F.sqrt(F.sum(square).over(per_query)).alias("n1")
    )


def token_weights(tokens: DataFrame, counts: DataFrame, idf: DataFrame) -> DataFrame:
    """tf, idf and tf*idf of each query token, 0 where it is unknown (J-1)."""
    # Many queries can share a term, so its rows are counted first.
    sizes = counts.groupBy("term").agg(F.count(F.lit(1)).alias("_rows"))
    groups = sizes.join(idf.select("term", "idf"), "term", "left")
    known = attach(counts, groups, ["term"], "_rows").drop("_rows")
    looked_up = tokens.join(
        known.withColumnRenamed("term", "token"), ["query_id", "token"], "left"
    )
    tf = F.coalesce(F.col("qtf"), F.lit(0.0))
    idf_value = F.coalesce(F.col("idf"), F.lit(0.0))
    return looked_up.select(
        "query_id",
        "pos",
        "token",
        tf.alias("tf"),
        idf_value.alias("idf"),
        (tf * idf_value).alias("weight"),
    )


def restrict_to_vocabulary(
    doc_counts: DataFrame, weights: DataFrame, broadcast_queries: bool
) -> DataFrame:
    """Document terms that some query uses."""
    vocabulary = weights.select("term").distinct()
    found = term_join(doc_counts, vocabulary, "term", "doc_id", broadcast_queries)
    return found.select(*doc_counts.columns)


def score_tasks(doc_idf: DataFrame, weights: DataFrame, matches: int = TASK_MATCHES) -> int:
    """Tasks that score at most about ``matches`` matches each.

    Few bytes of documents hold many matches when many queries share their
    terms, so the matches are counted; the size of a shuffle does not tell.
    """
    asking = weights.groupBy("term").agg(F.count(F.lit(1)).alias("_asking"))
    total = doc_idf.join(asking, "term").agg(F.sum(F.col("df") * F.col("_asking")).alias("n"))
    least = weights.sparkSession.sparkContext.defaultParallelism
    return max(least, -(-(total.first()["n"] or 0) // matches))


def cosine_scores(
    doc_counts: DataFrame,
    doc_idf: DataFrame,
    weights: DataFrame,
    broadcast_queries: bool,
    tasks: int | None = None,
) -> DataFrame:
    """``<query_id, doc_id, score>`` of every pair with a score above 0 (J-2, J-3).

    Pairs that share no weighted term have score 0 and are not listed.
    ``broadcast_queries`` tells that the measured size of ``weights`` allows a
    broadcast; what is broadcast has at most as many rows. The sums are dealt
    by document to ``tasks`` (see ``score_tasks``); what follows per (query,
    document) can stay in that layout.
    """
    by_document = ["doc_id"] if tasks is None else [tasks, "doc_id"]
    if broadcast_queries:
        # The rows of documents travel, not their matches.
        doc_counts = doc_counts.repartition(*by_document)
    idf = doc_idf.select("term", F.col("idf").alias("didf"))
    if broadcast_queries:
        known = idf.join(F.broadcast(weights), "term")
    else:
        # Many queries can share a term.
        sizes = weights.groupBy("term").agg(F.count(F.lit(1)).alias("_rows"))
        known = attach(weights, idf.join(sizes, "term"), ["term"], "_rows").drop("_rows")
    pairs = term_join(doc_counts, known, "term", "doc_id", broadcast_queries)
    if not broadcast_queries:
        pairs = pairs.repartition(*by_document)
    dw = F.col("tf") * F.col("didf")
    sums = pairs.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("qtf") * F.col("qw") * dw).alias("dot"),
        F.sum(F.col("qtf") * F.pow(dw, F.lit(2.0))).alias("sq"),
        F.max("n1").alias("n1"),
    )
    score = ratio_or_zero(F.col("dot"), F.col("n1") * F.sqrt("sq"))
    # Judged before rounding: a tiny score stays, rounded to 0.
    return sums.filter(score > 0).select(
        "query_id", "doc_id", F.round(score, SCORE_PLACES).alias("score")
    )


def _best_first() -> list:
    return [F.desc("score"), F.asc("doc_id")]


def ranked(scores: DataFrame) -> DataFrame:
    """Rank of every document of a query, ties by document number (W-1)."""
    return numbered(scores, _best_first(), "rank", ["query_id"])


def top_k(scores: DataFrame, k: int, above: float | None = None) -> DataFrame:
    """The first ``k`` documents per query with a score strictly above the
    threshold (T-13, W-2). Spark cuts each partition to k rows per query
    before the shuffle."""
    if k < 1:
        raise ValueError("k has to be at least 1")
    kept = scores if above is None else scores.filter(F.col("score") > F.lit(float(above)))
    window = Window.partitionBy("query_id").orderBy(*_best_first())
    return kept.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
