"""Ranked retrieval from two text tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.joins import fits_broadcast
from gleanwork.functions.text import STOP_WORDS
from gleanwork.operators import ranking, terms
from gleanwork.session import settle, spread


def scored_pairs(
    docs: DataFrame, queries: DataFrame, stop_words: Iterable[str] = STOP_WORDS
) -> DataFrame:
    """``<query_id, doc_id, score>`` from ``<doc_id, text>`` and ``<query_id, text>``.

    ``doc_id`` and ``query_id`` have to be unique.
    """
    words = list(stop_words)
    query_counts = terms.query_term_counts(queries, "query_id", "text", words)
    query_idf = terms.inverse_frequencies(query_counts, queries, "qtf")
    weights = settle(ranking.query_weights(query_counts, query_idf))
    small = fits_broadcast(weights)

    # Written once: read for the document frequencies and for the scores.
    doc_counts = settle(
        ranking.restrict_to_vocabulary(
            terms.term_counts(spread(docs), "doc_id", "text", words), weights, small
        )
    )
    doc_idf = settle(terms.inverse_frequencies(doc_counts, docs))
    tasks = ranking.score_tasks(doc_idf, weights)
    return ranking.cosine_scores(doc_counts, doc_idf, weights, small, tasks)


def ranked_run(
    docs: DataFrame,
    queries: DataFrame,
    k: int | None = None,
    above: float | None = None,
    stop_words: Iterable[str] = STOP_WORDS,
) -> DataFrame:
    """Ranked run of all queries; all ranks, or the first ``k``."""
    scores = scored_pairs(docs, queries, stop_words)
    if k is not None:
        return ranking.top_k(scores, k, above)
    if above is not None:
        scores = scores.filter(F.col("score") > F.lit(float(above)))
    return ranking.ranked(scores)
