"""Tokens, term counts and inverse document frequencies."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions import text as tx


def sentence_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per sentence: id, sent_no, sentence (T-1)."""
    return docs.select(
        id_col, F.posexplode(tx.sentences(F.col(text_col))).alias("sent_no", "sentence")
    )


def document_tokens(
    docs: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str] = tx.STOP_WORDS
) -> DataFrame:
    """Kept tokens with sentence number and position in the sentence (T-5)."""
    words = list(stop_words)
    return sentence_rows(docs, id_col, text_col).select(
        id_col,
        "sent_no",
        F.posexplode(tx.content_tokens(F.col("sentence"), words)).alias("pos", "token"),
    )


def query_tokens(
    queries: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str] = tx.STOP_WORDS
) -> DataFrame:
    """Kept tokens in text order, repeats included (T-6)."""
    return queries.select(
        id_col,
        F.posexplode(tx.content_tokens(F.col(text_col), stop_words)).alias("pos", "token"),
    )


def term_counts(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    stop_words: Iterable[str] = tx.STOP_WORDS,
    lowercase: bool = False,
) -> DataFrame:
    """``<id, term, tf>`` without a shuffle (A-1); one input row per document.

    Sentences need no splitting here: a token never crosses white space.
    """
    counts = tx.token_counts(tx.content_tokens(F.col(text_col), stop_words, lowercase))
    return docs.select(id_col, F.inline(counts))


def query_term_counts(
    queries: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str] = tx.STOP_WORDS
) -> DataFrame:
    """``<id, term, qtf double>`` (A-2)."""
    counts = term_counts(queries, id_col, text_col, stop_words)
    return counts.select(id_col, "term", F.col("tf").cast("double").alias("qtf"))


def term_maps(
    docs: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str] = tx.STOP_WORDS
) -> DataFrame:
    """One ``map<term, tf>`` per document (A-3), built inside its row."""
    counts = tx.token_counts(tx.content_tokens(F.col(text_col), stop_words))
    return docs.select(id_col, F.map_from_entries(counts).alias("terms"))


def collection_size(docs: DataFrame) -> DataFrame:
    """One row ``<n>``; documents without tokens count as well (A-4)."""
    return docs.agg(F.count(F.lit(1)).alias("n"))


def inverse_frequencies(counts: DataFrame, collection: DataFrame, tf_col: str = "tf") -> DataFrame:
    """``<term, df, idf>`` with ``idf = ln(N / df)`` and no smoothing (A-5)."""
    n = collection_size(collection).scalar()
    frequencies = counts.groupBy("term").agg(F.count_if(F.col(tf_col) > 0).alias("df"))
    return frequencies.withColumn("idf", F.log(n / F.col("df")))
