"""From documents to packed training sequences, in five stages.

Quality rules, exact dedup, SimHash near-dedup and substring dedup return
documents; packing returns the pieces of the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm import exact, packing, quality, simhash, substring
from gleanwork.llm.queries import tokenizer
from gleanwork.session import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.quality(docs).filter("kept").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; other texts stay as they are."""
    found = substring.repeated_passages(docs, span=13)
    cut = F.size("spans") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("row.text"))
    chars = F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    changed = {"text": text, "n_chars": chars}
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, as pieces with their ids."""
    pieces = packing.token_pieces(docs, tokenizer(), capacity=1024)
    return packing.pack(pieces.drop("row"), 1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("packing", pack_sequences),
]

#: Neither the fingerprints nor the token ids can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
