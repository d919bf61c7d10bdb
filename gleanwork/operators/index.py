"""Inverted index and word search.

Postings are cut into blocks by document number: one row per (term, block)
holding the sorted document numbers of that block. A term that occurs in a
third of all documents then fills many bounded rows instead of one huge one,
and searches intersect block by block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.text import starts_with_letter

BLOCK_SIZE = 65_536


def inverted_index(
    counts: DataFrame, id_col: str = "doc_id", block_size: int = BLOCK_SIZE
) -> DataFrame:
    """``<term, block, doc_ids>`` with ascending distinct document numbers (A-6)."""
    return (
        counts.filter(F.col("tf") > 0)
        .groupBy("term", F.floor(F.col(id_col) / F.lit(block_size)).alias("block"))
        .agg(F.sort_array(F.collect_set(id_col)).alias("doc_ids"))
    )


def letter_terms(index: DataFrame) -> DataFrame:
    """The index without the terms that sort before the letters (T-7)."""
    return index.filter(starts_with_letter(F.col("term")))


def sorted_vocabulary(index: DataFrame) -> DataFrame:
    """Distinct terms in code-point order (W-10)."""
    return index.select("term").distinct().orderBy("term")


def term_lookup(index: DataFrame, term: str) -> DataFrame:
    """Postings of one term, case-sensitive (J-4); the filter reaches the scan."""
    return index.filter(F.col("term") == term)


def documents_with_all(index: DataFrame, words: Sequence[str]) -> DataFrame:
    """Documents that hold every word, ascending (J-5, W-13).

    Words from the first unknown one on are ignored; when the first word is
    unknown nothing matches.
    """
    wanted = list(dict.fromkeys(words))
    known = {
        row["term"]
        for row in index.filter(F.col("term").isin(wanted)).select("term").distinct().collect()
    }
    used = []
    for word in wanted:
        if word not in known:
            break
        used.append(word)
    postings = index.filter(F.col("term").isin(used) if used else F.lit(False))
    # At most one row per word and block, so each group is bounded.
    per_block = postings.groupBy("block").agg(F.collect_list("doc_ids").alias("lists"))
    full = per_block.filter(F.size("lists") == len(used))
    common = F.aggregate(
        "lists", F.get("lists", F.lit(0)), lambda acc, ids: F.array_intersect(acc, ids)
    )
    return full.select(F.explode(common).alias("doc_id")).orderBy("doc_id")
