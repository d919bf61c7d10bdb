"""Exact duplicates by MSD radix partitioning over the bytes of the texts.

A group of texts that agree so far is split by its next digit, a run of
successive bytes. Texts alone in their group leave at once; texts whose last
byte has been compared are equal. Bytes are compared, never a digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.session import settle

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bytes in the first digit; every further digit is 16 times as wide, up to the last value.
FIRST_DIGIT, WIDER, WIDEST = 32, 16, 1 << 17

#: Upper bound of the digits that are broadcast for hot groups.
HOT_BYTES = 32 * 1024 * 1024


def normalised(text: str | Column) -> Column:
    """Text with A-Z lower-cased and nothing else; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def split_join(rows: DataFrame, groups: DataFrame, keys: list[str], total: int, width: int) -> DataFrame:
    """Left join of rows with the groups of two or more.

    At most ``HOT_BYTES / width`` groups can hold more than the share ``limit /
    total``, so those are broadcast and their rows meet in no task. All others
    are joined by a shuffle at every size, so cost follows the input; adaptive
    execution splits its large partitions.
    """
    limit = max(1_000, total * width // HOT_BYTES)
    hot = groups.filter(F.col("_n") > limit)
    if hot.isEmpty():
        return rows.join(groups.hint("merge"), keys, "left")
    marked = rows.join(F.broadcast(hot), keys, "left")
    rest = marked.filter(F.col("_n").isNull()).select(*rows.columns)
    return marked.filter(F.col("_n").isNotNull()).unionByName(
        rest.join(groups.filter(F.col("_n") <= limit).hint("merge"), keys, "left")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<row, keep_id, group_size>``: every input row as the struct ``row``,
    the largest id among the rows of equal text, and their number.

    Texts are equal when identical after lower-casing A-Z; a null text is
    empty. Ids may repeat or be null (a group of null ids keeps null). The
    columns of the input stay inside the struct and can have any name. An
    empty table gives no rows.
    """
    text = F.col(f"_row.`{text_col}`")
    digits = normalised(text).cast("binary")
    rows = docs.select(F.struct("*").alias("_row")).withColumns(
        {"_id": F.col(f"_row.`{id_col}`"), "_group": F.lit(0).cast("long")}
    )
    total = rows.count()
    at, width, done = 0, FIRST_DIGIT, []
    while True:
        # The number of bytes is digit zero, so all texts of a group end together.
        rows = rows.withColumns(
            {"_bytes": F.octet_length(digits), "_digit": F.substring(digits, at + 1, width)}
        )
        keys = ["_group", "_bytes", "_digit"]
        groups = settle(
            rows.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_keep"))
            .filter(F.col("_n") > 1)
            .withColumn("_next", F.monotonically_increasing_id())
        )
        placed = settle(
            split_join(rows, groups, keys, total, width).select(
                "_row", "_id", "_bytes", "_n", "_keep", "_next"
            )
        )
        at += width
        ended = F.col("_n").isNull() | (F.col("_bytes") <= at)
        done.append(
            placed.filter(ended).select(
                F.col("_row").alias("row"),
                F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
                F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
            )
        )
        rows = placed.filter(~ended).select("_row", "_id", F.col("_next").alias("_group"))
        total = rows.count()
        if not total:
            break
        width = min(width * WIDER, WIDEST)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input without all but one row of equal texts: the one with the
    largest id stays (one of them where that id repeats; null ids are smallest)."""
    found = exact_duplicates(docs, id_col, text_col)
    row_id = F.col(f"row.`{id_col}`")
    alone = found.filter(F.col("group_size") == 1).select("row.*")
    # Of rows with the kept id, any one: their normalised texts are equal.
    twins = (
        found.filter((F.col("group_size") > 1) & row_id.eqNullSafe(F.col("keep_id")))
        .withColumns({"_i": row_id, "_t": normalised(F.col(f"row.`{text_col}`"))})
        .groupBy("_i", "_t")
        .agg(F.min_by("row", F.to_json("row")).alias("row"))
        .select("row.*")
    )
    return alone.unionByName(twins)
