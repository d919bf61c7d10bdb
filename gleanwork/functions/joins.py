"""Join helpers that stay safe when one key holds much of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` as text and compare it with the limit."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()["b"]
    return (size or 0) <= max_bytes


def term_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: str,
    broadcast_small: bool,
    salts: int = 64,
) -> DataFrame:
    """Inner equi join on ``key`` where ``large`` may be skewed on it.

    The caller says whether the measured size of ``small`` allows a broadcast.
    Otherwise both sides are shuffled on ``(key, salt)``: rows of ``large``
    take the salt from ``spread_by``, rows of ``small`` are repeated once per
    salt, so a hot key is spread over ``salts`` tasks.
    """
    if broadcast_small:
        return large.join(F.broadcast(small), key)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    repeated = small.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return salted.join(repeated, [key, "_salt"]).drop("_salt")


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast where the measured size allows it."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def attach(
    large: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    size: str,
    total: int | None = None,
    hot_rows: int = 100_000,
) -> DataFrame:
    """Inner join of rows with one row per group, where ``size`` is the number
    of rows of ``large`` in the group and ``total`` the number of all rows.

    At most 10 000 groups can hold more than a ten-thousandth of all rows, so
    the groups above that share are broadcast; their rows never meet in one
    task. The other groups are joined by a shuffle.
    """
    if total is None:
        total = groups.agg(F.sum(size).alias("n")).first()["n"] or 0
    limit = max(hot_rows, total // 10_000)
    if total <= limit:
        return large.join(groups, keys)
    hot = groups.filter(F.col(size) > limit)
    cold = large.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return large.join(F.broadcast(hot), keys).unionByName(
        cold.join(groups.filter(F.col(size) <= limit), keys)
    )
