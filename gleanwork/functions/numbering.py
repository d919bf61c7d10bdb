"""Row numbers over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanwork.session import settle


def numbered(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add the 1-based position of each row in its group.

    ``order_by`` has to be a total order.
    """
    return running_total(df, order_by, F.lit(1), name, partition_by)


def running_total(
    df: DataFrame,
    order_by: Sequence[Column],
    value: Column,
    name: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add the sum of ``value`` over the rows up to each row of its group.

    A plain window sorts a whole group in one task. Here the rows are
    range-partitioned on (group, order), so a large group is cut into many
    ranges; sums are taken inside each range and shifted by the totals of the
    ranges before it.
    """
    groups = list(partition_by)
    ranged = df.withColumn("_value", value).repartitionByRange(*groups, *order_by)
    placed = settle(ranged.withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range", *groups).agg(F.sum("_value").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = sizes.select(
        "_range", *groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    inside = Window.partitionBy("_range", *groups).orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        placed.withColumn("_inside", F.sum("_value").over(inside))
        .join(shifts, ["_range", *groups])
        .withColumn(name, F.col("_shift") + F.col("_inside"))
        .drop("_range", "_inside", "_shift", "_value")
    )
