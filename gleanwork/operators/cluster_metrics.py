"""Counts and scores of a labelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_sizes(df: DataFrame, column: str) -> DataFrame:
    """Rows per cluster or per class (A-14)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def contingency(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Rows per (class, cluster) (A-15)."""
    return df.groupBy(label, cluster).agg(F.count(F.lit(1)).alias("n"))


def purity(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Share of rows in the largest class of their cluster (A-16)."""
    largest = contingency(df, label, cluster).groupBy(cluster).agg(
        F.max("n").alias("largest"), F.sum("n").alias("n")
    )
    return largest.agg((F.sum("largest") / F.sum("n")).alias("purity"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of equal label and prediction (A-17)."""
    equal = F.coalesce(F.col(label) == F.col(prediction), F.lit(False))
    return df.agg(F.avg(equal.cast("double")).alias("accuracy"))


def cluster_count(df: DataFrame, cluster: str, noise: int = -1) -> DataFrame:
    """Number of clusters without the noise label (A-18)."""
    return df.agg(
        F.count_distinct(F.when(F.col(cluster) != noise, F.col(cluster))).alias("clusters")
    )


def labelled_points(
    df: DataFrame, columns: Sequence[str], cluster: str, label: str
) -> DataFrame:
    """Cluster, class and coordinates, the data of a scatter plot (K-14)."""
    return df.select(cluster, label, *columns)
