"""Data-layout reports: rows per partition (skew check)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_distribution(df: DataFrame) -> DataFrame:
    """``partition_id``, ``count``: rows in each partition of ``df`` as planned.

    Each task counts its own rows (partial aggregation), so only one row per
    partition is shuffled.  Empty partitions do not appear.
    """
    return (
        df.select(F.spark_partition_id().alias("partition_id"))
        .groupBy("partition_id")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def distribution_summary(distribution: DataFrame) -> DataFrame:
    """One row: partitions, total rows, largest, smallest and the skew ratio."""
    return distribution.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("count").alias("total_rows"),
        F.max("count").alias("max_rows"),
        F.min("count").alias("min_rows"),
        (F.max("count") / F.avg("count")).alias("skew_ratio"),
    )
