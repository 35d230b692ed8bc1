"""Relational tables over JDBC, read in parallel.

A plain JDBC read is one task on one connection.  Given a numeric column, the
read is split into ``num_partitions`` ranges between the column's minimum and
maximum, each range read by its own task.  The bounds come from a one-row
``MIN``/``MAX`` query pushed to the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str,
                properties: dict[str, str]) -> tuple[int, int] | None:
    """(min, max) of ``column``, or None for an empty table."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = spark.read.jdbc(url, query, properties=properties).first()
    if row is None or row["lo"] is None:
        return None
    return int(row["lo"]), int(row["hi"])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    num_partitions: int = 8,
) -> DataFrame:
    """A table or ``(subquery) alias``, range-partitioned when a column is given."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    bounds = jdbc_bounds(spark, url, table, partition_column, properties)
    if bounds is None:
        return spark.read.jdbc(url, table, properties=properties)
    lo, hi = bounds
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lo, upperBound=hi + 1,
        numPartitions=max(1, min(num_partitions, hi - lo + 1)), properties=properties,
    )
