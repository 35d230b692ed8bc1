"""Joins of tables that are stored bucketed and sorted by the join key.

Written once with equal bucket counts, two tables are joined bucket by bucket:
neither side is shuffled, whatever its size, and an aggregation by the key reads
its groups where they lie.  The price is paid at the write: one shuffle into as
many tasks as buckets, so each bucket is one sorted file.

The tables are external: their files lie under the given path and stay when the
name is dropped.  The name is in the catalog only while the frame is resolved.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` files sorted by ``key``; returns the stored table.

    Rows with a null key form a bucket's rows like any other and are kept.  A
    key that holds very many rows makes its bucket large: such a table is
    better aggregated than bucketed.
    """
    spark = df.sparkSession
    name = f"tallyframe_bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return _resolved(spark, name)


def _resolved(spark: SparkSession, name: str) -> DataFrame:
    table = spark.table(name)
    table.schema  # noqa: B018  resolves the plan, which then knows files and buckets itself
    spark.sql(f"DROP TABLE {name}")
    return table
