"""Parquet tables under a root folder, read with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.schemas import TABLES


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a data set root such as ``/data/sf0.1``.

    Works the same for one file or a folder of thousands of part files.  The
    schema is declared when known, so no footer has to be read for it; column
    pruning and filter pushdown into the scan are left to Catalyst.
    """
    reader = spark.read
    schema = TABLES.get(name)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(root, name))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet from any Hadoop file system URI (local, ``hdfs://``, ``s3a://``)."""
    return spark.read.parquet(path)
