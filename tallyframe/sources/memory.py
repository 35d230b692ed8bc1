"""Rows held by the driver, and row replication.

``rows_frame`` is for fixtures and tests only: anything large must come from a
distributed source.  ``replicate`` scales a data set up inside each task with a
generator (no join, no shuffle).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A small DataFrame from Python tuples with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def replicate(df: DataFrame, times: int, copy_column: str | None = None) -> DataFrame:
    """Every row ``times`` times (``times`` >= 0).

    The copies are produced by ``explode(sequence(1, times))`` in the same
    task as the row, so the plan stays a single narrow stage.  ``copy_column``
    keeps the copy number (1..times) if a name is given.
    """
    if times < 0:
        raise ValueError("times must be >= 0")
    name = copy_column or "__copy"
    if times == 0:
        out = df.where(F.lit(False)).withColumn(name, F.lit(1))
    else:
        out = df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(times))))
    return out if copy_column else out.drop(name)
