"""Registered layout query: rows per real partition after a repartition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.heavy_keys import heavy_keys, partition_sketches, sketched_heavy_keys
from tallyframe.operators.layout import distribution_summary, partition_distribution
from tallyframe.sources.tables import read_table

# Fixed value: partitions the orders are dealt into.
CHECK_PARTITIONS = 8
# Fixed value: planned partitions of the line items, four of which stay empty.
PLANNED_PARTITIONS = 12
# Share of a partition's rows, in percent, from which a key is heavy.
HEAVY_PERCENT = 5


def q_partition_distribution(spark: SparkSession, root: str) -> DataFrame:
    """Orders repartitioned by customer, counted by the partition each row is in.

    Folded to one row: partitions that hold rows, all rows, and whether none of
    the planned partitions is empty (empty ones do not appear in the count).
    """
    orders = read_table(spark, root, "orders").select("o_custkey").repartition(CHECK_PARTITIONS, "o_custkey")
    summary = distribution_summary(partition_distribution(orders))
    return summary.select("partitions", "total_rows", (F.col("partitions") == CHECK_PARTITIONS).alias("none_empty"))


def _dealt_lines(spark: SparkSession, root: str) -> DataFrame:
    """Line items with two planted hot parts and a null one, dealt by part into the first 8 of 12 partitions."""
    order = F.col("l_orderkey")
    part = F.when(order % 3 == 0, 1).when(order % 3 == 1, F.when(order % 4 == 0, 10)).otherwise(F.col("l_partkey"))
    lines = read_table(spark, root, "lineitem").select(part.cast("bigint").alias("part"))
    place = F.coalesce(F.col("part") % CHECK_PARTITIONS, F.lit(3)).cast("int")
    return lines.repartitionById(PLANNED_PARTITIONS, place)


def q_partition_heavy_keys(spark: SparkSession, root: str) -> DataFrame:
    """The parts behind the heavy partitions, with exact rows; empty planned partitions are listed."""
    return heavy_keys(_dealt_lines(spark, root), ["part"], HEAVY_PERCENT, planned=PLANNED_PARTITIONS)


def q_sketched_heavy_keys(spark: SparkSession, root: str) -> DataFrame:
    """The sketches of all partitions merged: parts that hold a share of all line items, without a second pass."""
    return sketched_heavy_keys(partition_sketches(_dealt_lines(spark, root), ["part"], HEAVY_PERCENT), HEAVY_PERCENT).select("key")


QUERIES = {
    "partition_distribution": q_partition_distribution,
    "partition_heavy_keys": q_partition_heavy_keys,
    "sketched_heavy_keys": q_sketched_heavy_keys,
}

_DEALT_LINES = """
    SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 3 = 1 THEN CASE WHEN l_orderkey % 4 = 0 THEN 10 END
                ELSE l_partkey END AS part
    FROM lineitem
"""

ORACLE_SQL = {
    "partition_distribution": """
SELECT LEAST(8, COUNT(DISTINCT o_custkey)) AS partitions, COUNT(*) AS total_rows, COUNT(DISTINCT o_custkey) >= 8 AS none_empty FROM orders
""",
    "partition_heavy_keys": f"""
WITH lines AS ({_DEALT_LINES}),
per_key AS (SELECT COALESCE(part % 8, 3) AS partition_id, part, COUNT(*) AS key_rows FROM lines GROUP BY ALL),
sized AS (SELECT *, SUM(key_rows) OVER (PARTITION BY partition_id) AS n_rows FROM per_key),
heavy AS (SELECT * FROM sized WHERE key_rows * 100 >= n_rows * 5)
SELECT p.partition_id, CAST(COALESCE(MAX(s.n_rows) OVER (PARTITION BY p.partition_id), 0) AS BIGINT) AS n_rows,
       CASE WHEN h.partition_id IS NOT NULL THEN '{{"part":' || COALESCE(CAST(h.part AS VARCHAR), 'null') || '}}' END AS key, h.key_rows
FROM (SELECT CAST(range AS INTEGER) AS partition_id FROM range(12)) p
LEFT JOIN (SELECT DISTINCT partition_id, n_rows FROM sized) s ON s.partition_id = p.partition_id
LEFT JOIN heavy h ON h.partition_id = p.partition_id
""",
    "sketched_heavy_keys": f"""
WITH lines AS ({_DEALT_LINES})
SELECT '{{"part":' || COALESCE(CAST(part AS VARCHAR), 'null') || '}}' AS key
FROM lines GROUP BY part HAVING COUNT(*) * 100 >= 5 * (SELECT COUNT(*) FROM lines)
""",
}
