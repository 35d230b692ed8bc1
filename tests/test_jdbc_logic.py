"""JDBC reader logic without a database: a stub records what would be read.

No database is started anywhere in this suite; these tests check only how the
reader turns MIN/MAX bounds into a partitioned read.
"""

from __future__ import annotations

from types import SimpleNamespace

from tallyframe.sources.jdbc import read_jdbc


class _Reader:
    def __init__(self, bounds):
        self.bounds = bounds
        self.calls = []

    def jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None, properties=None):
        self.calls.append(dict(table=table, column=column, lower=lowerBound, upper=upperBound, n=numPartitions))
        if table.startswith("(SELECT MIN("):
            lo, hi = self.bounds
            row = None if lo is None else {"lo": lo, "hi": hi}
            return SimpleNamespace(first=lambda: row)
        return "frame"


def _spark(bounds):
    return SimpleNamespace(read=_Reader(bounds))


def test_partitioned_read_uses_min_max_bounds():
    spark = _spark((10, 1009))
    assert read_jdbc(spark, "jdbc:x", "orders", {"user": "u"}, "order_id", 4) == "frame"
    bounds_query, read = spark.read.calls
    assert "MIN(order_id)" in bounds_query["table"] and "FROM orders" in bounds_query["table"]
    assert read == dict(table="orders", column="order_id", lower=10, upper=1010, n=4)


def test_few_distinct_values_cap_the_partitions():
    spark = _spark((5, 6))
    read_jdbc(spark, "jdbc:x", "orders", {}, "order_id", 8)
    assert spark.read.calls[-1]["n"] == 2


def test_empty_table_and_unpartitioned_reads_use_one_connection():
    spark = _spark((None, None))
    read_jdbc(spark, "jdbc:x", "orders", {}, "order_id", 8)
    assert spark.read.calls[-1]["column"] is None
    spark = _spark((1, 2))
    read_jdbc(spark, "jdbc:x", "orders", {})
    assert len(spark.read.calls) == 1 and spark.read.calls[0]["column"] is None
