"""Bucketed tables: equal answers, and no exchange at all in the join."""

from __future__ import annotations

from tallyframe.operators.bucketing import write_bucketed
from tallyframe.plans import reports
from tallyframe.plans.inspect import plan_text
from tallyframe.plans.roundtrips import bucketed_sales
from tallyframe.sources.tables import read_table
from tests.conftest import SF_SMALL, rows
from tests.test_plans import conf


def test_bucketed_join_is_a_sort_merge_join_without_exchange(spark):
    with conf(spark, spark__sql__adaptive__enabled="false"):
        joined = bucketed_sales(spark, SF_SMALL, buckets=4)
        plan = plan_text(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert plan.count("SelectedBucketsCount: 4 out of 4") == 2 or plan.count("Bucketed: true") == 2
    want = reports.customer_sales_report(read_table(spark, SF_SMALL, "orders"), read_table(spark, SF_SMALL, "customer"))
    assert rows(joined) == rows(want)


def test_one_file_a_bucket_and_null_keys_stay(spark, scratch):
    df = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(200)], "k int, v int")
    path = scratch("bucketed")
    table = write_bucketed(df, path, "k", 3)
    assert rows(table) == rows(df)
    assert len(table.inputFiles()) <= 3
    assert rows(spark.read.parquet(path)) == rows(df)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("tallyframe_bucketed")] == []
