"""Plan shape: pushdown, pruning, partial aggregation, join strategy, top-n."""

from __future__ import annotations

import contextlib

import pytest

from tallyframe.plans import reports
from tallyframe.plans.inspect import plan_text
from tallyframe.sources.memory import replicate
from tallyframe.sources.tables import read_table
from tests.conftest import SF_SMALL


@contextlib.contextmanager
def conf(spark, **settings):
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


STATIC = {"spark__sql__adaptive__enabled": "false"}


@pytest.fixture()
def orders(spark):
    return read_table(spark, SF_SMALL, "orders")


def test_filter_pushed_and_columns_pruned(spark, orders):
    plan = plan_text(reports.high_value_orders(orders))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual(o_totalprice,300000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_group_by_is_partial_then_final(spark, orders):
    with conf(spark, **STATIC):
        plan = plan_text(reports.total_sales_by_customer(orders))
    assert "partial_sum" in plan
    assert plan.count("HashAggregate") >= 2
    assert "hashpartitioning(o_custkey" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan


def test_checked_broadcast_join_when_small(spark):
    li, part = read_table(spark, SF_SMALL, "lineitem"), read_table(spark, SF_SMALL, "part")
    with conf(spark, **STATIC, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_text(reports.revenue_by_brand(li, part))
    assert "BroadcastHashJoin" in plan
    # lineitem is not shuffled: the only hash exchange is on the brand
    assert "hashpartitioning(l_partkey" not in plan


def test_large_dimension_pre_aggregates_then_shuffle_joins(spark):
    li, part = read_table(spark, SF_SMALL, "lineitem"), read_table(spark, SF_SMALL, "part")
    with conf(spark, **STATIC, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_text(reports.revenue_by_brand(li, part, max_broadcast_rows=0))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    tree = plan.split("\n\n")[0]
    # a partial + final aggregate on the part key sits below the join
    join_at = tree.index("SortMergeJoin")
    assert tree.count("HashAggregate", join_at) >= 2


def test_aggregate_then_join_reuses_partitioning(spark, orders):
    customer = read_table(spark, SF_SMALL, "customer")
    with conf(spark, **STATIC, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_text(reports.customer_sales_report(orders, customer, max_broadcast_rows=0))
    tree = plan.split("\n\n")[0]
    # one exchange for the aggregate, one for the customer side: the join
    # reuses the aggregate's hash partitioning
    assert tree.count("Exchange") == 2


def test_preview_is_take_ordered(spark, orders):
    plan = plan_text(reports.preview_top_n(orders))
    assert "TakeOrderedAndProject" in plan


def test_replication_stays_in_one_stage(spark):
    customers = read_table(spark, SF_SMALL, "customer")
    plan = plan_text(replicate(customers, 5))
    assert "Generate" in plan and "Exchange" not in plan and "CartesianProduct" not in plan


def test_executed_adaptive_plan_after_action(spark, orders):
    df = reports.revenue_by_category(orders)
    df.collect()
    assert "isFinalPlan=true" in plan_text(df)


def test_aqe_coalesces_many_small_shuffle_partitions(spark, orders):
    with conf(spark, spark__sql__shuffle__partitions="200"):
        df = reports.total_sales_by_customer(orders)
        df.collect()
        plan = plan_text(df)
    assert "isFinalPlan=true" in plan
    assert "AQEShuffleRead" in plan and "coalesced" in plan


def test_broadcast_check_bounds_rows_and_bytes(spark):
    from tallyframe.operators.joins import fits_broadcast, row_bytes_bound

    nation = read_table(spark, SF_SMALL, "nation")
    names_bytes = sum(len(r["n_name"].encode()) + 8 for r in nation.collect())
    assert row_bytes_bound(nation, 25) == 25 * (8 + 3 * 8) + names_bytes
    assert row_bytes_bound(nation.select("n_nationkey"), 25) == 25 * 16
    assert fits_broadcast(nation)
    assert not fits_broadcast(nation, max_rows=24)
    assert not fits_broadcast(nation, max_bytes=100)
    nested = spark.createDataFrame([(1, [1, 2])], "k int, xs array<int>")
    assert not fits_broadcast(nested)  # size of nested values is not measured


def test_sorted_aggregate_is_materialized_before_the_range_exchange(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    tree = plan_text(reports.product_sales_metrics(li)).split("\n\n")[0]
    full = plan_text(reports.product_sales_metrics(li))
    assert tree.count("Exchange") == 3  # aggregate, rebalance, range
    assert "REBALANCE_PARTITIONS_BY_NONE" in full and "rangepartitioning(l_partkey" in full


def test_aqe_splits_a_hot_join_key(spark):
    """A raw sort-merge join where one key holds a third of the rows: AQE's skew join splits it."""
    from pyspark.sql import functions as F

    n = 600_000
    fact = spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 3000).alias("k"), F.col("id").alias("v"))
    dim = spark.range(0, 3000, 1, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
              spark__sql__shuffle__partitions="8",
              spark__sql__adaptive__coalescePartitions__enabled="false",
              spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
              spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10240",
              spark__sql__adaptive__advisoryPartitionSizeInBytes="65536"):
        joined = fact.join(dim, "k").groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"))
        got = joined.collect()[0]
        plan = plan_text(joined)
    assert "SortMergeJoin(skew=true)" in plan
    expected_w = sum(2 * (7 if i % 3 == 0 else i % 3000) for i in range(n))
    assert (got["n"], got["w"]) == (n, expected_w)
