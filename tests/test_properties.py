"""Whole-table properties at sf0.01: parts add up to the whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import exact_sum
from tallyframe.operators.layout import distribution_summary, partition_distribution
from tallyframe.plans import reports
from tallyframe.sources.tables import read_table
from tests.conftest import SF_ORACLE


def test_group_sums_add_up_to_global_sum(spark):
    orders = read_table(spark, SF_ORACLE, "orders")
    whole = orders.agg(F.sum((F.col("o_totalprice") * 100).cast("decimal(20,0)")).alias("c")).first()["c"]
    parts = reports.total_sales_by_customer(orders).agg(
        F.sum((F.col("total_sales") * 100).cast("decimal(20,0)")).alias("c")).first()["c"]
    cats = reports.revenue_by_category(orders).agg(
        F.sum((F.col("total_revenue") * 100).cast("decimal(20,0)")).alias("c")).first()["c"]
    assert parts == whole == cats


def test_counts_add_up(spark):
    orders = read_table(spark, SF_ORACLE, "orders")
    by_cat = reports.revenue_by_category(orders).agg(F.sum("total_orders")).first()[0]
    assert by_cat == orders.where(F.col("o_orderkey").isNotNull()).count()
    completed = reports.completed_summary(orders).agg(F.sum("total_orders")).first()[0]
    assert completed == orders.where("o_orderstatus = 'F'").count()
    events = read_table(spark, SF_ORACLE, "events")
    purchases = reports.purchases_by_user(events).agg(F.sum("total_purchases")).first()[0]
    assert purchases == events.where("event_type = 'purchase' AND user_id IS NOT NULL").count()


def test_brand_rollup_adds_up_to_joined_lines(spark):
    li, part = read_table(spark, SF_ORACLE, "lineitem"), read_table(spark, SF_ORACLE, "part")
    total = reports.revenue_by_brand(li, part).agg(exact_sum("total_revenue")).first()[0]
    joined = li.join(part, li.l_partkey == part.p_partkey).agg(exact_sum("l_extendedprice")).first()[0]
    assert total == joined


def test_rows_per_partition_add_up_to_table(spark):
    orders = read_table(spark, SF_ORACLE, "orders")
    s = distribution_summary(partition_distribution(orders.repartition(16, "o_custkey"))).first()
    assert s["total_rows"] == orders.count() and s["partitions"] <= 16
