"""Every SQL-text report equals its DataFrame form on the sf0.01 tables."""

from __future__ import annotations

import pytest

from tallyframe.plans import reports
from tallyframe.plans.sql import REPORT_SQL, sql_report
from tallyframe.sources.tables import read_table
from tests.conftest import SF_ORACLE

FORMS = {
    "total_sales_by_customer": (["orders"], reports.total_sales_by_customer, False),
    "revenue_by_category": (["orders"], reports.revenue_by_category, True),
    "product_sales_metrics": (["lineitem"], reports.product_sales_metrics, True),
    "purchases_by_user": (["events"], reports.purchases_by_user, True),
    "completed_summary": (["orders"], reports.completed_summary, False),
    "customer_sales_report": (["orders", "customer"], reports.customer_sales_report, False),
    "revenue_by_brand": (["lineitem", "part"], reports.revenue_by_brand, False),
    "revenue_by_country": (["orders", "customer", "nation"], reports.revenue_by_country, True),
}
# SQL texts without a DataFrame twin: the same report over a text view.
SQL_ONLY = {"revenue_by_country_text", "amount_totals"}


def test_every_sql_report_has_a_dataframe_form():
    assert set(REPORT_SQL) == set(FORMS) | SQL_ONLY


@pytest.mark.parametrize("name", sorted(FORMS))
def test_sql_equals_dataframe(spark, name):
    table_names, report, ordered = FORMS[name]
    tables = {t: read_table(spark, SF_ORACLE, t) for t in table_names}
    via_sql = sql_report(spark, name, tables)
    via_df = report(*tables.values())
    assert via_sql.columns == via_df.columns
    drop = [c for c in via_df.columns if c == "processed_at"]
    a = [tuple(r) for r in via_sql.drop(*drop).collect()]
    b = [tuple(r) for r in via_df.drop(*drop).collect()]
    if not ordered:
        a, b = sorted(a, key=repr), sorted(b, key=repr)
    assert a == b and len(a) > 0


@pytest.mark.parametrize("name", ["revenue_by_country", "revenue_by_brand"])
def test_preaggregated_text_for_large_dimensions(spark, name):
    from tallyframe.plans.inspect import plan_text
    from tests.test_plans import conf

    table_names, report, _ = FORMS[name]
    tables = {t: read_table(spark, SF_ORACLE, t) for t in table_names}
    with conf(spark, spark__sql__adaptive__enabled="false"):
        large = sql_report(spark, name, tables, max_broadcast_rows=0)
        small = sql_report(spark, name, tables)
        large_plan, small_plan = plan_text(large), plan_text(small)
        a = sorted((tuple(r) for r in large.collect()), key=repr)
        b = sorted((tuple(r) for r in small.collect()), key=repr)
    assert a == b
    assert "SortMergeJoin" in large_plan
    fact_key = "o_custkey" if name == "revenue_by_country" else "l_partkey"
    assert f"hashpartitioning({fact_key}" in large_plan
    assert f"hashpartitioning({fact_key}" not in small_plan and "BroadcastHashJoin" in small_plan


def test_sorted_sql_reports_rebalance_before_the_sort(spark):
    from tallyframe.plans.inspect import plan_text

    tables = {"lineitem": read_table(spark, SF_ORACLE, "lineitem")}
    assert "REBALANCE_PARTITIONS_BY_NONE" in plan_text(sql_report(spark, "product_sales_metrics", tables))


def test_dirty_amounts_total_the_same_in_both_forms(spark):
    dirty = reports.dirty_amounts(read_table(spark, SF_ORACLE, "orders"))
    via_sql = sql_report(spark, "amount_totals", {"dirty_orders": dirty})
    via_df = reports.amount_totals(dirty, "o_orderpriority", "amount_text")
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, via_df.collect()))


def test_views_of_the_caller_stay(spark):
    spark.range(3).createOrReplaceTempView("orders")
    before = {t.name for t in spark.catalog.listTables()}
    sql_report(spark, "total_sales_by_customer", {"orders": read_table(spark, SF_ORACLE, "orders")}).count()
    assert {t.name for t in spark.catalog.listTables()} == before and spark.table("orders").count() == 3
    spark.catalog.dropTempView("orders")
