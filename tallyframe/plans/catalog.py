"""The query catalogue: every report over a data set root, plus its oracle.

``QUERIES[name](spark, root)`` loads the tables it needs from ``root`` and
returns the report.  ``ORACLE_SQL[name]`` is an independent plain-SQL
statement of the same result for DuckDB over the same Parquet files; it sums
money as ``DECIMAL(38,6)`` and rounds once, so it checks our split sums and our
join/aggregation rewrites, not just the syntax.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.plans import layout, reports, roundtrips, streams
from tallyframe.plans.sql import revenue_by_country_sql, sql_report
from tallyframe.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, root: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, root, n) for n in names]


def q_revenue_by_country_sql(spark: SparkSession, root: str) -> DataFrame:
    return revenue_by_country_sql(spark, *_t(spark, root, "orders", "customer", "nation"))


def q_revenue_by_country_df(spark: SparkSession, root: str) -> DataFrame:
    return reports.revenue_by_country(*_t(spark, root, "orders", "customer", "nation"))


def q_high_value_orders(spark: SparkSession, root: str) -> DataFrame:
    return reports.high_value_orders(read_table(spark, root, "orders"))


def q_high_value_orders_text(spark: SparkSession, root: str) -> DataFrame:
    return reports.high_value_orders_text(read_table(spark, root, "orders"))


def q_filtered_order_count(spark: SparkSession, root: str) -> DataFrame:
    return reports.filtered_order_count(read_table(spark, root, "orders"))


def q_total_sales_by_customer(spark: SparkSession, root: str) -> DataFrame:
    return reports.total_sales_by_customer(read_table(spark, root, "orders"))


def q_revenue_by_country_text_sql(spark: SparkSession, root: str) -> DataFrame:
    """SQL over a view with text amounts: the casts are in the SQL."""
    orders, customer, nation = _t(spark, root, "orders", "customer", "nation")
    tables = {"orders_text": reports.amount_as_text(orders), "customer": customer, "nation": nation}
    return sql_report(spark, "revenue_by_country_text", tables)


def q_total_sales_by_customer_text(spark: SparkSession, root: str) -> DataFrame:
    return reports.total_sales_by_customer_text(read_table(spark, root, "orders"))


def q_rejected_amounts(spark: SparkSession, root: str) -> DataFrame:
    return reports.rejected_amounts(reports.amount_as_text(read_table(spark, root, "orders")), "amount_text")


def q_dirty_amount_totals(spark: SparkSession, root: str) -> DataFrame:
    dirty = reports.dirty_amounts(read_table(spark, root, "orders"))
    return reports.amount_totals(dirty, "o_orderpriority", "amount_text")


def q_dirty_amount_totals_sql(spark: SparkSession, root: str) -> DataFrame:
    dirty = reports.dirty_amounts(read_table(spark, root, "orders"))
    return sql_report(spark, "amount_totals", {"dirty_orders": dirty})


def q_revenue_by_category(spark: SparkSession, root: str) -> DataFrame:
    return reports.revenue_by_category(read_table(spark, root, "orders"))


def q_product_sales_metrics(spark: SparkSession, root: str) -> DataFrame:
    return reports.product_sales_metrics(read_table(spark, root, "lineitem"))


def q_purchases_by_user(spark: SparkSession, root: str) -> DataFrame:
    return reports.purchases_by_user(read_table(spark, root, "events"))


def q_completed_summary(spark: SparkSession, root: str) -> DataFrame:
    summary = reports.completed_summary(read_table(spark, root, "orders"))
    # The load stamp is wall-clock time; compare only that it is set.
    return summary.withColumn("stamped", F.col("processed_at").isNotNull()).drop("processed_at")


def q_customer_sales_report(spark: SparkSession, root: str) -> DataFrame:
    return reports.customer_sales_report(*_t(spark, root, "orders", "customer"))


def q_segment_sales_filtered(spark: SparkSession, root: str) -> DataFrame:
    """Sales of one segment's customers with no broadcast of them: their keys filter the orders first."""
    return reports.segment_sales_report(*_t(spark, root, "orders", "customer"), "BUILDING", max_broadcast_rows=0)


def q_broadcast_lookup(spark: SparkSession, root: str) -> DataFrame:
    return reports.revenue_by_brand(*_t(spark, root, "lineitem", "part"))


def q_preview_top_n(spark: SparkSession, root: str) -> DataFrame:
    return reports.preview_top_n(read_table(spark, root, "orders"))


QUERIES: dict[str, Query] = {
    "revenue_by_country_sql": q_revenue_by_country_sql,
    "revenue_by_country_df": q_revenue_by_country_df,
    "high_value_orders": q_high_value_orders,
    "high_value_orders_text": q_high_value_orders_text,
    "filtered_order_count": q_filtered_order_count,
    "total_sales_by_customer": q_total_sales_by_customer,
    "total_sales_by_customer_text": q_total_sales_by_customer_text,
    "rejected_amounts": q_rejected_amounts,
    "revenue_by_country_text_sql": q_revenue_by_country_text_sql,
    "dirty_amount_totals": q_dirty_amount_totals,
    "dirty_amount_totals_sql": q_dirty_amount_totals_sql,
    "revenue_by_category": q_revenue_by_category,
    "product_sales_metrics": q_product_sales_metrics,
    "purchases_by_user": q_purchases_by_user,
    "completed_summary": q_completed_summary,
    "customer_sales_report": q_customer_sales_report,
    "segment_sales_filtered": q_segment_sales_filtered,
    "broadcast_lookup": q_broadcast_lookup,
    "preview_top_n": q_preview_top_n,
    **roundtrips.QUERIES,
    **streams.QUERIES,
    **layout.QUERIES,
}


_REVENUE_BY_COUNTRY = """
SELECT n.n_name AS country,
       CAST(ROUND(SUM(CAST(o.o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_revenue
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_totalprice > 100000
GROUP BY n.n_name
ORDER BY total_revenue DESC, country
"""

_REVENUE_BY_CATEGORY = """
SELECT o_orderpriority AS category,
       COUNT(o_orderkey) AS total_orders,
       CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_revenue
FROM orders
GROUP BY o_orderpriority
ORDER BY total_revenue DESC, category
"""

_PRODUCT_SALES_METRICS = """
SELECT l_partkey,
       CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_sales_amount,
       CAST(SUM(CAST(l_quantity AS DECIMAL(38,6))) AS DOUBLE) AS total_quantity_sold,
       CAST((2 * CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,6))) * 1000000 AS HUGEINT)
             + 10000 * COUNT(l_extendedprice)) // (20000 * COUNT(l_extendedprice)) AS DOUBLE) / 100.0
           AS average_transaction_amount
FROM lineitem
GROUP BY l_partkey
ORDER BY l_partkey
"""

_TOTAL_SALES_BY_CUSTOMER = """
SELECT o_custkey,
       CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_sales
FROM orders
GROUP BY o_custkey
"""

_AMOUNT_TEXT = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS amount_text
FROM orders
"""

_DIRTY_AMOUNT_TOTALS = r"""
WITH d AS (
    SELECT o_orderpriority, CASE o_orderkey % 12
        WHEN 0 THEN '1e20' WHEN 1 THEN '1e40' WHEN 2 THEN '12d' WHEN 3 THEN '12f' WHEN 4 THEN 'NaN' WHEN 5 THEN ' 7 '
        WHEN 6 THEN '0.0000004' WHEN 7 THEN '-Infinity' WHEN 8 THEN '1,000' WHEN 9 THEN '-3.5e-7' WHEN 10 THEN ''
        ELSE CAST(o_totalprice AS VARCHAR) END AS t
    FROM orders
), a AS (
    SELECT o_orderpriority, t,
           CASE WHEN regexp_full_match(trim(t), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') AND abs(TRY_CAST(t AS DOUBLE)) < 1e28
                THEN CAST(trim(t) AS DECIMAL(38,10)) END AS amount
    FROM d
)
SELECT o_orderpriority, CAST(CAST(ROUND(SUM(amount), 2) AS DECIMAL(38,2)) AS VARCHAR) AS total,
       COUNT(amount) AS counted, COUNT(t) - COUNT(amount) AS rejected
FROM a
GROUP BY o_orderpriority
"""

ORACLE_SQL: dict[str, str] = {
    "dirty_amount_totals": _DIRTY_AMOUNT_TOTALS,
    "dirty_amount_totals_sql": _DIRTY_AMOUNT_TOTALS,
    "revenue_by_country_sql": _REVENUE_BY_COUNTRY,
    "revenue_by_country_df": _REVENUE_BY_COUNTRY,
    "high_value_orders": """
SELECT o_orderkey, o_custkey, o_totalprice
FROM orders
WHERE o_totalprice >= 300000
""",
    "high_value_orders_text": f"""
SELECT o_orderkey, o_custkey, TRY_CAST(amount_text AS DOUBLE) AS amount
FROM ({_AMOUNT_TEXT}) t
WHERE TRY_CAST(amount_text AS DOUBLE) > 150000
""",
    "filtered_order_count": """
SELECT COUNT(*) AS n FROM orders WHERE o_totalprice > 150000
""",
    "total_sales_by_customer": _TOTAL_SALES_BY_CUSTOMER,
    "total_sales_by_customer_text": f"""
SELECT o_custkey,
       CAST(ROUND(SUM(TRY_CAST(amount_text AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_sales
FROM ({_AMOUNT_TEXT}) t
GROUP BY o_custkey
""",
    "rejected_amounts": f"""
SELECT COUNT(*) FILTER (WHERE amount_text IS NOT NULL AND TRY_CAST(amount_text AS DOUBLE) IS NULL) AS rejected,
       COUNT(*) AS rows
FROM ({_AMOUNT_TEXT}) t
""",
    "revenue_by_country_text_sql": f"""
SELECT n.n_name AS country,
       CAST(ROUND(SUM(TRY_CAST(o.amount_text AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_revenue
FROM ({_AMOUNT_TEXT}) o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE TRY_CAST(o.amount_text AS DOUBLE) > 100000
GROUP BY n.n_name
ORDER BY total_revenue DESC, country
""",
    "revenue_by_category": _REVENUE_BY_CATEGORY,
    "product_sales_metrics": _PRODUCT_SALES_METRICS,
    "purchases_by_user": """
SELECT user_id,
       COUNT(user_id) AS total_purchases,
       CAST(SUM(CAST(value AS DECIMAL(38,6))) AS DOUBLE) / COUNT(value) AS avg_spend
FROM events
WHERE event_type = 'purchase'
GROUP BY user_id
ORDER BY total_purchases DESC, user_id
""",
    "completed_summary": """
SELECT o_orderpriority AS category,
       COUNT(o_orderkey) AS total_orders,
       CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_revenue,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) / COUNT(o_totalprice) AS avg_order_value,
       TRUE AS stamped
FROM orders
WHERE o_orderstatus = 'F'
GROUP BY o_orderpriority
""",
    "customer_sales_report": """
SELECT o.o_custkey, c.c_name,
       CAST(ROUND(SUM(CAST(o.o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_sales,
       c.c_mktsegment
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY o.o_custkey, c.c_name, c.c_mktsegment
""",
    "segment_sales_filtered": """
SELECT o.o_custkey, c.c_name, CAST(ROUND(SUM(CAST(o.o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_sales
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'BUILDING'
GROUP BY o.o_custkey, c.c_name
""",
    "broadcast_lookup": """
SELECT p.p_brand,
       CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_revenue
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand
""",
    "preview_top_n": """
SELECT o_orderkey, o_totalprice
FROM orders
ORDER BY o_totalprice DESC, o_orderkey
LIMIT 20
""",
    **roundtrips.ORACLE_SQL,
    **streams.ORACLE_SQL,
    **layout.ORACLE_SQL,
}
