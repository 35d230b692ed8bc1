"""Queries that go through a sink and back: CSV, Parquet, the path job.

Intermediates are written under the session's shared checkpoint folder, each
run into a fresh folder, so reruns and concurrent runs never collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import lenient_number
from tallyframe.jobs.sales_report import run_sales_report
from tallyframe.operators.bucketing import write_bucketed
from tallyframe.plans import reports
from tallyframe.schemas import LONG, DOUBLE, struct_of
from tallyframe.session import scratch_path
from tallyframe.sinks.files import load_table, write_parquet
from tallyframe.sinks.versions import read_current, replace_version
from tallyframe.sources.csv import read_csv_text, read_csv_typed, write_csv
from tallyframe.sources.inference import inference_report, read_csv_inferred
from tallyframe.sources.memory import replicate
from tallyframe.sources.quarantine import Quarantined, load_with_quarantine
from tallyframe.sources.tables import read_table, table_path

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]
ORDER_CSV_SCHEMA = struct_of(("o_orderkey", LONG), ("o_custkey", LONG), ("o_totalprice", DOUBLE))
# Fixed value: copies of each customer row in the replication query.
REPLICATION_FACTOR = 4
# Fixed value: buckets of the bucketed tables.
BUCKETS = 16
# Share of a column's filled cells that its inferred type may reject.
INFERENCE_TOLERANCE = 0.05


def _orders_as_csv(spark: SparkSession, root: str) -> str:
    path = scratch_path(spark, "orders-csv")
    return write_csv(read_table(spark, root, "orders").select(*ORDER_COLUMNS), path)


def q_csv_scan_text(spark: SparkSession, root: str) -> DataFrame:
    """Orders through CSV, read back as text and converted leniently."""
    text = read_csv_text(spark, _orders_as_csv(spark, root))
    return text.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").try_cast("bigint").alias("o_custkey"),
        lenient_number("o_totalprice").alias("o_totalprice"),
    )


def q_csv_scan_typed(spark: SparkSession, root: str) -> DataFrame:
    """Orders through CSV, read back with a declared schema."""
    return read_csv_typed(spark, _orders_as_csv(spark, root), ORDER_CSV_SCHEMA)


def _dirty_orders_as_csv(spark: SparkSession, root: str) -> str:
    """Orders with a spoilt cell in every 50th price and every 40th date, and an empty cell in every 30th status."""
    key = F.col("o_orderkey")
    rows = read_table(spark, root, "orders").select(
        "o_orderkey", (key * 3_000_000_000).alias("wide_key"), "o_custkey",
        F.when(key % 30 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 50 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(key % 40 == 0, "unknown").otherwise(F.to_date("o_orderdate").cast("string")).alias("o_orderdate"),
        (key % 2 == 0).alias("even"),
    )
    return write_csv(rows, scratch_path(spark, "dirty-orders-csv"))


def q_csv_scan_inferred(spark: SparkSession, root: str) -> DataFrame:
    """Dirty orders through CSV under inferred types, 5% of a column's cells tolerated."""
    rows, _ = read_csv_inferred(spark, _dirty_orders_as_csv(spark, root), INFERENCE_TOLERANCE)
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy/MM/dd"))


def q_csv_inference_report(spark: SparkSession, root: str) -> DataFrame:
    """The types found in the dirty orders' CSV, and how many cells each rejects."""
    _, facts = read_csv_inferred(spark, _dirty_orders_as_csv(spark, root), INFERENCE_TOLERANCE)
    return inference_report(spark, facts, INFERENCE_TOLERANCE)


def _broken_orders_as_csv(spark: SparkSession, root: str) -> str:
    """Orders as CSV lines with quoted texts; some lines short, long, with a quote left open or a price that is no number."""
    key = F.col("o_orderkey")
    price = F.when(key % 110 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    text = F.concat(F.lit('"say \\"'), "o_orderpriority", F.lit('\\", then ship"'))
    whole = F.concat_ws(",", key.cast("string"), F.coalesce(F.col("o_custkey").cast("string"), F.lit("")), text, price)
    line = (
        F.when(key % 90 == 0, F.concat(key.cast("string"), F.lit(',7,"open,'), price))
        .when(key % 50 == 0, F.concat(key.cast("string"), F.lit(","), text))
        .when(key % 70 == 0, F.concat(whole, F.lit(",more")))
        .otherwise(whole)
    )
    path = scratch_path(spark, "broken-orders-csv")
    lines = read_table(spark, root, "orders").select(line.alias("o_orderkey,o_custkey,note,o_totalprice"))
    # One column, no quoting: the lines and the header are written as they are.
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").option("escapeQuotes", False).csv(path)
    return path


def _loaded_orders(spark: SparkSession, root: str) -> Quarantined:
    schema = "o_orderkey BIGINT, o_totalprice DOUBLE, note STRING, o_custkey BIGINT"
    return load_with_quarantine(
        spark, _broken_orders_as_csv(spark, root), scratch_path(spark, "checked-orders"), schema, reject_types=True
    )


def q_csv_quarantine_rows(spark: SparkSession, root: str) -> DataFrame:
    """Orders through broken CSV: the rows of the lines that fit the columns."""
    return _loaded_orders(spark, root).rows


def q_csv_quarantine_lines(spark: SparkSession, root: str) -> DataFrame:
    """Orders through broken CSV: the lines put aside, why, and whether their file is known."""
    rejected = _loaded_orders(spark, root).rejected
    return rejected.select("reason", "line", F.col("file").contains("broken-orders-csv").alias("file_known"))


def q_replicate_rows(spark: SparkSession, root: str) -> DataFrame:
    """Customers replicated ``REPLICATION_FACTOR`` times, counted by segment."""
    customers = read_table(spark, root, "customer").select("c_mktsegment")
    return replicate(customers, REPLICATION_FACTOR).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n")
    )


def q_sales_report(spark: SparkSession, root: str) -> DataFrame:
    """The path job: line items in, metrics written as Parquet, read back."""
    return run_sales_report(spark, table_path(root, "lineitem"), scratch_path(spark, "sales-report"), fmt="parquet")


def q_parquet_overwrite(spark: SparkSession, root: str) -> DataFrame:
    """Category revenue replacing other rows of the same folder; only the second write remains."""
    out = scratch_path(spark, "category-revenue")
    other = spark.createDataFrame([("old rows", 1, 0.01)], "category string, total_orders bigint, total_revenue double")
    write_parquet(other, out)
    report = reports.revenue_by_category(read_table(spark, root, "orders"))
    write_parquet(report, out, source_paths=[table_path(root, "orders")], swap=True)
    return spark.read.parquet(out)


def q_versioned_replace(spark: SparkSession, root: str) -> DataFrame:
    """Category revenue put in force in place of other rows, then one status's orders in place of its partition."""
    path = scratch_path(spark, "versioned-orders")
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    replace_version(orders, path, partition_by=["o_orderstatus"])
    paid = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    replace_version(paid, path, partition_by=["o_orderstatus"], partitions_only=True)
    return read_current(spark, path)


def q_table_load(spark: SparkSession, root: str) -> DataFrame:
    """Category revenue loaded into a table named by format and options, in place of other rows, and read back."""
    path = scratch_path(spark, "loaded-table")
    other = spark.createDataFrame([("old rows", 1, 0.01)], "category string, total_orders bigint, total_revenue double")
    load_table(other, "orc", {"path": path})
    load_table(reports.revenue_by_category(read_table(spark, root, "orders")), "orc", {"path": path, "compression": "zlib"})
    return spark.read.format("orc").load(path)


def bucketed_sales(spark: SparkSession, root: str, buckets: int = BUCKETS) -> DataFrame:
    """The customer sales report over orders and customers bucketed by customer, under the merge hint."""
    orders = read_table(spark, root, "orders").select("o_custkey", "o_totalprice")
    customer = read_table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return reports.customer_sales_report(
        write_bucketed(orders, scratch_path(spark, "bucketed-orders"), "o_custkey", buckets),
        write_bucketed(customer, scratch_path(spark, "bucketed-customers"), "c_custkey", buckets),
        strategy="merge",
    )


def q_customer_sales_bucketed(spark: SparkSession, root: str) -> DataFrame:
    """Sort-merge join of bucketed tables: nothing is shuffled after the tables are written."""
    return bucketed_sales(spark, root)


QUERIES = {
    "versioned_replace": q_versioned_replace,
    "table_load": q_table_load,
    "customer_sales_bucketed": q_customer_sales_bucketed,
    "csv_scan_text": q_csv_scan_text,
    "csv_scan_typed": q_csv_scan_typed,
    "csv_scan_inferred": q_csv_scan_inferred,
    "csv_inference_report": q_csv_inference_report,
    "csv_quarantine_rows": q_csv_quarantine_rows,
    "csv_quarantine_lines": q_csv_quarantine_lines,
    "replicate_rows": q_replicate_rows,
    "sales_report": q_sales_report,
    "parquet_overwrite": q_parquet_overwrite,
}

_ORDERS_3 = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"

_CATEGORY_REVENUE = """
SELECT o_orderpriority AS category,
       COUNT(o_orderkey) AS total_orders,
       CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_revenue
FROM orders
GROUP BY o_orderpriority
"""

ORACLE_SQL = {
    "versioned_replace": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice, o_orderstatus
FROM orders
""",
    "table_load": _CATEGORY_REVENUE,
    "customer_sales_bucketed": """
SELECT o.o_custkey, c.c_name,
       CAST(ROUND(SUM(CAST(o.o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_sales,
       c.c_mktsegment
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY o.o_custkey, c.c_name, c.c_mktsegment
""",
    "csv_scan_text": _ORDERS_3,
    "csv_scan_typed": _ORDERS_3,
    "csv_scan_inferred": """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderkey * 3000000000 AS wide_key, CAST(o_custkey AS INTEGER) AS o_custkey,
       CASE WHEN o_orderkey % 30 <> 0 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 40 <> 0 THEN strftime(o_orderdate, '%Y/%m/%d') END AS o_orderdate,
       o_orderkey % 2 = 0 AS even
FROM orders
""",
    "csv_inference_report": """
WITH n AS (
    SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderkey % 50 = 0) AS bad_price,
           COUNT(*) FILTER (WHERE o_orderkey % 40 = 0) AS bad_date, COUNT(*) FILTER (WHERE o_orderkey % 30 = 0) AS no_status,
           MAX(o_orderkey) <= 2147483647 AS small_keys, MAX(o_orderkey) * 3000000000 <= 2147483647 AS small_wide
    FROM orders
)
SELECT "column", type, n AS n_rows, filled, rejected
FROM n, LATERAL (VALUES
    ('o_orderkey', CASE WHEN small_keys THEN 'int' ELSE 'bigint' END, n, 0),
    ('wide_key', CASE WHEN small_wide THEN 'int' ELSE 'bigint' END, n, 0),
    ('o_custkey', 'int', n, 0), ('o_orderstatus', 'string', n - no_status, 0), ('o_totalprice', 'double', n, bad_price),
    ('o_orderdate', 'date', n, bad_date), ('even', 'boolean', n, 0)) AS v("column", type, filled, rejected)
""",
    "csv_quarantine_rows": """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
       'say "' || o_orderpriority || '", then ship' AS note, o_custkey
FROM orders
WHERE o_orderkey % 90 <> 0 AND o_orderkey % 50 <> 0 AND o_orderkey % 70 <> 0 AND o_orderkey % 110 <> 0
""",
    "csv_quarantine_lines": r"""
WITH parts AS (
    SELECT o_orderkey AS key, COALESCE(CAST(o_custkey AS VARCHAR), '') AS cust,
           '"say \"' || o_orderpriority || '\", then ship"' AS note,
           CASE WHEN o_orderkey % 110 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price
    FROM orders
), whole AS (
    SELECT *, key || ',' || cust || ',' || note || ',' || price AS line FROM parts
)
SELECT CASE WHEN key % 90 = 0 THEN 'open_quote' WHEN key % 50 = 0 THEN 'short' WHEN key % 70 = 0 THEN 'long' ELSE 'type' END AS reason,
       CASE WHEN key % 90 = 0 THEN key || ',7,"open,' || price WHEN key % 50 = 0 THEN key || ',' || note
            WHEN key % 70 = 0 THEN line || ',more' ELSE line END AS line,
       TRUE AS file_known
FROM whole
WHERE key % 90 = 0 OR key % 50 = 0 OR key % 70 = 0 OR key % 110 = 0
""",
    "replicate_rows": """
SELECT c_mktsegment, 4 * COUNT(*) AS n
FROM customer
GROUP BY c_mktsegment
""",
    "sales_report": """
SELECT l_partkey,
       CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_sales_amount,
       CAST(SUM(CAST(l_quantity AS DECIMAL(38,6))) AS DOUBLE) AS total_quantity_sold,
       CAST((2 * CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,6))) * 1000000 AS HUGEINT)
             + 10000 * COUNT(l_extendedprice)) // (20000 * COUNT(l_extendedprice)) AS DOUBLE) / 100.0
           AS average_transaction_amount
FROM lineitem
GROUP BY l_partkey
""",
    "parquet_overwrite": """
SELECT o_orderpriority AS category,
       COUNT(o_orderkey) AS total_orders,
       CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_revenue
FROM orders
GROUP BY o_orderpriority
""",
}
