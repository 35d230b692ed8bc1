"""The reports on inputs shaped like the reference's own jobs (own values).

Fixed values: the CSV headers and column names; they are the jobs' interface.

Each test reads a header CSV or in-memory rows with the column names those
jobs use and runs the matching report with column-name parameters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators.aggregates import money_summary
from tallyframe.plans import reports
from tallyframe.schemas import TRANSACTIONS
from tallyframe.sources.csv import read_csv_text, read_csv_typed
from tallyframe.sources.memory import replicate, rows_frame
from tests.conftest import rows
from tests.test_sources_sinks import _write_text


def test_text_orders_filter_count_group_and_join(spark, scratch):
    orders_path, customers_path = scratch("csv"), scratch("csv")
    _write_text(spark, orders_path, [
        "OrderID,CustomerID,ProductID,Amount,Quantity",
        "1,1,7,200.00,1", "2,1,8,99.50,2", "3,2,7,151.25,1", "4,3,9,n/a,1", "5,2,9,300.10,3", "6,,7,160.00,1",
    ])
    _write_text(spark, customers_path, ["CustomerID,CustomerName,Country", "1,Ann,NL", "2,Bo,SE", "4,Cy,NL"])
    orders = read_csv_text(spark, orders_path)
    customers = read_csv_typed(spark, customers_path, infer=True)
    over = reports.lenient_threshold_filter(orders, "Amount", 150.0).select("OrderID", "CustomerID", "amount")
    assert over.count() == 4
    totals = money_summary(orders, ["CustomerID"], "Amount", sum_as="TotalSales")
    joined = totals.join(customers.withColumn("CustomerID", F.col("CustomerID").cast("string")), "CustomerID")
    assert rows(joined.select("CustomerID", "CustomerName", "TotalSales", "Country")) == [
        ("1", "Ann", 299.5, "NL"), ("2", "Bo", 451.35, "SE")]


def test_category_revenue(spark):
    df = spark.createDataFrame(
        [(1, "C01", "Toys", 10.10), (2, "C02", "Toys", 5.00), (3, "C03", "Books", 15.10), (None, "C04", "Books", 1.0)],
        "OrderID int, CustomerID string, Category string, Amount double")
    got = [tuple(r) for r in reports.revenue_by_category(df, "Category", "OrderID", "Amount").collect()]
    assert got == [("Books", 1, 16.1), ("Toys", 2, 15.1)]


def test_product_metrics_on_transactions(spark):
    data = [(1, 7, 100, 10.5, 2, "EAST"), (2, 8, 100, 0.5, 1, "WEST"), (3, 7, 101, 3.25, 4, "EAST")]
    got = [tuple(r) for r in reports.product_sales_metrics(
        rows_frame(spark, data, TRANSACTIONS), "ProductID", "Amount", "Quantity").collect()]
    assert got == [(100, 11.0, 3, 5.5), (101, 3.25, 4, 3.25)]


def test_purchases_by_region_on_replicated_rows(spark):
    base = spark.createDataFrame(
        [("u1", "purchase", "eu-1", 89.9, "2026-01-02"), ("u2", "click", "eu-1", 1.0, "2026-01-02"),
         ("u3", "purchase", "us-1", 10.0, "2026-01-02"), ("u4", "purchase", "us-1", 20.01, "2026-01-02")],
        "user_id string, event_type string, aws_region string, amount double, event_date string")
    events = replicate(base, 500)
    got = [tuple(r) for r in reports.purchases_by_user(
        events, by="aws_region", amount="amount", counted="user_id").collect()]
    assert got == [("us-1", 1000, 15.005), ("eu-1", 500, 89.9)]  # a double average gives 89.9000000000002


def test_completed_summary_with_status_text(spark):
    base = spark.createDataFrame(
        [("o1", "c1", "TOOLS", 100.0, "COMPLETED", "2026-01-01"), ("o2", "c2", "TOOLS", 50.5, "PENDING", "2026-01-01"),
         ("o3", "c3", "GARDEN", 20.25, "COMPLETED", "2026-01-02"), ("o4", "c4", "HOME", 9.0, "CANCELLED", "2026-01-02")],
        "order_id string, customer_id string, category string, amount double, status string, order_date string")
    got = reports.completed_summary(replicate(base, 200), "COMPLETED", "status", "category", "order_id", "amount")
    assert rows(got.drop("processed_at")) == [("GARDEN", 200, 4050.0, 20.25), ("TOOLS", 200, 20000.0, 100.0)]


def test_sales_report_job_on_transaction_csv(spark, scratch):
    from tallyframe.jobs.sales_report import run_sales_report

    src = scratch("csv")
    _write_text(spark, src, [
        "TransactionID,CustomerID,ProductID,Amount,Quantity,Region",
        "1,7,100,10.5,2,EAST", "2,8,100,0.5,1,WEST", "3,7,101,3.25,4,EAST", "4,9,9,1.00,1,WEST",
    ])
    ddl = "TransactionID INT, CustomerID INT, ProductID INT, Amount DOUBLE, Quantity INT, Region STRING"
    expected = [(9, 1.0, 1, 1.0), (100, 11.0, 3, 5.5), (101, 3.25, 4, 3.25)]
    declared = run_sales_report(spark, src, scratch("out"), "csv", "ProductID", "Amount", "Quantity", schema=ddl)
    assert sorted(tuple(r) for r in declared.collect()) == expected
    inferred = run_sales_report(spark, src, None, "csv", "ProductID", "Amount", "Quantity", infer=True)
    assert [tuple(r) for r in inferred.collect()] == expected


def test_sales_report_job_on_other_csv_inputs(spark, scratch):
    """No schema is an error, a shuffled header is read by name, folders and suffixes do not matter."""
    import pytest

    from tallyframe.jobs.sales_report import detect_format, run_sales_report
    from tallyframe.sources.csv import rejected_cells

    src = scratch("csv")
    _write_text(spark, src, ["Region,Quantity,Amount,ProductID", "EAST,2,10.5,100", "WEST,1,oops,100", "EAST,4,3.25,101"])
    args = ("csv", "ProductID", "Amount", "Quantity")
    ddl = "ProductID INT, Amount DOUBLE, Quantity INT"
    with pytest.raises(ValueError, match="schema"):
        run_sales_report(spark, src, None, *args)
    with pytest.raises(ValueError, match="Price"):
        run_sales_report(spark, src, None, *args, schema="ProductID INT, Price DOUBLE, Quantity INT")
    with pytest.raises(ValueError, match="l_partkey"):
        run_sales_report(spark, src, None, "csv", infer=True)
    got = run_sales_report(spark, src, None, *args, schema=ddl)
    assert rows(got) == [(100, 10.5, 3, 10.5), (101, 3.25, 4, 3.25)]
    assert tuple(rejected_cells(spark, src, ddl).first()) == (0, 1, 0)
    assert detect_format(spark, src) == "csv"  # a folder of .txt parts
    table = scratch("parquet")
    got.write.parquet(table)
    assert detect_format(spark, table) == "parquet"
    zipped = scratch("csv-zstd")
    got.write.option("header", True).option("compression", "gzip").csv(zipped)
    assert detect_format(spark, zipped) == "csv"
