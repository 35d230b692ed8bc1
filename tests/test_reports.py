"""The reports on hand-written fixtures with edge cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.plans import reports
from tallyframe.plans.sql import revenue_by_country_sql
from tallyframe.sources.memory import replicate
from tests import fixtures as fx
from tests.conftest import rows


def test_high_value_orders_threshold_is_inclusive(spark):
    got = rows(reports.high_value_orders(fx.orders(spark)), "o_orderkey")
    assert got == [(2,), (6,)]


def test_text_filter_drops_unparseable_and_threshold(spark):
    got = rows(reports.high_value_orders_text(fx.orders(spark), 150_000.0))
    # 3 sits exactly on the threshold, 4 is pending ("n/a")
    assert got == [(2, 10, 300_000.0), (6, None, 410_000.25), (7, 13, 250_000.1), (8, 13, 250_000.1)]
    counts = reports.rejected_amounts(reports.amount_as_text(fx.orders(spark)), "amount_text").first()
    assert (counts["rejected"], counts["rows"]) == (1, 11)


def test_lenient_filter_on_dirty_text(spark):
    df = spark.createDataFrame(
        [(1, "151"), (2, " 152.5 "), (3, "1.5e2"), (4, "abc"), (5, ""), (6, None), (7, "150.0001")],
        "id int, amount_text string",
    )
    got = rows(reports.lenient_threshold_filter(df, "amount_text", 150.0))
    assert got == [(1, 151.0), (2, 152.5), (7, 150.0001)]


def test_filtered_order_count_and_empty_input(spark):
    assert reports.filtered_order_count(fx.orders(spark), 150_000.0).first()["n"] == 5
    empty = fx.orders(spark).where("false")
    assert reports.filtered_order_count(empty).collect()[0]["n"] == 0
    assert reports.total_sales_by_customer(empty).count() == 0


def test_revenue_by_category_counts_non_null_keys_and_orders_ties(spark):
    got = reports.revenue_by_category(fx.orders(spark)).collect()
    by_cat = {r["category"]: (r["total_orders"], r["total_revenue"]) for r in got}
    assert by_cat["5-LOW"] == (1, 250_100.1)  # the null order key is not counted
    assert by_cat[None] == (1, 250_000.1)
    assert by_cat["4-NOT SPECIFIED"] == (2, 0.03)
    revenues = [r["total_revenue"] for r in got]
    assert revenues == sorted(revenues, reverse=True)


def test_product_metrics_half_cent_average_and_hot_key(spark):
    got = {r["l_partkey"]: r for r in reports.product_sales_metrics(fx.lineitems(spark)).collect()}
    assert got[101]["average_transaction_amount"] == 1.01
    assert got[101]["total_quantity_sold"] == 5
    assert got[102]["total_sales_amount"] == 5.55 and got[102]["average_transaction_amount"] == 5.55
    assert got[100]["total_sales_amount"] == 300.0 and got[100]["total_quantity_sold"] == 30
    keys = [r["l_partkey"] for r in reports.product_sales_metrics(fx.lineitems(spark)).collect()]
    assert keys == sorted(keys)


def test_purchases_by_user(spark):
    got = reports.purchases_by_user(fx.events(spark)).collect()
    assert [tuple(r) for r in got] == [(1, 2, 10.005), (3, 1, 0.0), (4, 1, 99.99), (None, 0, 5.0)]
    as_map = {r["user_id"]: (r["total_purchases"], r["avg_spend"]) for r in got}
    assert 2 not in as_map
    assert as_map[3] == (1, 0.0)
    assert as_map[None] == (0, 5.0)  # count(user_id) skips the null key


def test_completed_summary(spark):
    got = {r["category"]: r for r in reports.completed_summary(fx.orders(spark)).collect()}
    assert "5-LOW" in got and got["5-LOW"]["total_orders"] == 0  # only the null-key order
    assert "2-HIGH" in got and got["2-HIGH"]["total_orders"] == 1
    assert got["4-NOT SPECIFIED"]["avg_order_value"] == 0.015
    assert all(r["processed_at"] is not None for r in got.values())


def test_customer_sales_report_inner_join(spark):
    got = rows(reports.customer_sales_report(fx.orders(spark), fx.customers(spark)))
    keys = [r[0] for r in got]
    assert 15 not in keys  # no orders
    assert None not in keys  # null keys never join
    assert got[0] == (10, "Cust A", 420_000.5, "BUILDING")


def test_revenue_by_country_paths_agree(spark):
    o, c, n = fx.orders(spark), fx.customers(spark), fx.nations(spark)
    broadcast = [tuple(r) for r in reports.revenue_by_country(o, c, n, 100_000.0).collect()]
    shuffled = [tuple(r) for r in reports.revenue_by_country(o, c, n, 100_000.0, max_broadcast_rows=0).collect()]
    sql = [tuple(r) for r in revenue_by_country_sql(spark, o, c, n).collect()]
    assert broadcast == shuffled == sql
    # ALPHA: orders 1-4 of customers 10 and 11; the null-key order 6 joins nothing
    assert broadcast == [("ALPHA", 720_000.51), ("CHARLIE", 500_000.2)]


def test_revenue_by_brand_paths_agree(spark):
    li, p = fx.lineitems(spark), fx.parts(spark)
    a = rows(reports.revenue_by_brand(li, p))
    b = rows(reports.revenue_by_brand(li, p, max_broadcast_rows=0))
    assert a == b
    total = fx.lineitems(spark).agg(F.sum("l_extendedprice")).first()[0]
    assert round(sum(r[1] for r in a), 2) == round(total, 2)


def test_preview_top_n_breaks_ties_by_key(spark):
    got = [tuple(r) for r in reports.preview_top_n(fx.orders(spark), 4).collect()]
    assert got == [(6, 410_000.25), (2, 300_000.0), (7, 250_000.1), (8, 250_000.1)]


def test_replicate(spark):
    df = fx.customers(spark)
    assert replicate(df, 3).count() == 3 * df.count()
    assert replicate(df, 0).count() == 0
    copies = rows(replicate(df.where("c_custkey = 10"), 3, "copy"), "copy")
    assert copies == [(1,), (2,), (3,)]


def test_duplicated_customer_key_joins_like_sql(spark):
    """A duplicated dimension key repeats the fact rows, in every form, as in SQL."""
    from tallyframe.plans.sql import sql_report

    o, n = fx.orders(spark), fx.nations(spark)
    c = fx.customers(spark).unionByName(
        spark.createDataFrame([(13, "Cust D again", 4, 1.0, "HOUSEHOLD")], fx.customers(spark).schema))
    report = rows(reports.customer_sales_report(o, c))
    assert [r for r in report if r[0] == 13] == [(13, "Cust D", 500_000.2, "HOUSEHOLD"),
                                                 (13, "Cust D again", 500_000.2, "HOUSEHOLD")]
    df_form = [tuple(r) for r in reports.revenue_by_country(o, c, n, 100_000.0).collect()]
    shuffled = [tuple(r) for r in reports.revenue_by_country(o, c, n, 100_000.0, max_broadcast_rows=0).collect()]
    sql_form = [tuple(r) for r in sql_report(spark, "revenue_by_country", {"orders": o, "customer": c, "nation": n}).collect()]
    assert df_form == shuffled == sql_form
    assert ("DELTA", 500_000.2) in df_form and ("CHARLIE", 500_000.2) in df_form


def test_duplicated_order_rows_count_twice(spark):
    o = fx.orders(spark)
    doubled = o.unionByName(o.where("o_orderkey = 9"))
    got = {r["category"]: (r["total_orders"], r["total_revenue"])
           for r in reports.revenue_by_category(doubled).collect()}
    assert got["4-NOT SPECIFIED"] == (3, 0.04)


def test_empty_parquet_with_schema(spark, scratch):
    from tallyframe.schemas import TABLES

    path = scratch("empty")
    spark.createDataFrame([], TABLES["orders"]).write.parquet(path)
    empty = spark.read.schema(TABLES["orders"]).parquet(path)
    assert reports.revenue_by_category(empty).count() == 0
    assert reports.filtered_order_count(empty).first()["n"] == 0
    assert reports.preview_top_n(empty).count() == 0
    assert reports.completed_summary(empty).count() == 0


def test_quantity_keeps_fractions_and_whole_numbers(spark):
    halves = spark.createDataFrame([(1, 2.0, 0.5)] * 3, "p int, a double, q double")
    got = reports.product_sales_metrics(halves, "p", "a", "q").first()
    assert got["total_quantity_sold"] == 1.5
    whole = spark.createDataFrame([(1, 2.0, 5)] * 3, "p int, a double, q int")
    df = reports.product_sales_metrics(whole, "p", "a", "q")
    assert dict(df.dtypes)["total_quantity_sold"] == "bigint" and df.first()["total_quantity_sold"] == 15


def test_text_amounts_in_every_report(spark):
    rows_ = [("1", "7", "200.00", "1"), ("2", "7", "n/a", "2"), ("3", "8", "", "1"), ("4", "8", "151.25", "x")]
    df = spark.createDataFrame(rows_, "id string, product string, amount string, quantity string")
    assert reports.filtered_order_count(df, 150.0, "amount").first()["n"] == 2
    assert rows(reports.total_sales_by_customer(df, "product", "amount")) == [("7", 200.0), ("8", 151.25)]
    assert rows(reports.product_sales_metrics(df, "product", "amount", "quantity")) == [
        ("7", 200.0, 3.0, 200.0), ("8", 151.25, 1.0, 151.25)]
    assert rows(reports.revenue_by_category(df, "product", "id", "amount")) == [("7", 2, 200.0), ("8", 2, 151.25)]


def test_forced_broadcast_is_checked(spark):
    import pytest

    with pytest.raises(ValueError):
        reports.customer_sales_report(fx.orders(spark), fx.customers(spark), "broadcast", max_broadcast_rows=0)
    forced = reports.customer_sales_report(fx.orders(spark), fx.customers(spark), "broadcast")
    assert rows(forced) == rows(reports.customer_sales_report(fx.orders(spark), fx.customers(spark)))
