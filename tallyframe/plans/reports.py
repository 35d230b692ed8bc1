"""The named reports, as functions from DataFrames to a DataFrame.

Each takes already loaded tables, so the same code runs on the driver's test
tables, on fixtures in unit tests and on a cluster's full tables.  Money is
summed exactly and rounded once (see ``tallyframe.functions.money``); every total order
ends with a unique tie key so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import exact_decimal, lenient_number, summable
from tallyframe.functions.money import staged_amount, staged_parts, staged_results, staged_sum
from tallyframe.operators.aggregates import money_summary
from tallyframe.operators.joins import BROADCAST_MAX_ROWS, checked_broadcast, fits_broadcast, rollup_through_dimension
from tallyframe.operators.key_filter import prefiltered
from tallyframe.operators.ordering import sorted_by, top_n

# The thresholds of the reports (amounts in the orders' currency).
COUNTRY_REVENUE_MIN_PRICE = 100_000.0
HIGH_VALUE_MIN_PRICE = 300_000.0
TEXT_FILTER_MIN_PRICE = 150_000.0
COMPLETED_STATUS = "F"
PURCHASE_EVENT = "purchase"
PREVIEW_ROWS = 20
# The output column names of the reports are their interface
# (total_sales_amount, total_quantity_sold, average_transaction_amount,
# total_purchases, total_orders, avg_order_value, processed_at).
# Text written in place of the amount of a pending order by the dirty-text
# fixture; it must be rejected by the lenient parse.
UNPARSEABLE_AMOUNT = "n/a"
# Bound under which the nation table is broadcast (it has 25 rows by design).
NATION_MAX_ROWS = 10_000


def revenue_by_country(
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    min_price: float = COUNTRY_REVENUE_MIN_PRICE,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """``country``, ``total_revenue`` of orders above ``min_price``, dearest first.

    The customer dimension (with its nation name attached through a checked
    broadcast of ``nation``) is broadcast when small; otherwise orders are
    summed per customer before the shuffle join.
    """
    nations = checked_broadcast(nation.select("n_nationkey", F.col("n_name").alias("country")), NATION_MAX_ROWS)
    customer_country = (
        customer.select("c_custkey", "c_nationkey")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "country")
    )
    sums = rollup_through_dimension(
        staged_amount(orders.where(F.col("o_totalprice") > min_price), "o_totalprice", "revenue"),
        "o_custkey",
        staged_parts("revenue"),
        customer_country,
        "c_custkey",
        ["country"],
        max_broadcast_rows,
        size_probe=customer,
    )
    result = staged_results(sums, "revenue").select("country", staged_sum("revenue").alias("total_revenue"))
    return sorted_by(result, [F.col("total_revenue").desc()], ["country"])


def high_value_orders(orders: DataFrame, min_price: float = HIGH_VALUE_MIN_PRICE) -> DataFrame:
    """Key, customer and price of orders priced at ``min_price`` or more."""
    return orders.where(F.col("o_totalprice") >= min_price).select("o_orderkey", "o_custkey", "o_totalprice")


def amount_as_text(orders: DataFrame) -> DataFrame:
    """Orders with the price as text, as a CSV feed would carry it.

    Pending orders carry a marker instead of a number, so the text holds
    values a numeric parse must reject.
    """
    text = F.when(F.col("o_orderstatus") == "P", F.lit(UNPARSEABLE_AMOUNT)).otherwise(
        F.col("o_totalprice").cast("string")
    )
    return orders.select("o_orderkey", "o_custkey", text.alias("amount_text"))


def lenient_threshold_filter(df: DataFrame, text_column: str, min_value: float, out: str = "amount") -> DataFrame:
    """Rows whose text parses to a number above ``min_value``; adds it as ``out``.

    Unparseable text is null after ``try_cast`` and fails the predicate, the
    answer Spark 3 gave with ANSI off, now independent of the ANSI setting.
    """
    parsed = lenient_number(text_column)
    kept = df.where(parsed > min_value)
    if out.lower() == text_column.lower():  # names resolve case-insensitively
        return kept.withColumn(out, parsed)
    return kept.withColumn(out, parsed).drop(text_column)


def high_value_orders_text(orders: DataFrame, min_price: float = TEXT_FILTER_MIN_PRICE) -> DataFrame:
    """``o_orderkey``, ``o_custkey``, ``amount``: text amounts above ``min_price``."""
    return lenient_threshold_filter(amount_as_text(orders), "amount_text", min_price)


def rejected_amounts(df: DataFrame, text_column: str) -> DataFrame:
    """One row: how many non-null texts are no numbers, or too large to be summed."""
    bad = F.col(text_column).isNotNull() & summable(text_column).isNull()
    return df.agg(F.count(F.when(bad, F.lit(1))).alias("rejected"), F.count(F.lit(1)).alias("rows"))


# Texts that stand in place of some amounts in the dirty feed.
DIRTY_AMOUNTS = ("1e20", "1e40", "12d", "12f", "NaN", " 7 ", "0.0000004", "-Infinity", "1,000", "-3.5e-7", "")


def dirty_amounts(orders: DataFrame) -> DataFrame:
    """Orders whose price arrives as text, with one of ``DIRTY_AMOUNTS`` in most places."""
    place = (F.col("o_orderkey") % (len(DIRTY_AMOUNTS) + 1)).cast("int")
    text = F.coalesce(F.get(F.array(*[F.lit(t) for t in DIRTY_AMOUNTS]), place), F.col("o_totalprice").cast("string"))
    return orders.select("o_orderpriority", text.alias("amount_text"))


def amount_totals(df: DataFrame, by: str, amount: str) -> DataFrame:
    """``<by>``, ``total`` (exact, as text), ``counted`` and ``rejected`` amounts."""
    usable, given = F.count(summable(amount)), F.count(amount)
    return df.groupBy(by).agg(exact_decimal(amount).cast("string").alias("total"), usable.alias("counted"),
                              (given - usable).alias("rejected"))


def filtered_order_count(
    orders: DataFrame, min_price: float = TEXT_FILTER_MIN_PRICE, amount: str = "o_totalprice"
) -> DataFrame:
    """One row ``n``: orders priced above ``min_price``; amounts may be text."""
    return orders.where(lenient_number(amount) > min_price).agg(F.count(F.lit(1)).alias("n"))


def total_sales_by_customer(
    orders: DataFrame, customer: str = "o_custkey", amount: str = "o_totalprice"
) -> DataFrame:
    """``<customer>``, ``total_sales`` (exact)."""
    return money_summary(orders, [customer], amount, sum_as="total_sales")


def total_sales_by_customer_text(orders: DataFrame) -> DataFrame:
    """``total_sales_by_customer`` over amounts that arrive as text; what does not parse adds nothing."""
    return total_sales_by_customer(amount_as_text(orders), amount="amount_text")


def revenue_by_category(
    orders: DataFrame,
    category: str = "o_orderpriority",
    order_id: str = "o_orderkey",
    amount: str = "o_totalprice",
) -> DataFrame:
    """``category``, ``total_orders``, ``total_revenue``, dearest first.

    ``total_orders`` counts non-null ``order_id`` values, as ``count(col)`` does.
    """
    result = money_summary(
        orders, [F.col(category).alias("category")], amount,
        count_as="total_orders", count_of=order_id, sum_as="total_revenue",
    )
    return sorted_by(result, [F.col("total_revenue").desc()], ["category"])


def product_sales_metrics(
    lineitem: DataFrame,
    product: str = "l_partkey",
    amount: str = "l_extendedprice",
    quantity: str = "l_quantity",
) -> DataFrame:
    """Per product: total amount, total quantity, average amount; by product key.

    The total quantity is a ``bigint`` for a whole-number column, else the
    exact sum as double.
    """
    whole = isinstance(lineitem.schema[quantity].dataType, T.IntegralType)
    result = money_summary(
        lineitem, [product], amount,
        sum_as="total_sales_amount",
        totals=None if whole else {"total_quantity_sold": quantity},
        extra=(F.sum(quantity).alias("total_quantity_sold"),) if whole else (),
        avg_as="average_transaction_amount",
    ).select(product, "total_sales_amount", "total_quantity_sold", "average_transaction_amount")
    return sorted_by(result, [], [product], materialize=True)


def purchases_by_user(
    events: DataFrame,
    by: str = "user_id",
    amount: str = "value",
    event_type: str = "event_type",
    counted: str | None = None,
    purchase: str = PURCHASE_EVENT,
) -> DataFrame:
    """``<by>``, ``total_purchases``, ``avg_spend`` of purchase events, busiest first.

    ``total_purchases`` counts non-null ``counted`` values (default: ``by``).
    """
    result = money_summary(
        events.where(F.col(event_type) == purchase), [by], amount,
        count_as="total_purchases", count_of=counted or by, mean_as="avg_spend",
    )
    return sorted_by(result, [F.col("total_purchases").desc()], [by], materialize=True)


def completed_summary(
    orders: DataFrame,
    status: str = COMPLETED_STATUS,
    status_column: str = "o_orderstatus",
    category: str = "o_orderpriority",
    order_id: str = "o_orderkey",
    amount: str = "o_totalprice",
) -> DataFrame:
    """Orders in ``status`` by category: count, exact sum, unrounded average, load stamp."""
    summary = money_summary(
        orders.where(F.col(status_column) == status),
        [F.col(category).alias("category")], amount,
        count_as="total_orders", count_of=order_id,
        sum_as="total_revenue", mean_as="avg_order_value",
    )
    return summary.withColumn("processed_at", F.current_timestamp())


def customer_sales_report(
    orders: DataFrame,
    customer: DataFrame,
    strategy: str | None = None,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """``o_custkey``, ``c_name``, ``total_sales``, ``c_mktsegment``.

    Aggregate first, then join.  A customer table within the broadcast bound
    is broadcast; otherwise the aggregate, already hash-partitioned on the
    customer key, is joined without a second shuffle and only the customer
    side moves.  ``strategy`` forces a join hint for the customer side
    (``merge``, ``shuffle_hash``, ``broadcast``); the answer does not depend
    on it.  A forced broadcast above the bound is refused.
    """
    sales = total_sales_by_customer(orders)
    customers = customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    small = strategy in (None, "broadcast") and fits_broadcast(customers, max_broadcast_rows, size_probe=customer)
    if strategy == "broadcast" and not small:
        raise ValueError("the customer table is above the broadcast bound")
    if strategy:
        customers = customers.hint(strategy)
    elif small:
        customers = F.broadcast(customers)
    return sales.join(customers, on="o_custkey", how="inner").select(
        "o_custkey", "c_name", "total_sales", "c_mktsegment"
    )


def segment_sales_report(
    orders: DataFrame, customer: DataFrame, segment: str, max_broadcast_rows: int = BROADCAST_MAX_ROWS
) -> DataFrame:
    """``o_custkey``, ``c_name``, ``total_sales`` of the customers of one segment.

    Few enough customers are broadcast.  Otherwise orders of other segments are
    dropped by a filter of the kept keys before the per-customer sums are
    shuffled, unless the segment holds most customers, and the sums are joined
    on their own partitioning.
    """
    kept = customer.where(F.col("c_mktsegment") == segment).select(F.col("c_custkey").alias("o_custkey"), "c_name")
    if fits_broadcast(kept, max_broadcast_rows, size_probe=customer):
        kept = F.broadcast(kept)
    else:
        n_kept = kept.count()
        if 2 * n_kept <= customer.count():
            orders = prefiltered(orders.select("o_custkey", "o_totalprice"), "o_custkey", kept, "o_custkey", n_kept)
    return total_sales_by_customer(orders).join(kept, "o_custkey").select("o_custkey", "c_name", "total_sales")


def revenue_by_brand(
    lineitem: DataFrame, part: DataFrame, max_broadcast_rows: int = BROADCAST_MAX_ROWS
) -> DataFrame:
    """``p_brand``, ``total_revenue``: line revenue through the part lookup."""
    sums = rollup_through_dimension(
        staged_amount(lineitem, "l_extendedprice", "revenue"), "l_partkey", staged_parts("revenue"),
        part, "p_partkey", ["p_brand"], max_broadcast_rows,
    )
    return staged_results(sums, "revenue").select("p_brand", staged_sum("revenue").alias("total_revenue"))


def preview_top_n(orders: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The ``n`` dearest orders, ties broken by key."""
    return top_n(orders.select("o_orderkey", "o_totalprice"), n, [F.col("o_totalprice").desc()], ["o_orderkey"])
