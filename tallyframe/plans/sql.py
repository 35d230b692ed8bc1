"""Reports as SQL text over named temp views.

The SQL form plans to the same operators as the DataFrame form; it exists for
users who write SQL.  Views are registered with ``createOrReplaceTempView``;
a dimension registered through ``checked_broadcast`` keeps its broadcast hint
inside the view, so the SQL text needs no unchecked hint of its own.

Reports that roll a fact table up through a dimension have two texts, picked
by the same size check: a plain join-aggregate when the dimension is
broadcast (the fact table is never shuffled), and a form that sums the fact
table per join key first when it is not (a hot key is collapsed inside each
map task, and one row per key meets the dimension in a sort-merge join).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import money
from tallyframe.operators.joins import BROADCAST_MAX_ROWS, fits_broadcast
from tallyframe.plans.reports import NATION_MAX_ROWS


# SQL spellings of the money expressions of ``tallyframe.functions``, in the
# same three stages: the amount ``x`` and its millionths ``m`` per row, the sums
# per group, and the sums put together.
def _rows(table: str, amount: str, text: bool = False, also: str = "", condition: str = "") -> str:
    """``table`` with the amount as ``x<also>`` and its millionths, if it is an ordinary amount, as ``m<also>``."""
    number = money.sql_number(amount) if text else f"TRY_CAST({amount} AS DOUBLE)"
    x, where = f"x{also}", f" WHERE {condition}" if condition else ""
    return f"(SELECT *, {money.sql_micros(x)} AS m{also} FROM (SELECT *, {number} AS {x} FROM {table}){where})"


def _sums(also: str = "") -> str:
    """The sums of an amount, and the count of what was summed."""
    parts = money.sql_parts(f"x{also}", f"m{also}")
    return ",\n           ".join(f"{'COUNT' if p == 'n' else 'SUM'}({text}) AS {p}{also}" for p, text in parts.items())


def _again(also: str = "") -> str:
    """Sums of sums, for a second grouping."""
    return ", ".join(f"SUM({part}{also}) AS {part}{also}" for part in (*money.PARTS, "n"))


def _joined(sums: str, also: str = "") -> str:
    """The rows of ``sums`` with the sums put together as ``units`` and ``rest``."""
    units = money.sql_units(f"whole{also}", f"giga{also}", f"exa{also}")
    rest = money.sql_rest(f"micros{also}", f"pico{also}", f"atto{also}")
    return f"(SELECT *, {units} AS units{also}, {rest} AS rest{also} FROM ({sums}))"


_SUM, _MEAN, _AVG = money.sql_double("units", "rest", True), money.sql_mean("units", "rest", "n"), money.sql_avg("units", "rest", "n")
_QUANTITY = money.sql_double("units_q", "rest_q", False)


def _grouped(rows: str, keys: str, more: str = "", sums: str = "") -> str:
    """Sums of the rows' amounts per key, put together; ``more`` are further aggregates."""
    more = f"{more}, " if more else ""
    return _joined(f"SELECT {keys}, {more}{sums or _sums()} FROM {rows} GROUP BY {keys}")


# Dimension within the broadcast bound: join, then aggregate.
def _by_country(rows: str) -> str:
    joined = f"{rows} o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"
    return f"""
SELECT n_name AS country, {_SUM} AS total_revenue
FROM {_grouped(joined, "n_name")}
ORDER BY total_revenue DESC, country
"""


REVENUE_BY_COUNTRY_SQL = _by_country(_rows("orders", "o_totalprice", condition="x > 100000"))

# The same over a view whose amounts are text.
REVENUE_BY_COUNTRY_TEXT_SQL = _by_country(_rows("orders_text", "amount_text", text=True, condition="x > 100000"))


# Dirty text amounts: exact totals as text, and what was rejected.
AMOUNT_TOTALS_SQL = f"""
SELECT o_orderpriority,
       CAST(CAST(CAST(units AS DECIMAL(38,2)) + ROUND(rest, 2) AS DECIMAL(38,2)) AS STRING) AS total,
       n AS counted, given - n AS rejected
FROM {_grouped(_rows("dirty_orders", "amount_text", text=True), "o_orderpriority", "COUNT(amount_text) AS given")}
"""


# Dimension above the bound: orders are summed per customer before the joins.
def _country_preaggregated(rows: str) -> str:
    per_customer = f"(SELECT o_custkey, {_sums()} FROM {rows} GROUP BY o_custkey)"
    joined = f"{per_customer} p JOIN customer c ON p.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"
    return f"""
SELECT n_name AS country, {_SUM} AS total_revenue
FROM {_grouped(joined, "n_name", sums=_again())}
ORDER BY total_revenue DESC, country
"""


REVENUE_BY_COUNTRY_PREAGG_SQL = _country_preaggregated(_rows("orders", "o_totalprice", condition="x > 100000"))
REVENUE_BY_COUNTRY_TEXT_PREAGG_SQL = _country_preaggregated(_rows("orders_text", "amount_text", text=True, condition="x > 100000"))


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def revenue_by_country_sql(
    spark: SparkSession,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """``country``, ``total_revenue`` from SQL text over temp views."""
    return sql_report(
        spark, "revenue_by_country", {"orders": orders, "customer": customer, "nation": nation},
        max_broadcast_rows,
    )


# Columns of a dimension that its reports use; only these are measured and sent.
DIMENSION_COLUMNS = {
    "revenue_by_country": {"customer": ["c_custkey", "c_nationkey"], "nation": ["n_nationkey", "n_name"]},
    "revenue_by_country_text": {"customer": ["c_custkey", "c_nationkey"], "nation": ["n_nationkey", "n_name"]},
    "customer_sales_report": {"customer": ["c_custkey", "c_name", "c_mktsegment"]},
    "revenue_by_brand": {"part": ["p_partkey", "p_brand"]},
}


# The sorted reports over many groups carry a REBALANCE hint under the ORDER
# BY, as ``sorted_by(materialize=True)`` does for the DataFrame forms.

_ORDERS = _rows("orders", "o_totalprice")
_LINES = _rows(_rows("lineitem", "l_extendedprice"), "l_quantity", also="_q")

REPORT_SQL: dict[str, str] = {
    "total_sales_by_customer": f"""
SELECT o_custkey, {_SUM} AS total_sales
FROM {_grouped(_ORDERS, "o_custkey")}
""",
    "revenue_by_category": f"""
SELECT o_orderpriority AS category, total_orders, {_SUM} AS total_revenue
FROM {_grouped(_ORDERS, "o_orderpriority", "COUNT(o_orderkey) AS total_orders")}
ORDER BY total_revenue DESC, category NULLS LAST
""",
    "product_sales_metrics": f"""
SELECT * FROM (
    SELECT /*+ REBALANCE */ l_partkey, {_SUM} AS total_sales_amount, {_QUANTITY} AS total_quantity_sold,
           {_AVG} AS average_transaction_amount
    FROM {_joined("SELECT * FROM " + _grouped(_LINES, "l_partkey", _sums("_q")), "_q")}
) metrics
ORDER BY l_partkey NULLS LAST
""",
    "purchases_by_user": f"""
SELECT * FROM (
    SELECT /*+ REBALANCE */ user_id, total_purchases, {_MEAN} AS avg_spend
    FROM {_grouped(_rows("events", "value", condition="event_type = 'purchase'"), "user_id", "COUNT(user_id) AS total_purchases")}
) purchases
ORDER BY total_purchases DESC, user_id NULLS LAST
""",
    "completed_summary": f"""
SELECT o_orderpriority AS category, total_orders, {_SUM} AS total_revenue, {_MEAN} AS avg_order_value,
       current_timestamp() AS processed_at
FROM {_grouped(_rows("orders", "o_totalprice", condition="o_orderstatus = 'F'"), "o_orderpriority", "COUNT(o_orderkey) AS total_orders")}
""",
    "customer_sales_report": f"""
WITH sales AS (
    SELECT o_custkey, {_SUM} AS total_sales
    FROM {_grouped(_ORDERS, "o_custkey")}
)
SELECT s.o_custkey, c.c_name, s.total_sales, c.c_mktsegment
FROM sales s
JOIN customer c ON s.o_custkey = c.c_custkey
""",
    "revenue_by_brand": f"""
SELECT p_brand, {_SUM} AS total_revenue
FROM {_grouped(_rows("lineitem", "l_extendedprice") + " l JOIN part p ON l.l_partkey = p.p_partkey", "p_brand")}
""",
    "revenue_by_country": REVENUE_BY_COUNTRY_SQL,
    "revenue_by_country_text": REVENUE_BY_COUNTRY_TEXT_SQL,
    "amount_totals": AMOUNT_TOTALS_SQL,
}

# The forms for a dimension above the broadcast bound, and the dimension
# whose size decides.
_PER_PART = f"(SELECT l_partkey, {_sums()} FROM {_rows('lineitem', 'l_extendedprice')} GROUP BY l_partkey) pp"

PREAGGREGATED_SQL: dict[str, tuple[str, str]] = {
    "revenue_by_brand": ("part", f"""
SELECT p_brand, {_SUM} AS total_revenue
FROM {_grouped(_PER_PART + " JOIN part p ON pp.l_partkey = p.p_partkey", "p_brand", sums=_again())}
"""),
    "revenue_by_country": ("customer", REVENUE_BY_COUNTRY_PREAGG_SQL),
    "revenue_by_country_text": ("customer", REVENUE_BY_COUNTRY_TEXT_PREAGG_SQL),
}


def sql_report(
    spark: SparkSession,
    name: str,
    tables: dict[str, DataFrame],
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Run report ``name`` as SQL text over ``tables`` registered as temp views.

    Customer and part views are broadcast only within ``max_broadcast_rows``
    (nation within its own bound); see the module notes for the text chosen.
    """
    bounds = {"customer": max_broadcast_rows, "part": max_broadcast_rows, "nation": NATION_MAX_ROWS}
    used = DIMENSION_COLUMNS.get(name, {})
    tables = {t: df.select(*used[t]) if t in used else df for t, df in tables.items()}
    small = {t: fits_broadcast(df, bounds[t]) for t, df in tables.items() if t in bounds}
    text = REPORT_SQL[name]
    if name in PREAGGREGATED_SQL:
        dimension, preaggregated = PREAGGREGATED_SQL[name]
        if not small[dimension]:
            text = preaggregated
    # Views of this call's own: the caller's views of the same names stay as they are.
    own = {t: f"{t}_{uuid.uuid4().hex}" for t in tables}
    register_views({own[t]: F.broadcast(df) if small.get(t) else df for t, df in tables.items()})
    try:
        return spark.sql(re.sub(rf"\b({'|'.join(tables)})\b", lambda m: own[m[1]], text))
    finally:
        # The result's plan is resolved and needs the names no more.
        for view in own.values():
            spark.catalog.dropTempView(view)
