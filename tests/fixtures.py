"""Hand-written fixtures with the edge cases of FIXTURES.md section 3.

Own values in the shapes of the driver tables; nothing here is taken from
elsewhere.
"""

from __future__ import annotations

import datetime as dt

from tallyframe.schemas import TABLES

D = dt.datetime(2024, 3, 1)


def orders(spark):
    rows = [
        # key, cust, status, price, date, priority
        (1, 10, "F", 120_000.50, D, "1-URGENT"),
        (2, 10, "O", 300_000.00, D, "1-URGENT"),   # exactly at the high-value threshold
        (3, 11, "F", 150_000.00, D, "2-HIGH"),     # exactly at the text threshold
        (4, 11, "P", 150_000.01, D, "2-HIGH"),     # pending: text is unparseable
        (5, 12, "F", 99_999.99, D, "3-MEDIUM"),
        (6, None, "F", 410_000.25, D, "3-MEDIUM"),  # null customer key
        (7, 13, "F", 250_000.10, D, None),          # null priority
        (8, 13, "O", 250_000.10, D, "5-LOW"),       # ties 7 on price
        (None, 12, "F", 100.00, D, "5-LOW"),        # null order key: count(col) < count(*)
        (9, 14, "F", 0.01, D, "4-NOT SPECIFIED"),
        (10, 14, "F", 0.02, D, "4-NOT SPECIFIED"),  # average ends on a half cent
    ]
    return spark.createDataFrame(rows, TABLES["orders"])


def customers(spark):
    rows = [
        (10, "Cust A", 1, 10.0, "BUILDING"),
        (11, "Cust B", 1, 20.0, "MACHINERY"),   # same nation as A
        (12, "Cust C", 2, 30.0, "BUILDING"),
        (13, "Cust D", 3, 40.0, "HOUSEHOLD"),
        (14, "Cust E", 2, 50.0, "AUTOMOBILE"),
        (15, "Cust F", 3, 60.0, "BUILDING"),    # no orders
        (None, "Cust G", 1, 70.0, "BUILDING"),  # null key
    ]
    return spark.createDataFrame(rows, TABLES["customer"])


def nations(spark):
    rows = [(1, "ALPHA", 0), (2, "BRAVO", 0), (3, "CHARLIE", 1), (4, "DELTA", 1)]
    return spark.createDataFrame(rows, TABLES["nation"])


def lineitems(spark):
    """Part 100 holds a third of all rows (a hot key)."""
    rows = []
    line = 0
    for order, (part, price, qty) in enumerate(
        [(100, 10.00, 1.0)] * 30
        + [(101, 1.00, 2.0), (101, 1.01, 3.0)]      # average 1.005 -> 1.01
        + [(102, 5.55, 4.0)]                         # group of one
        + [(103 + i % 20, 2.25 + i, 1.0) for i in range(57)]
    ):
        line += 1
        rows.append((order, part, 1, line, qty, price, 0.0, 0.0, "N", "O", D))
    return spark.createDataFrame(rows, TABLES["lineitem"])


def parts(spark, n: int = 130):
    brands = ["Brand#11", "Brand#12", "Brand#21"]
    rows = [(k, f"part {k}", brands[k % 3], "STANDARD", 1, 1.0) for k in range(90, 90 + n)]
    return spark.createDataFrame(rows, TABLES["part"])


def events(spark):
    rows = [
        (1, D, 1, "purchase", 10.00, "{}"),
        (2, D, 1, "purchase", 10.01, "{}"),
        (3, D, 2, "view", 0.50, "{}"),          # user without purchases
        (4, D, 3, "purchase", -0.0, "{}"),
        (5, D, 3, "click", 1.25, "{}"),
        (6, D + dt.timedelta(days=1), 4, "purchase", 99.99, "{}"),
        (7, D + dt.timedelta(days=2), None, "purchase", 5.00, "{}"),
    ]
    return spark.createDataFrame(rows, TABLES["events"])
