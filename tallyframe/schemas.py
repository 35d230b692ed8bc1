"""Declared schemas.

Reading with a declared schema skips inference (no extra pass over CSV, no
footer merge over thousands of Parquet files) and pins key types so joins
need no implicit casts.
"""

from __future__ import annotations

from pyspark.sql import types as T


def struct_of(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
STRING = T.StringType()
TS_NTZ = T.TimestampNTZType()

# The driver's test tables (Parquet).  Timestamps carry no zone.
TABLES: dict[str, T.StructType] = {
    "region": struct_of(("r_regionkey", INT), ("r_name", STRING)),
    "nation": struct_of(("n_nationkey", INT), ("n_name", STRING), ("n_regionkey", INT)),
    "customer": struct_of(
        ("c_custkey", LONG), ("c_name", STRING), ("c_nationkey", INT),
        ("c_acctbal", DOUBLE), ("c_mktsegment", STRING),
    ),
    "supplier": struct_of(
        ("s_suppkey", LONG), ("s_name", STRING), ("s_nationkey", INT), ("s_acctbal", DOUBLE),
    ),
    "part": struct_of(
        ("p_partkey", LONG), ("p_name", STRING), ("p_brand", STRING), ("p_type", STRING),
        ("p_size", INT), ("p_retailprice", DOUBLE),
    ),
    "orders": struct_of(
        ("o_orderkey", LONG), ("o_custkey", LONG), ("o_orderstatus", STRING),
        ("o_totalprice", DOUBLE), ("o_orderdate", TS_NTZ), ("o_orderpriority", STRING),
    ),
    "lineitem": struct_of(
        ("l_orderkey", LONG), ("l_partkey", LONG), ("l_suppkey", LONG), ("l_linenumber", INT),
        ("l_quantity", DOUBLE), ("l_extendedprice", DOUBLE), ("l_discount", DOUBLE),
        ("l_tax", DOUBLE), ("l_returnflag", STRING), ("l_linestatus", STRING),
        ("l_shipdate", TS_NTZ),
    ),
    "events": struct_of(
        ("event_id", LONG), ("ts", TS_NTZ), ("user_id", LONG), ("event_type", STRING),
        ("value", DOUBLE), ("props", STRING),
    ),
}


def all_strings(names: list[str]) -> T.StructType:
    """Every column as text: the shape of a header-only CSV read."""
    return struct_of(*[(name, STRING) for name in names])


# Shapes of the small inputs the reference's jobs work on; used by the
# fixtures in tests and as defaults of the path-parameterised job.
TRANSACTIONS = struct_of(
    ("TransactionID", INT), ("CustomerID", INT), ("ProductID", INT),
    ("Amount", DOUBLE), ("Quantity", INT), ("Region", STRING),
)
