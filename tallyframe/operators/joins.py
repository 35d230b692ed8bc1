"""Joins of facts with dimensions.

A broadcast hint skips the shuffle of the large side but ships the whole
dimension to every executor, so it is only given after the dimension's rows
and bytes have been checked against bounds (see ``fits_broadcast``).  Above the bound the fact side is
pre-aggregated on the join key (map-side partial aggregation collapses hot
keys inside each task) and then joined with a shuffle; AQE may still turn
that join into a broadcast at run time if the shuffled sides turn out small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds for a broadcast dimension: rows (checked from Parquet metadata, no
# scan) and bytes of the rows actually shipped (checked by one scan of at most
# that many rows).  128 MB keeps the driver's collect and every executor's
# copy small next to executor memory.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _fixed_width(dtype: T.DataType) -> int | None:
    for cls, width in _FIXED_WIDTH.items():
        if isinstance(dtype, cls):
            return width
    return None


def row_bytes_bound(dim: DataFrame, rows: int) -> int | None:
    """Upper bound of the bytes of ``dim`` as Spark rows, or None if unknown.

    Each row is counted as an UnsafeRow: a null bitmap, an 8-byte slot per
    field and the bytes of every string, padded to 8.  Without string
    columns this needs no job; with them it runs one aggregate over ``dim``
    (call it only once ``dim`` is known to be small).  Columns of nested
    types make the size unknown.
    """
    fields = dim.schema.fields
    per_row = 8 * ((len(fields) + 63) // 64) + 8 * len(fields)
    var = [f.name for f in fields if _fixed_width(f.dataType) is None]
    for f in fields:
        if f.name in var and not isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return None
    if not var:
        return rows * per_row
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(c)) + 8), F.lit(0)) for c in var]
    agg = dim.agg(F.count(F.lit(1)).alias("n"), sum(lengths[1:], lengths[0]).alias("b")).first()
    return int(agg["n"]) * per_row + int(agg["b"])


def fits_broadcast(
    dim: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    size_probe: DataFrame | None = None,
) -> bool:
    """True if ``dim`` is proven to have at most ``max_rows`` rows and ``max_bytes`` bytes.

    The row check counts ``size_probe`` (default ``dim``): pass the dimension
    *table* or a projection of it, and the count needs no column, so Parquet
    answers it from row-group metadata with no data scan even on a huge
    table.  Filters and inner joins with a unique-key table only remove rows,
    so the table's count bounds any such derived dimension.  Only when the
    rows are within the bound are the bytes of ``dim`` itself measured.
    """
    if max_rows <= 0:
        return False
    probe = size_probe if size_probe is not None else dim
    rows = probe.count()
    if rows > max_rows:
        return False
    size = row_bytes_bound(dim, rows)
    return size is not None and size <= max_bytes


def checked_broadcast(
    dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """``dim`` with a broadcast hint if its size is within the bounds, else as is."""
    return F.broadcast(dim) if fits_broadcast(dim, max_rows, max_bytes) else dim


def rollup_through_dimension(
    fact: DataFrame,
    fact_key: str,
    measures: dict[str, Column],
    dim: DataFrame,
    dim_key: str,
    attributes: list[str],
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
    size_probe: DataFrame | None = None,
) -> DataFrame:
    """Additive measures of ``fact`` summed by attributes of ``dim``.

    ``measures`` maps an output name to a per-row bigint expression (cents,
    counts); results are sums per attribute group, exact in any join order.

    * dimension within the bound: broadcast hash join, no shuffle of ``fact``;
      only the partial sums per attribute group cross the network.
    * otherwise: sum by the fact key first (partial + final aggregation, so a
      key holding a third of all rows is reduced inside every map task), then
      a shuffle join of one row per key with the dimension, then the rollup.

    ``size_probe`` is the table whose row count bounds ``dim`` (default:
    ``dim`` itself); see ``fits_broadcast``.  The bytes checked are those of
    the projected dimension that would be broadcast.
    """
    dim_cols = dim.select(F.col(dim_key), *[F.col(a) for a in attributes])
    per_row = fact.select(F.col(fact_key), *[expr.alias(name) for name, expr in measures.items()])
    if fits_broadcast(dim_cols, max_broadcast_rows, size_probe=size_probe):
        joined = per_row.join(F.broadcast(dim_cols), per_row[fact_key] == dim_cols[dim_key])
    else:
        per_key = per_row.groupBy(fact_key).agg(*[F.sum(name).alias(name) for name in measures])
        joined = per_key.join(dim_cols, per_key[fact_key] == dim_cols[dim_key])
    return joined.groupBy(*attributes).agg(*[F.sum(name).alias(name) for name in measures])
