"""Total orders and top-n previews with deterministic ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _as_cols(cols: list[ColumnOrName]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def sorted_by(
    df: DataFrame, order: list[ColumnOrName], tie_keys: list[str], materialize: bool = False
) -> DataFrame:
    """Global sort; the tie keys make the order unique (range exchange + sort).

    A range exchange first runs a sampling job over its input.  When that
    input is an aggregate, the sampler recomputes the whole final aggregation
    (it re-reads the aggregation's shuffle), and then the exchange computes it
    again.  ``materialize=True`` puts a ``REBALANCE`` between them: AQE
    finishes the aggregate as its own stage, and the sampler and the range
    exchange read only the aggregated rows.  Use it for sorted outputs of
    high-cardinality aggregates; for a handful of groups it is not needed.
    """
    if materialize:
        df = df.hint("rebalance")
    return df.orderBy(*_as_cols(order), *[F.col(k).asc_nulls_last() for k in tie_keys])


def top_n(df: DataFrame, n: int, order: list[ColumnOrName], tie_keys: list[str]) -> DataFrame:
    """The first ``n`` rows of the total order.

    Planned as ``TakeOrderedAndProject``: every task keeps its own n best rows
    and only those reach the final merge, so no full sort or shuffle happens.
    """
    return sorted_by(df, order, tie_keys).limit(n)
