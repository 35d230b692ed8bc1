"""Grouped money summaries: count, exact sum and exact average per group.

The same shape serves every grouped report: ``groupBy(keys).agg(...)`` over
built-in aggregates only, planned as a partial aggregation in every map task
(a key holding a third of the rows is collapsed there) and a final
aggregation after the hash exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.money import staged_amount, staged_avg, staged_double, staged_mean, staged_results, staged_sum, staged_sums

ColumnOrName = Column | str


def money_summary(
    df: DataFrame,
    by: list[ColumnOrName],
    amount: ColumnOrName,
    *,
    count_as: str | None = None,
    count_of: ColumnOrName | None = None,
    sum_as: str | None = None,
    avg_as: str | None = None,
    mean_as: str | None = None,
    totals: dict[str, ColumnOrName] | None = None,
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """Per group of ``by``: optional count, exact sum (rounded once), rounded or unrounded average.

    ``count_of`` counts non-null values of a column (``count(col)``); without
    it every row counts (``count(*)``).  ``totals`` are further amounts whose
    exact sums are returned as doubles.  The amount is computed once per row,
    and the sums are put together in a projection of their own.
    """
    if not (count_as or sum_as or avg_as or mean_as or totals or extra):
        raise ValueError("ask for at least one of count_as, sum_as, avg_as, mean_as, totals or extra")
    p = "_money"
    while any(c.lower().startswith(p) for c in df.columns):
        p += "_"
    amounts = {p: amount} if sum_as or avg_as or mean_as else {}
    amounts |= {f"{p}{i}_": column for i, column in enumerate((totals or {}).values())}
    rows, aggs, out = df, [], []
    for name, column in amounts.items():
        rows = staged_amount(rows, column, name)
        aggs += staged_sums(name)
    if count_as:
        target = F.col(count_of) if isinstance(count_of, str) else count_of
        aggs.append(F.count(target if target is not None else F.lit(1)).alias(count_as))
        out.append(F.col(count_as))
    sums = rows.groupBy(*by).agg(*aggs, *extra)
    keys = [F.col(f"`{c}`") for c in sums.columns[:len(by)]]
    extras = [F.col(f"`{c}`") for c in sums.columns[len(by) + len(aggs):]]
    sums = staged_results(sums, *amounts)
    if sum_as:
        out.append(staged_sum(p).alias(sum_as))
    if avg_as:
        out.append(staged_avg(p).alias(avg_as))
    if mean_as:
        out.append(staged_mean(p).alias(mean_as))
    out += [staged_double(f"{p}{i}_").alias(name) for i, name in enumerate(totals or {})]
    return sums.select(*keys, *out, *extras)
