"""Which keys make a partition heavy.

Two steps over the same partitioning.  First every partition keeps a frequent
items sketch of its keys (Spark's ``approx_top_k_accumulate``): the rows of a
partition are in one task, so one small sketch per partition crosses the
network.  The sketches name candidates; then the candidates alone are counted
exactly.

What is missed: nothing.  A sketch with a map of ``m`` slots over ``n`` rows is
off by at most ``3.5 n / m`` and names every key seen more often than twice
that.  The map is sized from the share asked for, so a key with at least that
share of its partition is always a candidate, and exact counts drop the rest.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.joins import BROADCAST_MAX_ROWS, fits_broadcast

# Fixed values of Spark's sketch: share of its map that it fills, and its error in shares of a slot.
LOAD_FACTOR = 0.75
ERROR_SLOTS = 3.5
MAX_TRACKED = 1_000_000


def tracked_items(min_percent: float) -> int:
    """Items a sketch must track to name every key with ``min_percent`` of the rows."""
    if not 0 < min_percent <= 100:
        raise ValueError("min_percent must be above 0 and at most 100")
    items = math.ceil(LOAD_FACTOR * 2 * ERROR_SLOTS * 100 / min_percent)
    if items > MAX_TRACKED:
        raise ValueError(f"a share of {min_percent}% needs a sketch of {items} items; {MAX_TRACKED} is the most")
    return items


def error_bound(min_percent: float) -> float:
    """Largest error of a sketch's count, as a share of its partition's rows."""
    return ERROR_SLOTS * LOAD_FACTOR / tracked_items(min_percent)


def _tagged(df: DataFrame, keys: list[str]) -> DataFrame:
    # As JSON a key of several columns is one text, and a null one is a text too.
    key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]), {"ignoreNullFields": "false"})
    return df.select(F.spark_partition_id().alias("partition_id"), key.alias("key"))


def partition_sketches(df: DataFrame, keys: list[str], min_percent: float = 5) -> DataFrame:
    """``partition_id, n_rows, sketch``: the rows and the key sketch of each partition that holds rows."""
    return _tagged(df, keys).groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.expr(f"approx_top_k_accumulate(key, {tracked_items(min_percent)})").alias("sketch"),
    )


def sketched_heavy_keys(sketches: DataFrame, min_percent: float = 5) -> DataFrame:
    """All sketches as one: ``key, approx_rows`` of keys that may hold ``min_percent`` of all rows.

    Merging adds the error bounds up, so the bound stays the same share of all
    rows.  Every key with that share of all rows is listed; a listed one may
    fall short of it by ``error_bound``.  Without rows there are no keys.
    """
    items = tracked_items(min_percent)
    # One group, but none of an empty table: Spark cannot combine no sketches.
    merged = sketches.groupBy(F.lit(1).alias("all")).agg(
        F.sum("n_rows").alias("n_rows"), F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch")
    )
    named = merged.select("n_rows", F.expr(f"explode(approx_top_k_estimate(sketch, {items}))").alias("e"))
    floor = F.lit(min_percent / 100 - error_bound(min_percent)) * F.col("n_rows")
    return named.where(F.col("e.count") >= floor).select(F.col("e.item").alias("key"), F.col("e.count").alias("approx_rows"))


def heavy_keys(
    df: DataFrame,
    keys: list[str],
    min_percent: float = 5,
    planned: int | None = None,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """``partition_id, n_rows, key, key_rows``: keys with at least ``min_percent`` of their partition's rows.

    Counts are exact.  A partition without such a key has one row with a null
    ``key``.  With ``planned`` given, planned partitions without rows are
    listed too, with 0 rows; otherwise they do not appear.  ``key`` is a JSON
    text of the key columns, so a null key is a key like any other.

    ``df`` must partition the same way each time it is computed, as a
    repartition by columns does; within this plan its exchange is reused.  The
    candidates are broadcast behind the size check (at most a few tens per
    partition); beyond it, counts per partition and key are joined instead.
    """
    items = tracked_items(min_percent)
    sizes = partition_sketches(df, keys, min_percent)
    candidates = sizes.select(
        "partition_id", F.expr(f"explode(approx_top_k_estimate(sketch, {items}).item)").alias("key")
    )
    tagged = _tagged(df, keys)
    if fits_broadcast(candidates, max_broadcast_rows):
        counted = tagged.join(F.broadcast(candidates), ["partition_id", "key"], "left_semi")
        counts = counted.groupBy("partition_id", "key").agg(F.count(F.lit(1)).alias("key_rows"))
    else:
        per_key = tagged.groupBy("partition_id", "key").agg(F.count(F.lit(1)).alias("key_rows"))
        counts = per_key.join(candidates, ["partition_id", "key"], "left_semi")
    rows = sizes.select("partition_id", "n_rows")
    found = counts.join(rows, "partition_id").where(F.col("key_rows") * 100 >= F.col("n_rows") * min_percent)
    if planned is not None:
        spark = df.sparkSession
        rows = spark.range(planned).select(F.col("id").cast("int").alias("partition_id")).join(rows, "partition_id", "left")
        rows = rows.fillna(0, ["n_rows"])
    return rows.join(found.drop("n_rows"), "partition_id", "left").select("partition_id", "n_rows", "key", "key_rows")
