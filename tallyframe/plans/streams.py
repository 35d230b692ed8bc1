"""Registered streaming queries: two arrivals of the events table, a restart
with nothing new in between, and the result read back as a batch table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import scratch_path
from tallyframe.sources.tables import read_table
from tallyframe.streaming.keyed_totals import latest_keyed_totals, run_keyed_totals
from tallyframe.streaming.ledger import AFTER_WRITE
from tallyframe.streaming.purchases import committed_purchases, run_ledgered_purchase_copy, run_purchase_copy
from tallyframe.streaming.totals import latest_totals, run_event_totals


def split_by_arrival(events: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Events before and after the midpoint of their time range.

    The midpoint is computed by a global aggregate (exactly one row comes
    back); rows without a time arrive with the second part.
    """
    bounds = events.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).select(
        (F.col("lo") + (F.col("hi") - F.col("lo")) / 2).cast("string").alias("mid")
    ).first()
    if bounds is None or bounds["mid"] is None:
        return events.where(F.lit(False)), events
    mid = F.lit(bounds["mid"]).cast(events.schema[ts].dataType)
    early = events.where(F.col(ts) < mid)
    late = events.where((F.col(ts) >= mid) | F.col(ts).isNull())
    return early, late


def _two_arrivals(spark: SparkSession, root: str, kind: str, run) -> str:
    early, late = split_by_arrival(read_table(spark, root, "events"))
    base = scratch_path(spark, kind)
    inbox, out, checkpoint = f"{base}/inbox", f"{base}/out", f"{base}/checkpoint"
    early.write.mode("append").parquet(inbox)
    run(spark, inbox, out, checkpoint)
    resumed = run(spark, inbox, out, checkpoint)
    if resumed != 0:
        raise RuntimeError(f"restart on the same checkpoint re-read {resumed} rows")
    late.write.mode("append").parquet(inbox)
    run(spark, inbox, out, checkpoint)
    return out


def q_stream_purchases_resume(spark: SparkSession, root: str) -> DataFrame:
    """Purchase rows copied by a stream that was stopped and resumed."""
    out = _two_arrivals(spark, root, "purchases-stream", run_purchase_copy)
    return spark.read.parquet(out).select("event_id", "user_id", "value")


def q_stream_event_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals by event type from a stateful stream across a restart."""
    out = _two_arrivals(spark, root, "event-totals-stream", run_event_totals)
    return latest_totals(spark, out)


class _Died(Exception):
    """The stream was made to die between a batch's write and its commit."""


def q_stream_purchases_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Purchase rows copied by a stream that dies after writing each arrival, before it counts, and is resumed."""
    def run(spark: SparkSession, inbox: str, out: str, checkpoint: str) -> int:
        def die(point: str, batch_id: int) -> None:
            if point == AFTER_WRITE:
                raise _Died(f"batch {batch_id}")

        try:
            run_ledgered_purchase_copy(spark, inbox, out, checkpoint, steps=die)
        except Exception as error:
            if _Died.__name__ not in str(error):
                raise
        return run_ledgered_purchase_copy(spark, inbox, out, checkpoint)

    out = _two_arrivals(spark, root, "purchases-ledger", run)
    return committed_purchases(spark, out).select("event_id", "user_id", "value")


def q_stream_user_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals by user from RocksDB state across restarts, published as changed users only."""
    out = _two_arrivals(spark, root, "user-totals-stream", run_keyed_totals)
    return latest_keyed_totals(spark, out, "user_id")


QUERIES = {
    "stream_purchases_ledger": q_stream_purchases_ledger,
    "stream_user_totals": q_stream_user_totals,
    "stream_purchases_resume": q_stream_purchases_resume,
    "stream_event_totals": q_stream_event_totals,
}

ORACLE_SQL = {
    "stream_purchases_ledger": """
SELECT event_id, user_id, value
FROM events
WHERE event_type = 'purchase'
""",
    "stream_user_totals": """
SELECT user_id, COUNT(*) AS n, CAST(ROUND(SUM(CAST(value AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_value
FROM events
GROUP BY user_id
""",
    "stream_purchases_resume": """
SELECT event_id, user_id, value
FROM events
WHERE event_type = 'purchase'
""",
    "stream_event_totals": """
SELECT event_type,
       COUNT(*) AS n,
       CAST(ROUND(SUM(CAST(value AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_value
FROM events
GROUP BY event_type
""",
}
