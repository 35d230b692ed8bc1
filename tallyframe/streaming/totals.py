"""Running event totals whose state survives restarts (Structured Streaming).

A streaming aggregation keeps per-``event_type`` count and exact sums in the
state store, which is checkpointed with every batch.  After each batch the
complete result is published with ``foreachBatch`` into its own ``batch_id``
partition of a Parquet table (dynamic partition overwrite): a batch that is
replayed after a failure rewrites exactly its own partition, so publishing is
idempotent, and readers take the newest partition; only the last few are kept.

The state is keyed by event type, a handful of keys at any data volume (each
input task pre-aggregates before the state shuffle), so the stateful stage
uses a few partitions of its own instead of the session's shuffle count.  The
number is fixed in the checkpoint at the first run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import money_parts, parts_amount
from tallyframe.functions.money import PARTS
from tallyframe.sinks.fs import children, delete
from tallyframe.streaming.purchases import MAX_FILES_PER_TRIGGER, event_stream, run_to_end


def event_totals(events: DataFrame) -> DataFrame:
    """Stateful aggregate: ``event_type``, ``n`` and the summed parts of the value."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(part).alias(name) for name, part in zip(PARTS, money_parts("value", "value").values(), strict=True)],
    )


# Snapshots kept; older ones are deleted after each batch.
KEPT_SNAPSHOTS = 3


def _publisher(output_dir: str):
    def publish(batch: DataFrame, batch_id: int) -> None:
        snapshot = batch.select(
            "event_type", "n", parts_amount(*[p for p in PARTS if p in batch.columns]).alias("total_value"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        (
            snapshot.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(output_dir)
        )
        # Readers take the newest snapshot; a few more stay for those that
        # opened an earlier one.
        spark = batch.sparkSession
        for old in _snapshot_ids(spark, output_dir)[:-KEPT_SNAPSHOTS]:
            delete(spark, f"{output_dir.rstrip('/')}/batch_id={old}")

    return publish


def _snapshot_ids(spark: SparkSession, output_dir: str) -> list[int]:
    """Batch ids of the published snapshots, oldest first."""
    names = [n for n in children(spark, output_dir) if n.startswith("batch_id=")]
    return sorted(int(n.partition("=")[2]) for n in names)


# Partitions of the state store for a low-cardinality key.
STATE_PARTITIONS = 4


def run_event_totals(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    state_partitions: int = STATE_PARTITIONS,
) -> int:
    """Fold every new file into the totals, publish, stop; returns rows read."""
    # A session of its own for the stream's shuffle setting; the caller's
    # settings stay as they are.
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    writer = (
        event_totals(event_stream(own, input_dir, max_files_per_trigger))
        .writeStream.outputMode("complete")
        .foreachBatch(_publisher(output_dir))
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )
    return run_to_end(own, writer.start)


def latest_totals(spark: SparkSession, output_dir: str) -> DataFrame:
    """The newest published snapshot: ``event_type``, ``n``, ``total_value``.

    Only the newest snapshot's folder is read; it is found by its name.
    """
    newest = _snapshot_ids(spark, output_dir)[-1]
    return spark.read.parquet(f"{output_dir.rstrip('/')}/batch_id={newest}").select("event_type", "n", "total_value")
