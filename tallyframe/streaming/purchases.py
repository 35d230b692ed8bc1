"""Resume-safe filtered copy of an event feed (Structured Streaming).

A file-source stream over a folder of Parquet files: each run picks up only
files it has not committed before (the checkpoint's offset and commit logs),
writes purchase rows to a Parquet file sink (exactly once through the sink's
own metadata log) and stops when the backlog is done (``availableNow``).
Checkpoint and output must live on shared storage so that a restarted driver
or a lost executor resumes from the last committed batch.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallyframe.plans.reports import PURCHASE_EVENT
from tallyframe.schemas import TABLES, struct_of
from tallyframe.streaming.ledger import Ledger, Steps, no_steps, write_once

PURCHASE_COLUMNS = ["event_id", "user_id", "value", "ts"]
# Files per micro-batch: a large backlog is worked off in bounded batches, so a
# failure repeats one batch, not the whole backlog.
MAX_FILES_PER_TRIGGER = 1000


def event_stream(
    spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Events arriving as Parquet files in ``input_dir`` (declared schema)."""
    reader = spark.readStream.schema(TABLES["events"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(input_dir)


def purchases(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == PURCHASE_EVENT).select(*PURCHASE_COLUMNS)


class _RowCount(StreamingQueryListener):
    """Input rows of all batches of one query, however many there are."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def end_of(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + int(event.progress.numInputRows)

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


# Seconds to wait for the listener's last event after the query has ended.
LISTENER_SECONDS = 60


def run_to_end(spark: SparkSession, start: Callable[[], StreamingQuery]) -> int:
    """Start an availableNow query, wait for it, and return the input rows it read.

    The rows are counted by a progress listener: a query keeps only its last
    reports, so a long backlog cannot be counted from the query itself.
    """
    counter = _RowCount()
    spark.streams.addListener(counter)
    try:
        query = start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        run = str(query.runId)
        if not counter.end_of(run).wait(LISTENER_SECONDS):
            raise RuntimeError("the stream ended but its listener was not told")
        return counter.rows.get(run, 0)
    finally:
        spark.streams.removeListener(counter)


def run_purchase_copy(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
) -> int:
    """Process every file not yet committed, then stop; returns rows read."""
    writer = (
        purchases(event_stream(spark, input_dir, max_files_per_trigger))
        .writeStream.format("parquet")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )
    return run_to_end(spark, writer.start)


def run_ledgered_purchase_copy(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    steps: Steps = no_steps,
) -> int:
    """``run_purchase_copy`` through the ledger of committed batches, for sinks without a log of their own."""
    writer = (
        purchases(event_stream(spark, input_dir, max_files_per_trigger))
        .writeStream.foreachBatch(write_once(Ledger(spark, output_dir.rstrip("/")), steps))
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )
    return run_to_end(spark, writer.start)


def committed_purchases(spark: SparkSession, output_dir: str) -> DataFrame:
    """Purchases of the committed batches, with their ``batch_id``."""
    types = TABLES["events"]
    return Ledger(spark, output_dir.rstrip("/")).read(struct_of(*[(c, types[c].dataType) for c in PURCHASE_COLUMNS]))
