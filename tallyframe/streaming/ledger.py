"""Batches that count once: a ledger of committed batches beside their data.

A streaming query can die between writing a batch and committing its offsets;
the restart then replays the batch under the same id.  Here a batch's rows go
to a folder of their own (rewritten whole by a replay), and the batch counts
only from the moment its ledger entry exists.  The entry is one empty file made
by a single create-if-absent call, its name holds the batch id and the row
count, so it is there or not: nothing else has to be atomic.

* died while writing, or after it: no entry, the replay rewrites the folder;
* died after the entry, before the offsets: the replay finds the entry and
  leaves the batch alone;
* readers resolve the entries first and open only those folders.

``steps`` lets a caller (a test) act at the points between those steps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sinks.files import write_counted
from tallyframe.sinks.fs import children, create_once, delete

Steps = Callable[[str, int], None]
BEFORE_WRITE, AFTER_WRITE, AFTER_LEDGER = "before write", "after write", "after ledger"


def no_steps(point: str, batch_id: int) -> None:
    """Nothing between the steps."""


@dataclass(frozen=True)
class Ledger:
    """Committed batches under ``root``: data in ``data/batch_id=N``, entries in ``ledger``."""

    spark: SparkSession
    root: str

    def folder(self, batch_id: int) -> str:
        return f"{self.root}/data/batch_id={batch_id}"

    def batches(self) -> dict[int, int]:
        """Rows of every committed batch by id, oldest first."""
        names = children(self.spark, f"{self.root}/ledger")
        return dict(sorted((int(b), int(n)) for b, n in (name.split("-") for name in names)))

    def commit(self, batch_id: int, rows: int) -> None:
        create_once(self.spark, f"{self.root}/ledger/{batch_id:012d}-{rows}")

    def forget(self, batch_ids: list[int]) -> None:
        """Drop batches that something newer stands for: entries first, then their data."""
        rows = self.batches()
        for b in batch_ids:
            if b in rows:
                delete(self.spark, f"{self.root}/ledger/{b:012d}-{rows[b]}")
        for b in batch_ids:
            delete(self.spark, self.folder(b))

    def read(self, schema: T.StructType, batch_ids: list[int] | None = None) -> DataFrame:
        """Rows of the committed batches (or of those given), with their ``batch_id``."""
        ids = list(self.batches()) if batch_ids is None else batch_ids
        full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        if not ids:
            return self.spark.createDataFrame([], full)
        reader = self.spark.read.schema(full).option("basePath", f"{self.root}/data")
        return reader.parquet(*[self.folder(b) for b in ids])

    def audit(self) -> DataFrame:
        """``batch_id, ledger_rows, data_rows`` of every committed batch, to be compared."""
        noted = self.spark.createDataFrame(list(self.batches().items()), "batch_id bigint, ledger_rows bigint")
        found = self.read(T.StructType([])).groupBy("batch_id").agg(F.count(F.lit(1)).alias("data_rows"))
        return noted.join(found, "batch_id", "left").withColumn("data_rows", F.coalesce("data_rows", F.lit(0).cast("bigint")))


def write_once(ledger: Ledger, steps: Steps = no_steps) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch once, however often it is replayed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id in ledger.batches():
            return
        steps(BEFORE_WRITE, batch_id)
        rows = write_counted(batch, lambda df: df.write.mode("overwrite").parquet(ledger.folder(batch_id)))
        steps(AFTER_WRITE, batch_id)
        ledger.commit(batch_id, rows)
        steps(AFTER_LEDGER, batch_id)

    return write
